"""Token ids in grammar-compressed shards: Re-Pair with random-access decoding.

Documents are written in ascending order of their id. A shard holds the ids of some consecutive documents as one frame, or
as some of at least FRAME_TOKENS; each frame has a grammar of its own: frequent pairs of neighbouring symbols are replaced by new symbols, round
after round until no pair is frequent, most frequent pairs first where they overlap. Rules are stored with their expansion lengths, so any stretch
of a frame is decoded without the rest.

Defined results: a null text is empty and gives just the end id; null document ids come first; repeated rows are written
as often as they come; an empty table gives no file and no row. Other columns are not read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemill.llm.shared import new_folder, open_store, stage, write_file
from lakemill.llm.tokens import id_bytes, with_end, word_ids
from lakemill.llm.words import ranges, runs

SHARD_TOKENS = FRAME_TOKENS = 1 << 20
#: New symbols in a round, and the occurrences a pair must have; rounds go on until no pair has them.
PAIRS, LEAST = 8192, 8
MAGIC = b"RPG1"


class Grammar(NamedTuple):
    """Symbols below ``base`` are ids; symbol base + k stands for (left[k], right[k]) and expands to length[k] ids."""

    base: int
    left: np.ndarray
    right: np.ndarray
    length: np.ndarray
    sequence: np.ndarray


def compress(ids: np.ndarray, pairs: int = PAIRS, least: int = LEAST) -> Grammar:
    base = int(ids.max()) + 1 if len(ids) else 1
    seq, left, right, length = ids.astype(np.uint32), [], [], [np.ones(base, np.int64)]
    symbols = base
    while len(seq) > 1:
        key = seq[:-1].astype(np.uint64) << np.uint64(32) | seq[1:]
        bucket = (key * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(44)).astype(np.int64)
        maybe = np.flatnonzero(np.bincount(bucket)[bucket] >= least)  # all occurrences of frequent pairs, and few others
        if not len(maybe):
            break
        ordered = np.sort(key[maybe])
        first = runs(ordered)
        count = np.diff(np.append(first, len(ordered)))
        often = np.flatnonzero(count >= least)
        if len(often) > pairs:
            often = np.sort(often[np.argpartition(count[often], len(often) - pairs)[-pairs:]])
        if not len(often):
            break
        chosen, weight = ordered[first[often]], count[often]
        hit = np.zeros(1 << 20, bool)
        hit[(chosen * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(44)).astype(np.int64)] = True
        spot = maybe[hit[bucket[maybe]]]  # where chosen pairs are, and few others
        here = key[spot]
        at = np.minimum(np.searchsorted(chosen, here), len(chosen) - 1)
        own = chosen[at] == here
        spot, at = spot[own], at[own]
        rank = weight[at]
        beside = spot[1:] == spot[:-1] + 1
        before, after = np.append(0, np.where(beside, rank[:-1], 0)), np.append(np.where(beside, rank[1:], 0), 0)
        start = np.flatnonzero(rank != before)  # of stretches of one rank, in which every other pair is taken
        inside = np.repeat(start, np.diff(np.append(start, len(rank))))
        odd = (np.arange(len(rank)) - inside) & 1
        taken = np.flatnonzero((rank > before[inside]) & (odd == 0) & (rank >= after))
        place, at = spot[taken], at[taken]
        used = np.bincount(at, minlength=len(chosen))
        keep = used >= min(4, least)
        place, at = place[keep[at]], at[keep[at]]
        if not len(place):
            break
        number = np.cumsum(keep) - 1 + symbols
        seq[place] = number[at]
        rest = np.ones(len(seq), bool)
        rest[place + 1] = False
        seq = seq[rest]
        new = chosen[keep]
        left.append((new >> np.uint64(32)).astype(np.uint32))
        right.append((new & np.uint64(0xFFFFFFFF)).astype(np.uint32))
        known = np.concatenate(length)
        length.append(known[left[-1]] + known[right[-1]])
        symbols += len(new)
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    return Grammar(base, join(left), join(right), np.concatenate(length)[base:], seq)


class Decoder:
    """Expansions of all symbols of a grammar, side by side in one array."""

    def __init__(self, grammar: Grammar):
        base, rules = grammar.base, len(grammar.left)
        self.length = np.concatenate([np.ones(base, np.int64), grammar.length])
        self.place = np.concatenate([np.arange(base), base + np.cumsum(grammar.length) - grammar.length])
        self.flat = np.zeros(base + int(grammar.length.sum()), np.uint32)
        self.flat[:base] = np.arange(base)
        done = base
        while done < base + rules:  # as many rules at once as only use earlier symbols
            ahead = np.maximum(grammar.left[done - base :], grammar.right[done - base :])
            late = np.flatnonzero(ahead >= done)
            end = done + int(late[0]) if len(late) else base + rules
            both = np.stack([grammar.left[done - base : end - base], grammar.right[done - base : end - base]], 1).ravel()
            at = int(self.place[done])
            got = self.expand(both)
            self.flat[at : at + len(got)] = got
            done = end

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        return self.flat[ranges(self.place[symbols], self.length[symbols])]


def decode(grammar: Grammar, low: int = 0, high: int | None = None) -> np.ndarray:
    """Ids low to high of a frame; only the symbols that cover them are expanded."""
    decoder = Decoder(grammar)
    end = np.cumsum(decoder.length[grammar.sequence])
    total = int(end[-1]) if len(end) else 0
    high = total if high is None else min(high, total)
    if low >= high:
        return np.zeros(0, np.uint32)
    a, b = int(np.searchsorted(end, low, "right")), int(np.searchsorted(end, high, "left")) + 1
    begin = int(end[a - 1]) if a else 0
    return decoder.expand(grammar.sequence[a:b])[low - begin : high - begin]


def frame_bytes(grammar: Grammar) -> bytes:
    """Header, rules, expansion lengths, then the sequence as low two bytes and high byte of each symbol."""
    return b"".join(
        [
            struct.pack("<4sIII", MAGIC, grammar.base, len(grammar.left), len(grammar.sequence)),
            *(np.ascontiguousarray(x, "<u4").tobytes() for x in (grammar.left, grammar.right, grammar.length)),
            (grammar.sequence & 0xFFFF).astype("<u2").tobytes(),
            (grammar.sequence >> 16).astype(np.uint8).tobytes(),
        ]
    )


def read_frame(data: bytes) -> Grammar:
    magic, base, rules, symbols = struct.unpack_from("<4sIII", data)
    if magic != MAGIC:
        raise ValueError("not a frame of a grammar-compressed shard")
    left, right, length = (np.frombuffer(data, "<u4", rules, 16 + 4 * rules * k) for k in range(3))
    low = np.frombuffer(data, "<u2", symbols, 16 + 12 * rules).astype(np.uint32)
    high = np.frombuffer(data, np.uint8, symbols, 16 + 12 * rules + 2 * symbols).astype(np.uint32)
    return Grammar(base, left, right, length.astype(np.int64), low | high << np.uint32(16))


def shard_chunks(doc_id: np.ndarray, valid: np.ndarray, length: np.ndarray, ids: np.ndarray) -> Iterator[bytes]:
    """Frames, document table (ids, whether they are set, lengths), frame sizes, and a footer with the counts."""
    frames = np.array_split(ids, max(1, len(ids) // FRAME_TOKENS))
    sizes = []
    for frame in frames:
        data = frame_bytes(compress(frame))
        sizes.append(len(data))
        yield data
    yield doc_id.astype("<i8").tobytes() + valid.astype(np.uint8).tobytes() + length.astype("<i8").tobytes()
    yield np.array(sizes, "<i8").tobytes() + struct.pack("<QQ4s", len(doc_id), len(frames), MAGIC)


def read_shard(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    docs, frames, magic = struct.unpack_from("<QQ4s", data, len(data) - 20)
    if magic != MAGIC:
        raise ValueError("not a grammar-compressed shard")
    table = len(data) - 20 - 8 * frames - 17 * docs
    sizes = np.frombuffer(data, "<i8", frames, len(data) - 20 - 8 * frames)
    begin = np.cumsum(sizes) - sizes
    ids = [decode(read_frame(data[a : a + n])) for a, n in zip(begin.tolist(), sizes.tolist(), strict=True)]
    doc_id = np.frombuffer(data, "<i8", docs, table)
    valid = np.frombuffer(data, np.uint8, docs, table + 8 * docs).astype(bool)
    length = np.frombuffer(data, "<i8", docs, table + 9 * docs)
    return doc_id, valid, length, np.concatenate(ids)


def write_shards(df: DataFrame, folder: str, path: str, end_id: int = 1) -> DataFrame:
    """Write (doc_id, text) rows as shards; returns one row per shard: part, shard, file, n_docs, n_tokens, n_bytes.

    The rows are dealt out by ranges of doc_id, so part and shard number give the order of the documents.
    """

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard = TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> pa.RecordBatch:
            name = f"part-{part:06d}-{shard:06d}.rpg"
            doc_id, valid, length, ids = (np.concatenate(x) for x in zip(*held, strict=True))
            size = write_file(folder, name, shard_chunks(doc_id, valid, length, ids))
            row = {"part": part, "shard": shard, "file": name, "n_docs": len(doc_id), "n_tokens": len(ids), "n_bytes": size}
            held.clear()
            return pa.RecordBatch.from_pylist([row])

        waiting = 0
        for batch in batches:
            for low in range(0, len(batch), 256):
                rows = batch.slice(low, 256)
                ids, length = with_end(*word_ids(path).encode(rows.column(1)), end_id)
                doc_id = rows.column(0).fill_null(0).to_numpy(zero_copy_only=False)
                held.append((doc_id, rows.column(0).is_valid().to_numpy(zero_copy_only=False), length, ids))
                waiting += len(ids)
                if waiting >= SHARD_TOKENS:
                    yield flush()
                    shard, waiting = shard + 1, 0
        if held:
            yield flush()

    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    kinds = "part long, shard long, file string, n_docs long, n_tokens long, n_bytes long"
    return stage(rows.mapInArrow(written, kinds), "shards")


def with_starts(shards: DataFrame) -> DataFrame:
    """Shards with the number of ids before each; only the totals of parts, one row each, meet in one task."""
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("part_start"))
    earlier = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0))
    return shards.withColumn("inside", inside).join(parts, "part").withColumn("start", F.col("part_start") + F.col("inside"))


def read_shards(shards: DataFrame, folder: str) -> DataFrame:
    """Documents of shards with column ``start``: doc_id, start, n_tokens, ids (little-endian 32-bit)."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with store.open_input_file(f"{base}/{name}") as file:
                    doc_id, valid, length, ids = read_shard(file.read())
                begin = start + np.cumsum(length) - length
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_id, mask=~valid), pa.array(begin), pa.array(length), id_bytes(ids, length)],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    tasks = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = shards.select("file", "start").repartition(tasks)
    return dealt.mapInArrow(decoded, "doc_id long, start long, n_tokens long, ids binary")


def round_trip(df: DataFrame, path: str, end_id: int = 1) -> DataFrame:
    """Write all documents to a new shared folder, then read them back."""
    folder = new_folder(df.sparkSession, "grammar")
    return read_shards(with_starts(write_shards(df, folder, path, end_id)), folder)
