"""Benchmark decontamination by spaced-seed hashing.

Texts and benchmark items become sequences of lower-case words of letters and digits. A mask selects some positions of a
window and ignores the others, so a window still hits when ignored words were replaced. Hashes of all masks are joined
with those of the items; around each hit text and item are laid side by side and verified word by word, with
substitutions allowed. A text is contaminated by an item if any stretch is at least LEAST_SHARE equal and holds
LEAST_WORDS equal words, or LEAST_SHARE of a shorter item. The best-scoring stretch is reported if it does, else the one
with the most equal words.

The benchmark is searched in blocks of at most BLOCK_WORDS words, the only thing that is broadcast; each block is one
pass over the texts, without a shuffle, so a passage that a third of all texts hold costs no more than others.

Defined results: null and empty texts hit nothing; items of fewer than SHORTEST words are not searched; equal items are
all reported; repeated rows are reported as often as they come; an empty table on either side gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.llm.words import NOT_ALNUM, documents, mix, ranges

#: Seven of eight to twelve words; items shorter than a window have a mask of their own length.
MASKS = ("11110111", "1101101011", "11001100111", "101100110101")
SHORTEST, LEAST_WORDS, LEAST_SHARE = 5, 13, 0.8
#: A wrong word costs as much as four right ones bring, so a verified stretch is at least 80 % equal.
PENALTY = 4
BLOCK_WORDS = 1 << 20
FILTER_BITS = 22


def normalised(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(texts.cast(pa.large_string()))


def seeds(row: np.ndarray, key: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of every window of a mask that lies in one text."""
    count = len(key) - len(mask) + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    value = np.full(count, len(mask), np.uint64)
    for k, bit in enumerate(mask):
        if bit == "1":
            value = value * np.uint64(0x9E3779B97F4A7C15) + key[k : k + count]
    place = np.flatnonzero(row[:count] == row[len(mask) - 1 :])
    return mix(value[place] ^ np.uint64(int(mask, 2))), place


def run_starts(value: np.ndarray, place: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Which seeds differ from the one a word before in the same text.

    Where a text and an item both repeat their seed a word later, the later pair lies on the same lane as the earlier one.
    So a pair is needed only if one of the two starts a run, and low-complexity texts give as many pairs as lanes.
    """
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (place[1:] != place[:-1] + 1) | (row[place[1:]] != row[place[:-1]])
    return new


class Index:
    """Seeds of a block of items, sorted by hash, and a filter that most hashes don't pass."""

    def __init__(self, ids: list[int | None], texts: list[str | None]):
        self.ids = ids
        parts = list(documents(normalised(pa.array(texts, pa.string())), NOT_ALNUM, size=1 << 40))
        _, _, self.row, self.key = parts[0] if parts else (0, 0, np.zeros(0, np.int64), np.zeros(0, np.uint64))
        self.length = np.bincount(self.row, minlength=len(ids))
        self.begin = np.cumsum(self.length) - self.length
        short = {"1" * n for n in set(self.length.tolist()) if SHORTEST <= n < max(map(len, MASKS))}
        self.masks, hashes, places, starts = (*MASKS, *sorted(short)), [], [], []
        for mask in self.masks:
            value, place = seeds(self.row, self.key, mask)
            size = self.length[self.row[place]]
            fits = size >= SHORTEST if mask in MASKS else size == len(mask)
            hashes.append(value[fits])
            places.append(place[fits])
            starts.append(run_starts(value[fits], place[fits], self.row))
        value, place, start = np.concatenate(hashes), np.concatenate(places), np.concatenate(starts)
        order = np.argsort(value, kind="stable")
        self.value, self.place = value[order], place[order]
        start = start[order]
        self.start_value, self.start_place = self.value[start], self.place[start]
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.value >> np.uint64(64 - FILTER_BITS)] = True

    def hits(self, row: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in texts and items where windows are equal under some mask, at least one pair of each lane that has any."""
        here, there = [], []
        for mask in self.masks:
            value, place = seeds(row, key, mask)
            maybe = np.flatnonzero(self.filter[value >> np.uint64(64 - FILTER_BITS)])
            start = run_starts(value, place, row)[maybe]
            value, place = value[maybe], place[maybe]
            for some, known, places in ((start, self.value, self.place), (~start, self.start_value, self.start_place)):
                low = np.searchsorted(known, value[some])
                many = np.searchsorted(known, value[some], "right") - low
                here.append(np.repeat(place[some], many))
                there.append(places[ranges(low, many)])
        return np.concatenate(here), np.concatenate(there)

    def overlaps(self, texts: pa.Array) -> Iterator[tuple[int, int, int, int, int, int]]:
        """Best verified overlap of each text and item: row, item, begin in both, words, equal words."""
        for first, _, row, key in documents(normalised(texts), NOT_ALNUM):
            here, there = self.hits(row, key)
            if not len(here):
                continue
            start = np.searchsorted(row, row[here])
            item = self.row[there]
            lane = (here - start) - (there - self.begin[item])
            lanes = np.unique(np.stack([row[here], item, lane, start], 1), axis=0)
            best: dict[tuple[int, int], tuple[int, int, int, int]] = {}
            for r, i, shift, base in lanes.tolist():
                found = self.verify(key[base : int(np.searchsorted(row, r, "right"))], i, shift)
                if found and ((r, i) not in best or found[3] > best[r, i][3]):
                    best[r, i] = found
            for (r, i), found in best.items():
                yield first + r, i, *found

    def verify(self, text: np.ndarray, item: int, shift: int) -> tuple[int, int, int, int] | None:
        """A stretch of the item, laid over the text at ``shift``, that is LEAST_SHARE equal and has enough equal words.

        The one with the most equal words for its wrong ones if that has enough, else the one with the most equal words.
        """
        own = self.key[self.begin[item] : self.begin[item] + self.length[item]]
        low, high = max(0, -shift), min(len(own), len(text) - shift)
        same = text[low + shift : high + shift] == own[low:high]
        total = np.concatenate([[0], np.cumsum(np.where(same, 1, -PENALTY))])
        right = np.concatenate([[0], np.cumsum(same)])
        least = np.minimum.accumulate(total)
        enough = min(LEAST_WORDS, LEAST_SHARE * len(own))
        end = int(np.argmax(total - least))
        begin = int(np.argmin(total[: end + 1]))
        if right[end] - right[begin] < enough:
            # the first begin of each end between which PENALTY right words come with each wrong one
            first = np.searchsorted(-least, -total)
            end = int(np.argmax(right - right[first]))
            begin = int(first[end])
            if right[end] - right[begin] < enough:
                return None
            begin += int(np.argmax(same[begin:end]))
        return low + shift + begin, low + begin, end - begin, int(right[end] - right[begin])


def blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[tuple[list[int | None], list[str | None]]]:
    """Items in blocks of at most about ``block_words`` words; an item is never cut."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    ids, texts, size = [], [], 0
    for item_id, text in rows.where("text IS NOT NULL").toLocalIterator():
        ids.append(item_id)
        texts.append(text)
        size += text.count(" ") + 1
        if size >= block_words:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _found(index: Broadcast, kinds: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = list(index.value.overlaps(batch.column(1)))
        if rows:
            row, item, *rest = (list(x) for x in zip(*rows, strict=True))
            ids = [index.value.ids[i] for i in item]
            size = [int(index.value.length[i]) for i in item]
            columns = [batch.column(0).take(pa.array(row)), ids, *rest, size]
            yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(columns, kinds, strict=True)], schema=kinds)


def contaminated(df: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Verified overlaps: doc_id, item_id, doc_word, item_word, n_words, n_equal, item_words. One row per text and item."""
    spark = df.sparkSession
    names = ("doc_id", "item_id", "doc_word", "item_word", "n_words", "n_equal", "item_words")
    kinds = pa.schema([(name, pa.int64()) for name in names])
    schema = ", ".join(f"{name} long" for name in names)
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = spark.createDataFrame([], schema)
    for block in blocks(benchmark, block_words):
        index = spark.sparkContext.broadcast(Index(*block))
        found = found.unionByName(rows.mapInArrow(partial(_found, index, kinds), schema))
    return found


def _kept(index: Broadcast, text: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = np.ones(len(batch), bool)
        keep[[row for row, *_ in index.value.overlaps(batch.column(text))]] = False
        yield batch.filter(pa.array(keep))


def decontaminate(df: DataFrame, benchmark: DataFrame, text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``df``, all columns, whose text no item contaminates."""
    for block in blocks(benchmark, block_words):
        index = df.sparkSession.sparkContext.broadcast(Index(*block))
        df = df.mapInArrow(partial(_kept, index, df.columns.index(text)), df.schema)
    return df
