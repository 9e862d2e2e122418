"""Collocations of two and three words by dynamic itemset counting over cyclic shard scans.

Texts are staged once in SHARDS shards. Step t scans shard t mod SHARDS and counts, at the same time, words, phrases of
two words and phrases of three. Words are counted from step 0. A phrase becomes active in the step after both of its
subphrases (without the last word, and without the first) have reached the threshold in the counts so far, and is then
counted for one full cycle of shards, which gives its exact number of occurrences. So lengths interleave, and phrases that
can't be frequent are never counted. Steps end when no phrase is active.

Tasks learn from a table of bytes in the shared folder in which step a word, or a phrase of two, reached the threshold: a
key's step is the latest one of its two cells, and a cell keeps the first step that set it. Cells never change once set,
so a key that seems to have reached it earlier only has its cycle begin earlier; counts stay exact. The table's size
follows the input, up to MOST_CELLS; beyond, more phrases are counted that turn out to be rare.

Within a task phrases are pairs and triples of word numbers, exact ones; what is shuffled is one row per phrase, language
and task. No language, word or phrase is gathered in one task: counts are partly summed before each shuffle, and
the first phrases of a language are cut in each task before they meet.

Defined results: null texts are empty; a null language is ``und``; empty texts and texts of separators give nothing; very
long texts are read whole; repeated rows count each; ties are in order of the phrase. Other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import partial
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemill.llm.shared import new_folder, open_store, stage, write_file
from lakemill.llm.words import buffers, mix

SHARDS, THRESHOLD, TOP, WITHIN = 2, 10, 2000, 50
SLICE = 6 << 20
#: Parts of a table of cells, the least and the largest number of its cells, and bytes of text for each.
PARTS, LEAST_CELLS, MOST_CELLS, BYTES_PER_CELL = 16, 1 << 20, 1 << 28, 32
NEVER = 255
#: All ends of pieces become one byte that no word can hold.
_ENDS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", b"." * 10)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class Step(NamedTuple):
    """What a scan task must know: the step, the lengths that can be active, and the table's files as they are now."""

    number: int
    shards: int
    lengths: tuple[int, ...]
    folder: str
    cells: int
    files: dict[tuple[int, int], str]


def word_hash(lang: bytes, word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(lang + b"\0" + word)


def phrase_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * _FACTOR + second)


def cells_of(keys: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    mixed, mask = mix(keys), np.uint64(cells - 1)
    return (mixed & mask).astype(np.int64), (mixed >> np.uint64(32) & mask).astype(np.int64)


class Table:
    """In which step keys of one length reached the threshold (NEVER: not yet)."""

    def __init__(self, step: Step, length: int):
        self.cells = step.cells
        self.steps = np.full(step.cells, NEVER, np.uint8)
        store, base = open_store(step.folder)
        size = step.cells // PARTS
        for (of, part), name in step.files.items():
            if of == length:
                with store.open_input_stream(f"{base}/{name}", compression=None) as source:
                    self.steps[part * size : (part + 1) * size] = np.frombuffer(source.read(), np.uint8)

    def reached(self, keys: np.ndarray) -> np.ndarray:
        one, other = cells_of(keys, self.cells)
        return np.maximum(self.steps[one], self.steps[other])


_tables: dict[str, tuple[int, dict[int, Table]]] = {}


def table_of(step: Step, length: int) -> Table:
    """A worker's copy of a table; those of earlier steps are dropped."""
    number, held = _tables.get(step.folder, (-1, {}))
    if number != step.number:
        held = {}
        _tables.clear()
        _tables[step.folder] = (step.number, held)
    if length not in held:
        held[length] = Table(step, length)
    return held[length]


PHRASES = pa.schema([
    ("lang", pa.string()), ("length", pa.int32()), ("phrase", pa.string()), ("since", pa.int32()), ("n", pa.int64()),
])


def _rows(lang: str, names: pa.Array, columns: list[np.ndarray], reached: np.ndarray | None = None) -> pa.RecordBatch:
    """Distinct phrases, given by columns of word numbers, the step they are active from, and how often each occurs.

    ``reached``: the step before that one, for each occurrence (null: active from step 0).
    """
    key = columns[0]
    for column in columns[1:]:  # numbers stay below occurrences times words
        if len(columns) == 3 and column is columns[2] and len(names) >= 1 << 21:
            key = np.unique(key, return_inverse=True)[1]
        key = key * len(names) + column
    _, first, many = np.unique(key, return_index=True, return_counts=True)
    words = [names.take(pa.array(c[first])) for c in columns]
    phrase = words[0] if len(words) == 1 else pc.binary_join_element_wise(*words, pa.scalar(b" ", pa.binary()))
    lengths = pa.array(np.full(len(first), len(columns), np.int32))
    since = np.zeros(len(first), np.int32) if reached is None else reached[first].astype(np.int32) + 1
    langs = pa.array([lang] * len(first), pa.string())
    return pa.RecordBatch.from_arrays([langs, lengths, phrase.cast(pa.string()), pa.array(since, pa.int32()), pa.array(many)], schema=PHRASES)


def _count_part(step: Step, lang: str, text: bytes) -> Iterator[pa.RecordBatch]:
    """Counts of the active phrases in texts of one language, parted by ends of pieces."""
    numbers = defaultdict(count().__next__)
    numbers[b"."]
    words = text.lower().translate(_ENDS).replace(b".", b" . ").split()
    code = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    del words
    names = pa.array(list(numbers), pa.binary())
    if 1 in step.lengths and len(numbers) > 1:
        yield _rows(lang, names, [code[code > 0]])
    if max(step.lengths) == 1:
        return
    own = lang.encode()
    keys = np.fromiter((word_hash(own, w) for w in numbers), np.uint64, len(numbers))
    reached = table_of(step, 1).reached(keys)
    reached[0] = NEVER
    frequent = (reached < step.number)[code]
    at = np.flatnonzero(frequent[:-1] & frequent[1:])
    left, right = code[at], code[at + 1]
    since = step.number - step.shards  # activated by a step before: counted for a whole cycle
    both = np.maximum(reached[left], reached[right]).astype(np.int64)
    if 2 in step.lengths:
        active = both >= since
        if active.any():
            yield _rows(lang, names, [left[active], right[active]], both[active])
    if 3 in step.lengths:
        both = np.maximum(both, table_of(step, 2).reached(phrase_hash(keys[left], keys[right])))
        latest = np.maximum(both[:-1], both[1:])
        active = np.flatnonzero((at[1:] == at[:-1] + 1) & (latest < step.number) & (latest >= since))
        if len(active):
            yield _rows(lang, names, [left[active], right[active], right[active + 1]], latest[active])


def _count(step: Step, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = batch.column(0).to_pylist()
        _, at = buffers(batch.column(1))
        low = 0
        while low < len(langs):
            high = max(low + 1, int(np.searchsorted(at, at[low] + SLICE, "right")) - 1)
            data, place = buffers(batch.column(1).slice(low, high - low))
            raw, ends, parts = data.tobytes(), place.tolist(), defaultdict(list)
            for k in range(high - low):
                parts[langs[low + k]].append(raw[ends[k] : ends[k + 1]])
            for lang, texts in parts.items():
                yield from _count_part(step, lang, b".".join(texts))
            low = high


def _cells(cells: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slot (length and part of the table) and cells of phrases that reached the threshold."""
    size = cells // PARTS
    for batch in batches:
        rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
        words: tuple[list, list] = ([], [])
        pairs: list[tuple[int, int]] = []
        for lang, length, phrase in rows:
            own, split = lang.encode(), phrase.encode().split(b" ")
            hashes = [word_hash(own, w) for w in split]
            if length == 1:
                words[0].append(hashes[0])
            else:
                pairs.append(tuple(hashes))
        both = np.array(pairs, np.uint64).reshape(-1, 2)
        for length, keys in ((1, np.array(words[0], np.uint64)), (2, phrase_hash(both[:, 0], both[:, 1]))):
            cell = np.unique(np.concatenate(cells_of(keys, cells)))
            slot = (length * PARTS + cell // size).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(cell % size)], names=["slot", "cell"])


def _write_cells(step: Step, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Set the cells that no earlier step has set; each slot is one file."""
    parts: dict[int, np.ndarray] = {}
    store, base = open_store(step.folder)
    size = step.cells // PARTS
    for batch in batches:
        slots, cells = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for slot in np.unique(slots).tolist():
            if slot not in parts:
                name = step.files.get((slot // PARTS, slot % PARTS))
                parts[slot] = np.full(size, NEVER, np.uint8)
                if name is not None:
                    with store.open_input_stream(f"{base}/{name}", compression=None) as source:
                        parts[slot] = np.frombuffer(source.read(), np.uint8).copy()
            mine = cells[slots == slot]
            parts[slot][mine] = np.minimum(parts[slot][mine], step.number)
    for slot, steps in parts.items():
        name = f"step-{step.number}-slot-{slot}-{TaskContext.get().attemptNumber()}"
        write_file(step.folder, name, [steps.tobytes()])
        yield pa.RecordBatch.from_arrays([pa.array([slot // PARTS], pa.int32()), pa.array([slot % PARTS], pa.int32()), pa.array([name])], names=["length", "part", "name"])


def staged_shards(df: DataFrame, shards: int) -> DataFrame:
    """lang, text and shard of all rows, stored by shard; rows are dealt out in turn, so shards are even."""
    spark, folder = df.sparkSession, new_folder(df.sparkSession, "shards")
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    rows = df.select(lang, text).withColumn("shard", F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int"))
    rows.write.mode("overwrite").partitionBy("shard").parquet(folder)
    return spark.read.schema("lang string, text string, shard int").parquet(folder)


def count_phrases(
    df: DataFrame, threshold: int = THRESHOLD, shards: int = SHARDS, cells: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(lang, length, phrase, n) of the words and phrases that occur at least ``threshold`` times, and (lang, n) of all words.

    One job per step runs while this is built, and a small one that adds to the table. What has completed its cycle below
    the threshold is left out of the next step. ``cells``: size of the table, a power of two.
    """
    spark = df.sparkSession
    texts = staged_shards(df, shards)
    if cells is None:
        size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        cells = min(MOST_CELLS, max(LEAST_CELLS, 1 << (size // BYTES_PER_CELL).bit_length()))
    folder, files = new_folder(spark, "reached"), {}
    reached: dict[int, set[int]] = {1: set(), 2: set()}  # steps in which keys of a length reached the threshold
    state, totals, number = None, None, 0
    while True:
        recent = range(max(0, number - shards), number)
        lengths = [1] if number < shards else []
        lengths += [length + 1 for length in (1, 2) if reached[length].intersection(recent)]
        if not lengths:
            return state.where(F.col("n") >= threshold).select("lang", "length", "phrase", "n"), totals
        step = Step(number, shards, tuple(lengths), folder, cells, dict(files))
        found = texts.where(F.col("shard") == number % shards).select("lang", "text").mapInArrow(
            partial(_count, step), "lang string, length int, phrase string, since int, n long"
        )
        rows = found.withColumn("before", F.lit(0).cast("long"))
        if state is not None:
            rows = rows.unionByName(state.withColumn("before", F.col("n")).select(rows.columns))
        counts = rows.groupBy("lang", "length", "phrase", "since").agg(F.sum("n").alias("n"), F.sum("before").alias("before"))
        state = stage(counts, f"counts-{number}")
        new = state.where((F.col("before") < threshold) & (F.col("n") >= threshold) & (F.col("length") < 3))
        slots = new.select("lang", "length", "phrase").mapInArrow(partial(_cells, cells), "slot int, cell long")
        written = slots.distinct().repartition("slot").mapInArrow(partial(_write_cells, step), "length int, part int, name string")
        for length, part, name in written.collect():  # at most two times PARTS names
            files[length, part] = name
            reached[length].add(number)
        if number == shards - 1:
            totals = stage(state.where("length = 1").groupBy("lang").agg(F.sum("n").alias("n")), "totals")
        state = state.drop("before").where((F.col("n") >= threshold) | (F.col("since") + shards - 1 > number))
        number += 1


def phrase_scores(counts: DataFrame, within: int = WITHIN) -> DataFrame:
    """lang, phrase, a, l, r, score of the candidates that no longer candidate absorbs.

    The cut with the lowest score counts. ``within``: a candidate goes if a longer one holds its words and occurs at least
    that many times in a hundred of its occurrences.
    """
    words = F.split("phrase", " ")
    candidates = counts.where("length > 1").withColumn("words", words)
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("length") - 1)))
    cuts = cuts.select(
        "lang", "length", "phrase", F.col("n").alias("a"), "k",
        F.array_join(F.expr("slice(words, 1, k)"), " ").alias("first"),
        F.array_join(F.expr("slice(words, k + 1, length - k)"), " ").alias("rest"),
    )
    parts = counts.where("length < 3").select("lang", "phrase", "n")
    left = parts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    exact = "CAST(CAST(1000000 AS decimal(7,0)) * CAST(a AS decimal(19,0)) * CAST(a AS decimal(19,0)) DIV (CAST(l AS decimal(19,0)) * CAST(r AS decimal(19,0))) AS bigint)"
    lowest = F.min(F.struct(F.expr(exact).alias("score"), "k", "l", "r")).alias("cut")
    best = scored.groupBy("lang", "length", "phrase", "a").agg(lowest)
    inside = candidates.where("length = 3").select(
        "lang", F.col("n").alias("longer"),
        F.explode(F.array_distinct(F.array(F.array_join(F.slice("words", 1, 2), " "), F.array_join(F.slice("words", 2, 2), " ")))).alias("phrase"),
    )
    inside = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = best.join(inside, ["lang", "phrase"], "left").where(f"longer IS NULL OR 100 * longer < {within} * a")
    return kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def collocations(df: DataFrame, threshold: int = THRESHOLD, top: int = TOP, shards: int = SHARDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the first ``top`` phrases of each language."""
    counts, totals = count_phrases(df, threshold, shards)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = phrase_scores(counts).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
