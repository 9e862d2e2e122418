"""Language identification by interpolated Kneser-Ney character models.

A model per language predicts each letter of a lower-case word, and its end, from the up to ORDER - 1 letters before it
in the word. Spark counts all n-grams of all training texts; lower orders count how many different letters a gram
follows. All grams are kept. Each language's model is a file per range of hashes: a sorted array of gram hashes with
discounted shares, and one of context hashes with the mass left for the lower order. Files are mapped into memory when a
hash of their range is looked up. A text gets the language with the lowest cross-entropy per predicted
letter; it is rejected if it has no letter, or if that cross-entropy is far beyond what calibration texts of the
language show.

Defined results: null texts and texts without a letter are ``und`` with score 0 and are rejected; ties go to the first
language by name; training rows without text or language are not used; repeated rows count as often as they come;
without training rows all is ``und``. Other columns are not read.
"""

from __future__ import annotations

import json
import mmap
import shutil
import tempfile
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.llm.shared import new_folder, open_store, own_cache, stage, write_file
from lakemill.llm.tokens import Lookup
from lakemill.llm.words import SAME, mix, runs, words

ORDER = 5
UNKNOWN = "und"
#: Words begin behind this many pads and end with an end mark; both are no letters.
PAD, END = "\x02", "\x03"
#: Every ASCII byte that is no letter parts words.
NOT_LETTER = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])
#: Highest-order grams that a range of hashes holds at most on average; each range is written by a task and one file.
RANGE_GRAMS = 1 << 18
#: A rejected text costs GAP nats a letter more than its language's mean, and SLACK times the largest deviation.
SLACK, GAP = 1.5, 2.0
#: Sharpnesses that are tried, the columns of their losses, and the letters up to which a longer text weighs more.
STEPS = 2.0 ** np.arange(-3, 6)
LOSSES = [f"loss{k}" for k in range(len(STEPS))]
WEIGHED = 400.0
CACHED_WORDS = 1_500_000
HELD_GRAMS = 2_000_000
#: Bytes of text that are worked on at a time, and grams of a batch that goes to Spark.
PIECE, SENT_GRAMS = 1 << 20, 1 << 16


def letters(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(texts.cast(pa.large_string()).fill_null(""))


def pieces(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, about PIECE bytes of text at a time: what is derived from texts takes many times their size."""
    size = pc.binary_length(batch.column(text).cast(pa.large_string())).fill_null(0).to_numpy(zero_copy_only=False)
    end, low = np.cumsum(size, dtype=np.int64), 0
    while low < len(batch):
        before = int(end[low - 1]) if low else 0
        high = min(max(low + 1, int(np.searchsorted(end, before + PIECE, "right"))), low + 4096)
        yield batch.slice(low, high - low)
        low = min(high, len(batch))


def gram_windows(found: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the grams that end at each letter or end mark of the words, and the word of each."""
    joined = (PAD * (order - 1)) + (END + PAD * (order - 1)).join(found) + END
    points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    window = np.lib.stride_tricks.sliding_window_view(points, order)
    word = np.cumsum(points == ord(END)) - (points == ord(END))
    last = points[order - 1 :]
    place = np.flatnonzero(last != ord(PAD))
    return window[place], word[order - 1 :][place]


def gram_hash(window: np.ndarray) -> np.ndarray:
    value = np.full(len(window), window.shape[1] if window.ndim > 1 else 0, np.uint64)
    for k in range(window.shape[1]):
        value = (value * np.uint64(0x9E3779B97F4A7C15)) ^ mix(window[:, k].astype(np.uint64) + np.uint64(1))
    return mix(value)


def as_windows(grams: list[str]) -> np.ndarray:
    """Code points of grams of one length."""
    return np.array(grams, dtype="U").view("<u4").reshape(len(grams), -1)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Highest-order grams of (lang, text) rows, summed over as many texts as HELD_GRAMS allow."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
    waiting = 0

    def merge(lang: str) -> None:
        key, window, count = (np.concatenate(x) for x in zip(*held[lang], strict=True))
        key, first, slot = np.unique(key, return_index=True, return_inverse=True)
        held[lang] = [(key, window[first], np.bincount(slot, count, len(key)).astype(np.int64))]

    def flush() -> Iterator[pa.RecordBatch]:
        for lang in sorted(held):
            merge(lang)
            _, window, count = held.pop(lang)[0]
            for low in range(0, len(count), SENT_GRAMS):
                part = np.ascontiguousarray(window[low : low + SENT_GRAMS])
                grams = part.view(f"<U{ORDER}").ravel().tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams)), pa.array(grams), pa.array(count[low : low + SENT_GRAMS])], names=["lang", "gram", "n"]
                )

    for batch in (piece for whole in batches for piece in pieces(whole, 1)):
        langs = batch.column(0).dictionary_encode()
        names, code = langs.dictionary.to_pylist(), langs.indices.to_numpy()
        for part in words(letters(batch.column(1)), NOT_LETTER, size=1 << 21):
            raw = part.data.tobytes()
            for number, lang in enumerate(names):
                own = np.flatnonzero(code[part.row] == number)
                if not len(own):
                    continue
                _, first, times = np.unique(part.key[own], return_index=True, return_counts=True)
                places = zip(part.start[own[first]].tolist(), part.end[own[first]].tolist(), strict=True)
                window, word = gram_windows([raw[a:b].decode() for a, b in places], ORDER)
                key, first, slot = np.unique(gram_hash(window), return_index=True, return_inverse=True)
                count = np.bincount(slot, times[word], len(key)).astype(np.int64)
                held.setdefault(lang, []).append((key, window[first], count))
                waiting += len(key)
        if waiting > HELD_GRAMS:
            for lang in held:
                merge(lang)
            waiting = sum(len(x[0][0]) for x in held.values())
            if waiting > HELD_GRAMS // 2:
                yield from flush()
                waiting = 0
    if held:
        yield from flush()


def count_grams(rows: DataFrame) -> DataFrame:
    """(lang, gram, n) of the highest order over all rows of (lang, text)."""
    counted = rows.select("lang", F.col("text").cast("string").alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    return counted.mapInArrow(_count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def shares(counts: DataFrame, order: int) -> tuple[DataFrame, DataFrame]:
    """Discounted share of each gram in its context, and the mass each context leaves to the lower order."""
    once, twice = (F.sum(F.when(F.col("n") == k, 1).otherwise(0)) for k in (1, 2))
    share = F.try_divide(once, once + 2 * twice)  # null where a language shows no gram once or twice
    discount = counts.groupBy("lang").agg(F.greatest(F.lit(0.1), F.least(F.lit(0.95), share)).alias("d"))
    split = counts.withColumn("context", F.expr(f"substring(gram, 1, {order - 1})"))
    contexts = split.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
    contexts = contexts.join(F.broadcast(discount), "lang")
    grams = split.join(contexts, ["lang", "context"]).select(
        "lang", "gram", (F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("total")).alias("value")
    )
    return grams, contexts.select("lang", F.col("context").alias("gram"), (F.col("d") * F.col("kinds") / F.col("total")).alias("value"))


def range_of(key: np.ndarray, bits: np.ndarray | np.uint64) -> np.ndarray:
    """The first ``bits`` bits of hashes."""
    return (key >> np.uint64(1)) >> (np.uint64(63) - bits)


def _hashed(langs: list[str], bits: list[int], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of the language, range, kind, hash and value of (lang, order, kind, gram, value) rows."""
    number_of, all_bits = {lang: k for k, lang in enumerate(langs)}, np.array(bits, np.uint64)
    for batch in batches:
        lang, order, kind, gram, value = batch.columns
        own = lang.dictionary_encode()
        number = np.array([number_of[x] for x in own.dictionary.to_pylist()], np.int32)[own.indices.to_numpy()]
        context = pc.equal(kind, "context").to_numpy(zero_copy_only=False)
        size, key = order.to_numpy() - context, np.zeros(len(batch), np.uint64)
        for n in np.unique(size):
            rows = np.flatnonzero(size == n)
            window = as_windows(gram.take(pa.array(rows)).to_pylist()) if n else np.zeros((len(rows), 0), np.uint32)
            key[rows] = gram_hash(window)
        part = range_of(key, all_bits[number]).astype(np.int32)
        columns = [pa.array(number), pa.array(part), pa.array(context), pa.array(key.view(np.int64)), value.cast(pa.float32())]
        yield pa.RecordBatch.from_arrays(columns, names=["number", "part", "context", "key", "value"])


def train(rows: DataFrame) -> str | None:
    """Fit on all rows of (lang, text); returns the folder of the model files, None without rows."""
    spark = rows.sparkSession
    counts = stage(count_grams(rows), "grams")
    grams_of = dict(counts.groupBy("lang").count().collect())
    if not grams_of:
        return None
    langs = sorted(grams_of)
    bits = [((grams_of[lang] - 1) // RANGE_GRAMS).bit_length() for lang in langs]
    levels, level = [], counts
    for order in range(ORDER, 0, -1):
        level = level.withColumn("order", F.lit(order))
        grams, contexts = shares(level.select("lang", "gram", "n"), order)
        levels += [
            x.withColumns({"order": F.lit(order), "kind": F.lit(kind)}) for kind, x in (("gram", grams), ("context", contexts))
        ]
        if order > 1:
            shorter = level.select("lang", F.expr(f"substring(gram, 2, {order - 1})").alias("gram"))
            level = stage(shorter.groupBy("lang", "gram").agg(F.count(F.lit(1)).alias("n")), f"grams-{order - 1}")
    letters_of = dict(level.groupBy("lang").count().collect())
    model = levels[0]
    for more in levels[1:]:
        model = model.unionByName(more)
    folder = new_folder(spark, "language-models")

    def write(frame: pd.DataFrame) -> pd.DataFrame:
        number, part = int(frame["number"].iloc[0]), int(frame["part"].iloc[0])
        context, key = frame["context"].to_numpy(bool), frame["key"].to_numpy(np.int64).view(np.uint64)
        value, sizes, hashes, values = frame["value"].to_numpy(np.float32), [], [], []
        for own in (~context, context):
            by = np.argsort(key[own])
            sizes.append(len(by))
            hashes.append(key[own][by].astype("<u8").tobytes())
            values.append(value[own][by].astype("<f4").tobytes())
        write_file(folder, f"{number}-{part}.model", [np.array(sizes, "<i8").tobytes(), *hashes, *values])
        return pd.DataFrame({"number": [number], "part": [part]})

    hashed = model.select("lang", "order", "kind", "gram", "value").mapInArrow(
        partial(_hashed, langs, bits), "number int, part int, context boolean, key long, value float"
    )
    written = stage(hashed.groupBy("number", "part").applyInPandas(write, "number int, part int"), "languages")
    parts: list[list[int]] = [[] for _ in langs]
    for number, part in written.collect():
        parts[number].append(part)
    about = [{"lang": x, "bits": b, "letters": letters_of[x], "parts": sorted(p)} for x, b, p in zip(langs, bits, parts, strict=True)]
    write_file(folder, "languages.json", [json.dumps(about).encode()])
    return folder


def mapped(folder: str, name: str) -> np.ndarray:
    """Bytes of a file, mapped into memory; one that isn't local becomes a temporary file first."""
    store, base = open_store(folder)
    if isinstance(store, arrow_fs.LocalFileSystem):
        with open(f"{base}/{name}", "rb") as file:
            return np.frombuffer(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ, trackfd=False), np.uint8)
    with store.open_input_file(f"{base}/{name}") as file, tempfile.TemporaryFile() as copy:
        shutil.copyfileobj(file, copy)
        copy.flush()
        return np.frombuffer(mmap.mmap(copy.fileno(), 0, access=mmap.ACCESS_READ, trackfd=False), np.uint8)


class Models:
    """All languages' models, their files mapped when they are needed; words that were scored are kept."""

    def __init__(self, folder: str):
        store, base = open_store(folder)
        with store.open_input_file(f"{base}/languages.json") as file:
            about = json.loads(file.read())
        self.folder, self.langs = folder, [x["lang"] for x in about]
        self.bits, self.parts = [np.uint64(x["bits"]) for x in about], [set(x["parts"]) for x in about]
        self.alphabet = max(x["letters"] for x in about) + 1
        self.opened: dict[tuple[int, int], tuple[np.ndarray, ...]] = {}
        self.forget()

    def forget(self) -> None:
        self.known, self.cost, self.size = Lookup(), np.zeros((0, len(self.langs))), np.zeros(0)

    def learn(self, keys: np.ndarray, found: list[str]) -> np.ndarray:
        """Cost in nats of each word in each language, and its predicted letters; 0 for words without a letter."""
        cost, size = np.zeros((len(found), len(self.langs))), np.zeros(len(found))
        spoken = np.flatnonzero([any(c.isalpha() for c in x) for x in found])
        if len(spoken):
            window, word = gram_windows([found[k] for k in spoken], ORDER)
            share = np.full((len(window), len(self.langs)), 1.0 / self.alphabet)
            for order in range(1, ORDER + 1):
                gram, gram_slot = np.unique(gram_hash(window[:, ORDER - order :]), return_inverse=True)
                context, context_slot = np.unique(gram_hash(window[:, ORDER - order : -1]), return_inverse=True)
                for k in range(len(self.langs)):
                    here = self._find(k, 0, gram, 0.0)[gram_slot]
                    left = self._find(k, 1, context, 1.0)[context_slot]
                    share[:, k] = here + left * share[:, k]
            size[spoken] = np.bincount(word, minlength=len(spoken))
            for k in range(len(self.langs)):
                cost[spoken, k] = np.bincount(word, -np.log(share[:, k]), len(spoken))
        self.cost, self.size = np.concatenate([self.cost, cost]), np.concatenate([self.size, size])
        return self.known.add(keys)

    def _range(self, lang: int, part: int) -> tuple[np.ndarray, ...]:
        """Hashes of grams and of contexts of one range, and the values of both."""
        if (lang, part) not in self.opened:
            data = mapped(self.folder, f"{lang}-{part}.model")
            grams, contexts = data[:16].view("<i8").tolist()
            ends = np.cumsum([16, 8 * grams, 8 * contexts, 4 * grams, 4 * contexts])
            self.opened[lang, part] = tuple(
                data[a:b].view(kind) for a, b, kind in zip(ends[:-1], ends[1:], ("<u8", "<u8", "<f4", "<f4"), strict=True)
            )
        return self.opened[lang, part]

    def _find(self, lang: int, kind: int, keys: np.ndarray, other: float) -> np.ndarray:
        """Values of ascending hashes of grams (kind 0) or contexts (1); ``other`` for those not in the model."""
        out, part = np.full(len(keys), other), range_of(keys, self.bits[lang])
        first = runs(part).tolist()
        for low, high in zip(first, [*first[1:], len(keys)], strict=True):
            if int(part[low]) in self.parts[lang]:
                arrays = self._range(lang, int(part[low]))
                known, value = arrays[kind], arrays[kind + 2]
                if len(known):
                    at = np.minimum(np.searchsorted(known, keys[low:high]), len(known) - 1)
                    out[low:high] = np.where(known[at] == keys[low:high], value[at], other)
        return out

    def entropies(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per predicted letter of each text in each language, and the number of letters."""
        cost, size = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts))
        for part in words(letters(texts), NOT_LETTER, SAME, 1 << 21):
            if not len(part.key):
                continue
            keys, first, inverse = np.unique(part.key, return_index=True, return_inverse=True)
            if self.known.size > CACHED_WORDS:
                self.forget()
            slots = self.known.find(keys)
            if len(new := np.flatnonzero(slots < 0)):
                raw = part.data.tobytes()
                places = zip(part.start[first[new]].tolist(), part.end[first[new]].tolist(), strict=True)
                slots[new] = self.learn(keys[new], [raw[a:b].decode() for a, b in places])
            own = slots[inverse]
            size += np.bincount(part.row, self.size[own], len(texts))
            for k in range(len(self.langs)):
                cost[:, k] += np.bincount(part.row, self.cost[own, k], len(texts))
        return cost / np.maximum(size, 1)[:, None], size


def models(folder: str) -> Models:
    held = own_cache("langid")
    if folder not in held:
        held.clear()
        held[folder] = Models(folder)
    return held[folder]


class Calibration(NamedTuple):
    """Sharpness of the scores, and per language the mean cross-entropy and the largest deviation that is accepted."""

    sharpness: float
    mean: dict[str, float]
    limit: dict[str, float]


def deviation(entropy: np.ndarray, size: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """How far texts lie above the mean, in units that short and long texts share."""
    return (entropy - mean) * np.sqrt(np.minimum(size, WEIGHED))


def confidence(entropy: np.ndarray, size: np.ndarray, sharpness: float) -> np.ndarray:
    weight = -sharpness * np.sqrt(np.maximum(size, 1))[:, None] * (entropy - entropy.min(1, keepdims=True))
    share = np.exp(np.clip(weight, -700, 0))
    return share / share.sum(1, keepdims=True)


def _measured(folder: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each (lang, text) row with a letter: cross-entropy in its language, letters, and loss by sharpness."""
    number = {lang: k for k, lang in enumerate(models(folder).langs)}
    for batch in (piece for whole in batches for piece in pieces(whole, 1)):
        entropy, size = models(folder).entropies(batch.column(1))
        heard = np.flatnonzero(size > 0)
        langs, entropy, size = batch.column(0).take(pa.array(heard)), entropy[heard], size[heard]
        at = np.arange(len(heard)), np.array([number[x] for x in langs.to_pylist()], np.int64)
        losses = [-np.log(np.maximum(confidence(entropy, size, s)[at], 1e-12)) for s in STEPS]
        yield pa.RecordBatch.from_arrays([langs, *map(pa.array, (entropy[at], size, *losses))], names=["lang", "own", "size", *LOSSES])


def calibrate(rows: DataFrame, folder: str, most: int | None = None) -> Calibration | None:
    """From all training rows (lang, text, doc_id) with a letter; None if there is none, then nothing can be told.

    Texts of one language and of as many letters (400 or more are alike) become one row of sums, so at most 400 rows a
    language reach the driver. Repeated rows count as often as they come. ``most``: a caller may ask for no more ids than
    that, the smallest by hash, and of each the smallest row; the queries take all.
    """
    given = rows.where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "lang", F.col("text").cast("string").alias("text"))
    if most is not None:
        some = given.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        given = given.join(F.broadcast(some), "doc_id").groupBy("doc_id").agg(F.min(F.struct("lang", "text")).alias("row")).select("row.*")
    schema = ", ".join(["lang string", *(f"{x} double" for x in ("own", "size", *LOSSES))])
    got = given.select("lang", "text").mapInArrow(partial(_measured, folder), schema)
    frame = (
        got.groupBy("lang", F.least("size", F.lit(WEIGHED)).alias("size"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("own").alias("total"), F.max("own").alias("most"), *(F.sum(x).alias(x) for x in LOSSES))
        .orderBy("lang", "size")
        .toPandas()
    )
    if not len(frame):
        return None
    sharpness = float(STEPS[int(np.argmin(frame[LOSSES].to_numpy().sum(0)))])
    mean, limit = {}, {}
    for lang, cells in frame.groupby("lang"):
        mean[lang] = float(cells["total"].sum() / cells["n"].sum())
        limit[lang] = SLACK * float(deviation(cells["most"].to_numpy(), cells["size"].to_numpy(), np.float64(mean[lang])).max())
    return Calibration(sharpness, mean, limit)


def identify(texts: pa.Array, folder: str, calibration: Calibration) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Language, score and whether the text is accepted, of each text."""
    own = models(folder)
    entropy, size = own.entropies(texts)
    best = entropy.argmin(1)
    score = confidence(entropy, size, calibration.sharpness)[np.arange(len(best)), best]
    mean = np.array([calibration.mean.get(x, 0.0) for x in own.langs])[best]
    limit = np.array([max(0.0, calibration.limit.get(x, np.inf)) for x in own.langs])[best]
    heard = size > 0
    least = entropy[np.arange(len(best)), best]
    accepted = heard & ((least <= mean + GAP) | (deviation(least, size, mean) <= limit))
    return np.where(heard, np.array(own.langs, object)[best], UNKNOWN), np.where(heard, score, 0.0), accepted


def _predicted(folder: str, calibration: Calibration, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (piece for whole in batches for piece in pieces(whole, 1)):
        lang, score, accepted = identify(batch.column(1), folder, calibration)
        columns = [batch.column(0), pa.array(lang, pa.string()), pa.array(score), pa.array(accepted)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score", "accepted"])


def predict(df: DataFrame, folder: str | None, calibration: Calibration | None) -> DataFrame:
    """doc_id, lang_pred, score and accepted of each row's whole text; one pass, no shuffle."""
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if folder is None or calibration is None:
        return rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("accepted"))
    return rows.mapInArrow(partial(_predicted, folder, calibration), "doc_id long, lang_pred string, score double, accepted boolean")


def _kept(folder: str, calibration: Calibration, text: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (piece for whole in batches for piece in pieces(whole, text)):
        yield batch.filter(pa.array(identify(batch.column(text), folder, calibration)[2]))


def keep_known(df: DataFrame, folder: str | None, calibration: Calibration | None, text: str = "text") -> DataFrame:
    """The rows, all columns, whose language is accepted."""
    if folder is None or calibration is None:
        return df.limit(0)
    return df.mapInArrow(partial(_kept, folder, calibration, df.columns.index(text)), df.schema)
