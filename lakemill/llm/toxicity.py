"""Toxicity scores by a factorization machine over hashed terms.

Terms are the lower-case words of a text and the first 3 to 7 bytes of longer words, as 64-bit hashes, each counted once
per text. Fitting takes a bounded sample of labelled texts (SAMPLE rows, the smallest by hash of doc_id): Spark counts
in how many toxic and other texts each term occurs, keeps the TERMS terms most associated with the label, and one task
fits weights and factors on the sample's few terms left. A score is the logistic of a linear part and of all pairwise
interactions, so that two terms together can weigh more than both alone.

Defined results: null and empty texts have no terms and get the score of the bias alone; texts without a usable label
are scored all the same; doc_ids with several labels are toxic if one label says so; repeated rows stay; without labels
of both kinds every score is 0. Other columns are not read.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.llm.shared import stage
from lakemill.llm.words import NOT_ALNUM, Hasher, mix, words

SAMPLE, TERMS, LEAST_TEXTS, LEAST_G2 = 20_000, 1 << 14, 3, 15.0
PREFIXES = (3, 4, 5, 6, 7)
FACTORS, EPOCHS, BATCH, RATE, DECAY = 8, 40, 256, 0.3, 1e-5
#: Slots of the table that finds a term's weights by its hash.
SLOT_BITS = 20


class Model(NamedTuple):
    terms: np.ndarray
    bias: float
    weight: np.ndarray
    factor: np.ndarray

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez_compressed(out, **self._asdict())
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Model:
        with np.load(io.BytesIO(data)) as file:
            return cls(file["terms"], float(file["bias"]), file["weight"], file["factor"])


def occurrences(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row and hash of every term of a batch, stretch by stretch; a term may come several times."""
    lower = pc.utf8_lower(texts.cast(pa.large_string()).fill_null(""))
    for part in words(lower, NOT_ALNUM, hashed=False):
        hashed, size = Hasher(part.data), part.end - part.start
        rows, keys = [part.row], [hashed(part.start, part.end)]
        for n in PREFIXES:
            longer = np.flatnonzero(size > n)
            start = part.start[longer]
            rows.append(part.row[longer])
            keys.append(mix(hashed(start, start + n) + np.uint64(n)))
        yield np.concatenate(rows), np.concatenate(keys)


def distinct(row: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((key, row))
    row, key = row[order], key[order]
    first = np.ones(len(row), bool)
    first[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
    return row[first], key[first]


class Finder:
    """Numbers of known terms among many hashes: one look into a table, then a check of the whole hash."""

    def __init__(self, terms: np.ndarray):
        self.terms, self.slots = terms, np.full(1 << SLOT_BITS, -1, np.int32)
        slot = (terms >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        self.slots[slot] = np.arange(len(terms))
        #: terms whose slot another one took
        self.more = np.flatnonzero(self.slots[slot] != np.arange(len(terms)))
        self.more = self.more[np.argsort(terms[self.more])]

    def __call__(self, row: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        number = self.slots[(key >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]
        taken = np.flatnonzero(number >= 0)
        same = self.terms[number[taken]] == key[taken]
        rows, numbers = row[taken[same]], number[taken[same]].astype(np.int64)
        if len(self.more):
            other = taken[~same]
            known = self.terms[self.more]
            at = np.minimum(np.searchsorted(known, key[other]), len(known) - 1)
            hit = known[at] == key[other]
            rows, numbers = np.append(rows, row[other[hit]]), np.append(numbers, self.more[at[hit]])
        return rows, numbers


def active(texts: pa.Array, finder: Finder) -> tuple[np.ndarray, np.ndarray]:
    """Known terms of each text of a batch, each once: rows in ascending order, and numbers."""
    size = np.int64(max(1, len(finder.terms)))
    pairs = [np.zeros(0, np.int64)]
    for row, key in occurrences(texts):
        rows, numbers = finder(row, key)
        pairs.append(np.unique(rows * size + numbers))
    pair = np.unique(np.concatenate(pairs))
    return pair // size, pair % size


def margins(row: np.ndarray, number: np.ndarray, count: int, bias: float, weight: np.ndarray, factor: np.ndarray):
    """The machine's value for each of ``count`` rows, and the sums of factors it is made of."""
    sums = np.stack([np.bincount(row, factor[number, f], count) for f in range(factor.shape[1])], 1)
    squares = np.bincount(row, (factor * factor).sum(1)[number], count)
    return bias + np.bincount(row, weight[number], count) + 0.5 * ((sums * sums).sum(1) - squares), sums


def fit(row: np.ndarray, number: np.ndarray, label: np.ndarray, terms: np.ndarray) -> Model:
    """Weights and factors by AdaGrad on the logistic loss; rows ascend."""
    rng, size = np.random.default_rng(0), len(terms)
    share = float(np.clip(label.mean(), 1e-6, 1 - 1e-6))
    bias, weight = float(np.log(share / (1 - share))), np.zeros(size)
    factor = rng.normal(0, 0.05, (size, FACTORS))
    seen_w, seen_f, seen_b = np.full(size, 1e-8), np.full((size, FACTORS), 1e-8), 1e-8
    begin = np.searchsorted(row, np.arange(len(label) + 1))
    for _ in range(EPOCHS):
        order = rng.permutation(len(label))
        for low in range(0, len(order), BATCH):
            batch = order[low : low + BATCH]
            many = begin[batch + 1] - begin[batch]
            at = np.repeat(begin[batch] - (np.cumsum(many) - many), many) + np.arange(many.sum())
            local, term = np.repeat(np.arange(len(batch)), many), number[at]
            value, sums = margins(local, term, len(batch), bias, weight, factor)
            error = 1 / (1 + np.exp(-np.clip(value, -30, 30))) - label[batch]
            used, slot = np.unique(term, return_inverse=True)
            grad_b = error.sum()
            seen_b += grad_b**2
            bias -= RATE * grad_b / np.sqrt(seen_b)
            if not len(used):
                continue
            grad_w = np.bincount(slot, error[local], len(used)) + DECAY * weight[used]
            seen_w[used] += grad_w**2
            pull = error[local, None] * (sums[local] - factor[term])
            grad_f = np.stack([np.bincount(slot, pull[:, f], len(used)) for f in range(FACTORS)], 1) + DECAY * factor[used]
            seen_f[used] += grad_f**2
            weight[used] -= RATE * grad_w / np.sqrt(seen_w[used])
            factor[used] -= 0.2 * RATE * grad_f / np.sqrt(seen_f[used])
    return Model(terms, bias, weight.astype(np.float32), factor.astype(np.float32))


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """(text, toxic) of at most ``rows`` labelled texts; only that many labels are broadcast.

    Of rows with one id the one with the smallest text is taken, so repeated ids don't add to the sample.
    """
    marked = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    some = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    found = texts.join(F.broadcast(some), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    return found.select("doc_id", "text", F.col("toxic").cast("long").alias("toxic"))


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many toxic and other texts hold a term, summed over some texts at a time."""
    for batch in batches:
        for low in range(0, len(batch), 256):
            rows = batch.slice(low, 256)
            toxic = rows.column(1).to_numpy().astype(np.int64)
            parts = [(np.zeros(0, np.int64), np.zeros(0, np.uint64)), *occurrences(rows.column(0))]
            row, key = distinct(*map(np.concatenate, zip(*parts, strict=True)))
            term, slot, many = np.unique(key, return_inverse=True, return_counts=True)
            hit = np.bincount(slot, toxic[row], len(term)).astype(np.int64)
            columns = [pa.array(term.view(np.int64)), pa.array(hit), pa.array(many - hit)]
            yield pa.RecordBatch.from_arrays(columns, names=["term", "toxic", "other"])


def association(toxic: Column, other: Column, all_toxic: int, all_other: int) -> Column:
    """G2 statistic of a term's two-by-two table."""
    total = all_toxic + all_other

    def cell(seen: Column, share: float, margin: Column) -> Column:
        expected = margin * share
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    with_term, without = toxic + other, F.lit(total) - toxic - other
    p, q = all_toxic / total, all_other / total
    return 2 * (
        cell(toxic, p, with_term) + cell(other, q, with_term)
        + cell(F.lit(all_toxic) - toxic, p, without) + cell(F.lit(all_other) - other, q, without)
    )


def _terms_of(terms: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    finder = Finder(terms)
    for batch in batches:
        row, number = active(batch.column(1), finder)
        at = np.searchsorted(row, np.arange(len(batch) + 1)).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(at), pa.array(number.astype(np.int32)))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), lists], names=["doc_id", "toxic", "terms"])


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> Model | None:
    """Fit on at most ``rows`` labelled texts; None if they don't hold both labels."""
    given = stage(sample(docs, labels, rows), "labelled")
    count = {r["toxic"]: r["count"] for r in given.groupBy("toxic").count().collect()}
    if len(count) < 2:
        return None
    counted = given.select("text", "toxic").mapInArrow(_term_counts, "term long, toxic long, other long")
    counted = counted.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    worth = association(F.col("toxic"), F.col("other"), count[1], count[0])
    best = counted.where(f"toxic + other >= {LEAST_TEXTS}").select("term", worth.alias("g2")).where(f"g2 >= {LEAST_G2}")
    chosen = best.orderBy(F.col("g2").desc(), "term").limit(TERMS).select("term").collect()
    terms = np.sort(np.array([r["term"] for r in chosen], np.int64).view(np.uint64))

    def fitted(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("doc_id", kind="stable")
        many = np.array([len(x) for x in frame["terms"]], np.int64)
        number = np.concatenate([np.zeros(0, np.int64), *frame["terms"]]).astype(np.int64)
        model = fit(np.repeat(np.arange(len(frame)), many), number, frame["toxic"].to_numpy(np.float64), terms)
        return pd.DataFrame({"model": [model.dump()]})

    features = given.select("doc_id", "text", "toxic").mapInArrow(
        partial(_terms_of, terms), "doc_id long, toxic long, terms array<int>"
    )
    row = features.withColumn("__all", F.lit(0)).groupBy("__all").applyInPandas(fitted, "model binary").first()
    return Model.load(bytes(row["model"]))


def probabilities(texts: pa.Array, model: Model, finder: Finder) -> np.ndarray:
    value, _ = margins(*active(texts, finder), len(texts), model.bias, model.weight, model.factor)
    return 1 / (1 + np.exp(-np.clip(value, -500, 500)))


#: The table of the last model that this worker used.
_last: dict[str, object] = {}


def _score(model: Broadcast | None, text: int, batch: pa.RecordBatch) -> np.ndarray:
    if model is None:
        return np.zeros(len(batch))
    if model.value.terms is not _last.get("terms"):
        _last.update(terms=model.value.terms, finder=Finder(model.value.terms))
    return probabilities(batch.column(text), model.value, _last["finder"])


def _scored(model: Broadcast | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, len(batch), 1024):
            rows = batch.slice(low, 1024)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(_score(model, 1, rows))], names=["doc_id", "score"])


def score(df: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and score of each row's whole text; one pass, no shuffle. The model is bounded by TERMS."""
    sent = None if model is None else df.sparkSession.sparkContext.broadcast(model)
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(partial(_scored, sent), "doc_id long, score double")


def _kept(model: Broadcast | None, text: int, limit: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, len(batch), 1024):
            rows = batch.slice(low, 1024)
            yield rows.filter(pa.array(_score(model, text, rows) < limit))


def keep_clean(df: DataFrame, model: Model | None, text: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows, all columns, whose score is below ``limit``."""
    sent = None if model is None else df.sparkSession.sparkContext.broadcast(model)
    return df.mapInArrow(partial(_kept, sent, df.columns.index(text), limit), df.schema)
