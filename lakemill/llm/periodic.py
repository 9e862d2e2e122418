"""Runs of words: maximal periodic stretches, found with suffix trees of a text and its reversal.

A run is a stretch of consecutive words with smallest period q, at least max(LEAST, TIMES * q) words long, that no
neighbouring word extends with that period. How runs are found:

- Ukkonen's algorithm builds the suffix tree of the words and that of their reversal, online, with suffix links.
- A tour of each tree visits the leaves in the order of their suffixes. Between two neighbouring leaves it keeps the least
  string depth it comes by, that of their lowest common ancestor; a sparse table over these answers in constant time how
  far the suffixes at two places agree (LCE), for many pairs at once.
- The longest Lyndon word at a place ends where the next suffix begins that is smaller; under the reversed alphabet, that
  is greater. Each run has such a word of one period's length as a root, so two candidates per place are enough. A
  candidate is extended to the right by the first tree and to the left by the second.

Texts of a few documents share a pair of trees. Their words count as different symbols in each document, and a symbol that
occurs once lies around each stretch, so nothing is compared across texts. Trees are built for the stretches of a text
that can hold a run: in a run each four-word gram occurs at least three times (twice if the period is two words), so places
whose gram does not, in the whole text and then in the stretch they lie in, are left out, until nothing changes. That is
counted by hash, where a collision only keeps more places.

No shuffle; each text is handled whole by one task. Defined results: null, empty and white texts have no words and no
runs; very long texts are handled whole, with a tree of their own; each of repeated rows gets its result; a null doc_id
counts as no id, so the text is taken as it is. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import partial
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.llm.words import buffers, mix, ranges

LEAST, TIMES, GRAM = 6, 4, 4
#: Bytes of texts whose words are numbered together, and words that share a pair of trees.
SLICE, TREE = 2 << 20, 1 << 16


class SuffixTree:
    """Suffix tree of a list of symbols whose last one occurs once.

    ``edges`` maps node * n_symbols + first symbol to a child. Inner nodes count from 0, the root; the leaf of suffix k
    is -1 - k. ``begin`` and ``end`` hold the labels of inner nodes, ``leaf_begin`` where those of the leaves begin.
    """

    def __init__(self, symbols: list[int], n_symbols: int):
        begin, end, link, leaf_begin, edges = [0], [0], [0], [], {}
        node, edge, length, first = 0, 0, 0, 0  # the active point, and the next suffix to add
        for at, symbol in enumerate(symbols):
            waiting = -1  # an inner node that has no suffix link yet
            while first <= at:
                if length == 0:
                    edge = at
                key = node * n_symbols + symbols[edge]
                child = edges.get(key)
                if child is None:
                    edges[key] = -1 - first
                    leaf_begin.append(at)
                    if waiting >= 0:
                        link[waiting], waiting = node, -1
                else:
                    if child >= 0:
                        low = begin[child]
                        size = end[child] - low
                        if length >= size:
                            node, edge, length = child, edge + size, length - size
                            continue
                    else:
                        low = leaf_begin[-1 - child]
                    if symbols[low + length] == symbol:
                        length += 1
                        if waiting >= 0:
                            link[waiting] = node
                        break
                    middle = len(begin)
                    begin.append(low)
                    end.append(low + length)
                    link.append(0)
                    edges[key] = middle
                    edges[middle * n_symbols + symbol] = -1 - first
                    leaf_begin.append(at)
                    low += length
                    if child >= 0:
                        begin[child] = low
                    else:
                        leaf_begin[-1 - child] = low
                    edges[middle * n_symbols + symbols[low]] = child
                    if waiting >= 0:
                        link[waiting] = middle
                    waiting = middle
                first += 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = first
        self.n, self.n_symbols = len(symbols), n_symbols
        self.begin, self.end, self.leaf_begin, self.edges = begin, end, leaf_begin, edges

    def tour(self) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in order, and the string depth of the lowest common ancestor of each with the next one."""
        keys = np.fromiter(self.edges.keys(), np.int64, len(self.edges))
        order = np.argsort(keys)
        children = np.fromiter(self.edges.values(), np.int64, len(keys))[order]
        place = np.searchsorted(keys[order], np.arange(len(self.begin) + 1) * self.n_symbols).tolist()
        children, begin, end = children.tolist(), self.begin, self.end
        suffixes, depths, low = [], [], 0
        waiting = [(0, 0, 0)]  # node, string depth of its parent, depth of the tour before it
        while waiting:
            node, above, before = waiting.pop()
            if before >= 0:
                low = before
            if node < 0:
                suffixes.append(-1 - node)
                depths.append(low)
                continue
            depth = above + end[node] - begin[node]
            a, b = place[node], place[node + 1]
            for k in range(b - 1, a, -1):
                waiting.append((children[k], depth, depth))
            waiting.append((children[a], depth, -1))
        return np.array(suffixes, np.int64), np.array(depths[1:], np.int32)


class Extensions:
    """How far the suffixes at two places agree, in constant time from a sparse table of least depths."""

    def __init__(self, symbols: list[int], n_symbols: int):
        suffixes, depths = SuffixTree(symbols, n_symbols).tour()
        self.rank = np.empty(len(suffixes), np.int64)
        self.rank[suffixes] = np.arange(len(suffixes))
        self.table = np.zeros((max(1, len(depths)).bit_length(), len(depths)), np.int32)
        self.table[0] = depths
        for k in range(1, len(self.table)):
            half = 1 << k - 1
            self.table[k, : len(depths) - 2 * half + 1] = np.minimum(
                self.table[k - 1, : len(depths) - 2 * half + 1], self.table[k - 1, half : len(depths) - half + 1]
            )

    def __call__(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        a, b = self.rank[one], self.rank[other]
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp(high - low)[1] - 1  # the largest power of two that is not above the distance
        return np.minimum(self.table[level, low], self.table[level, high - (1 << level)]).astype(np.int64)


def next_smaller(ranks: list[int]) -> list[int]:
    """For each place the next one with a smaller rank (the length if there is none)."""
    out, stack = [0] * len(ranks), []
    for at in range(len(ranks) - 1, -1, -1):
        rank = ranks[at]
        while stack and ranks[stack[-1]] > rank:
            stack.pop()
        out[at] = stack[-1] if stack else len(ranks)
        stack.append(at)
    return out


def runs_of(symbols: np.ndarray, n_symbols: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs, by start and period. The first and the last symbol occur once."""
    n, listed = len(symbols), symbols.tolist()
    ahead = Extensions(listed, n_symbols)
    back = Extensions(listed[::-1], n_symbols)
    ranks = ahead.rank.tolist()
    place = np.arange(n)
    one = np.concatenate([place, place])
    other = np.concatenate([next_smaller(ranks), next_smaller([-r for r in ranks])])
    near = (other < n) & (one > 0) & ((other - one) * TIMES <= n)
    one, other = one[near], other[near]
    period = other - one
    end = other + ahead(one, other)
    start = one - back(n - one, n - other)
    whole = end - start >= np.maximum(LEAST, TIMES * period)
    found = np.unique(np.stack([start[whole], period[whole], end[whole]], 1), axis=0)
    return found[:, 0], found[:, 2] - found[:, 0], found[:, 1]


class Runs(NamedTuple):
    text: np.ndarray
    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def stretches(codes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the stretches of words begin that can hold a run, and how many words they have."""
    n = max(0, len(codes) - GRAM + 1)
    gram = np.zeros(n, np.uint64)
    for k in range(GRAM):
        gram = gram * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + n].astype(np.uint64)
    twice = (codes[:n] == codes[2 : 2 + n]) & (codes[1 : 1 + n] == codes[3 : 3 + n])
    at = np.flatnonzero(text[:n] == text[GRAM - 1 :][:n])
    part = text[at]
    while len(at):
        _, inverse, many = np.unique(mix(gram[at] + part.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)), return_inverse=True, return_counts=True)
        good = (many >= TIMES - 1)[inverse] | (many >= 2)[inverse] & twice[at]
        left, part = at[good], part[good]
        new = np.ones(len(left), bool)
        new[1:] = (left[1:] != left[:-1] + 1) | (part[1:] != part[:-1])
        part = np.cumsum(new) - 1
        long = (np.bincount(part) >= LEAST - GRAM + 1)[part] if len(part) else np.zeros(0, bool)
        left, part = left[long], part[long]
        if len(left) == len(at):
            first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            return at[first], np.diff(np.append(first, len(at))) + GRAM - 1
        at = left
    return np.zeros(0, np.int64), np.zeros(0, np.int64)


def find_runs(codes: np.ndarray, text: np.ndarray, bound: int = TREE) -> Runs:
    """Runs of many texts: ``codes`` are their words as numbers, ``text`` tells which text a word lies in."""
    begin, size = stretches(codes, text)
    empty = np.zeros(0, np.int64)
    found = [(empty, empty, empty)]
    low, first = 0, np.searchsorted(text, text)
    while low < len(begin):
        total = np.cumsum(size[low:] + 1)
        high = low + max(1, int(np.searchsorted(total, bound, "right")))
        b, s = begin[low:high], size[low:high]
        words = ranges(b, s)
        symbols, n = np.unique(np.stack([text[words], codes[words]]), axis=1, return_inverse=True)
        n = n.ravel()
        place = np.cumsum(s + 1) - s  # one symbol that occurs once before each stretch, and one at the end
        whole = np.empty(len(words) + len(b) + 1, np.int64)
        whole[ranges(place, s)] = n
        whole[np.append(place - 1, len(whole) - 1)] = symbols.shape[1] + np.arange(len(b) + 1)
        start, length, period = runs_of(whole, symbols.shape[1] + len(b) + 1)
        of = np.searchsorted(place, start, "right") - 1
        found.append((b[of] + start - place[of], length, period))
        low = high
    start, length, period = map(np.concatenate, zip(*found, strict=True))
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    return Runs(text[start], start - first[start], length, period)


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """Which word stands at each place where a text is made periodic for a check; null if it isn't."""
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is None or h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    place = np.arange(n)
    return np.where(place < a, place, a + (place - a) % p)


SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()),
    ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string()),
])
Placing = Callable[[int | None, int], "np.ndarray | None"]


def collapse(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Places of the words that stay when each run is cut to its first period."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, start + period, 1)
    np.add.at(steps, start + length, -1)
    return np.flatnonzero(np.cumsum(steps[:n]) == 0)


def _periodic(placing: Placing | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_pylist()
        _, at = buffers(batch.column(1))
        low = 0
        while low < len(ids):
            high = max(low + 1, int(np.searchsorted(at, at[low] + SLICE, "right")) - 1)
            data, place = buffers(batch.column(1).slice(low, high - low))
            raw, ends = data.tobytes(), place.tolist()
            texts = [raw[a:b].split() for a, b in zip(ends, ends[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(_found(ids[low:high], texts, placing), schema=SCHEMA)
            low = high


def _found(ids: list[int | None], texts: list[list[bytes]], placing: Placing | None) -> list[pa.Array]:
    """Result columns of some texts, given as lists of words."""
    numbers = defaultdict(count().__next__)
    codes, order = [np.zeros(0, np.int64)], []
    for doc_id, words in zip(ids, texts, strict=True):
        own = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        order.append(placing(doc_id, len(words)) if placing else None)
        codes.append(own if order[-1] is None else own[order[-1]])
    numbers.clear()
    text = np.repeat(np.arange(len(texts)), [len(words) for words in texts])
    runs = find_runs(np.concatenate(codes), text)
    edges = np.searchsorted(runs.text, np.arange(len(texts) + 1)).tolist()
    rows = []
    for k, words in enumerate(texts):
        mine = slice(edges[k], edges[k + 1])
        start, length, period = runs.start[mine], runs.length[mine], runs.period[mine]
        best, kept, lines = (None,) * 4, words, b""
        if order[k] is not None:
            kept = [words[i] for i in order[k].tolist()]
        if len(start):
            lines = "".join(map("%d,%d,%d\n".__mod__, zip(start.tolist(), length.tolist(), period.tolist(), strict=True))).encode()
            top = np.lexsort((period, start, -length))[0]
            best = (*(int(x[top]) for x in (start, length, period)), int(1000 * length[top] // period[top]))
            kept = [kept[i] for i in collapse(len(words), start, length, period).tolist()]
        rows.append((ids[k], len(start), *best, hashlib.sha256(lines).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), SCHEMA, strict=True)]


def periodic_runs(df: DataFrame, placing: Placing | None = None) -> DataFrame:
    """Number of runs of every row's text, the longest one, and digests of all runs and of the text without repeats.

    ``placing``: from doc_id and number of words, which word stands at each place, to read texts in another order.
    """
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    return rows.mapInArrow(partial(_periodic, placing), schema)
