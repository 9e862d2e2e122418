"""Words of UTF-8 texts as 64-bit hashes, for whole Arrow batches at a time.

A word is a run of bytes that are no separators. Its hash is a polynomial over the bytes modulo 2^64,
taken from running sums, then mixed; equal words hash alike in every batch and task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)
#: Space and the bytes 9 to 13.
WHITE = np.zeros(256, bool)
WHITE[[32, *range(9, 14)]] = True
#: Every ASCII byte that is neither a letter nor a digit.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
SAME = np.arange(256, dtype=np.uint8)
#: A-Z become a-z, all other bytes stay.
LOWER_AZ = SAME.copy()
LOWER_AZ[65:91] += 32


class Words(NamedTuple):
    """Words of a stretch of a batch: row, hash, and place in ``data``."""

    row: np.ndarray
    key: np.ndarray
    start: np.ndarray
    end: np.ndarray
    data: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


@cache
def _codes() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    if len(_powers.get(base, ())) < n:
        steps = np.full(max(n, PIECE_BYTES) + 1, base, np.uint64)
        steps[0] = 1
        _powers[base] = np.cumprod(steps)
    return _powers[base]


class Hasher:
    """Hashes of any byte ranges of one stretch of data."""

    def __init__(self, data: np.ndarray, lower: np.ndarray = SAME):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_codes()[lower[data]] * powers(_FACTOR, len(data))[: len(data)], out=sums[1:])
        self.sums, self.back = sums, powers(_INVERSE, len(data))

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.back[start]
        return mix(raw + (end - start).astype(np.uint64))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each begins; a null is an empty text."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def stretches(data: np.ndarray, at: np.ndarray, separators: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Cut the data of a batch into stretches of about ``size`` bytes, at texts or where separators follow a word."""
    low = 0
    while low < len(data):
        high = low + size
        if high >= len(data):
            high = len(data)
        else:
            inner = at[np.searchsorted(at, low, "right") : np.searchsorted(at, high, "right")]
            gap = separators[data[max(low, high - 4096) : high]]
            gaps = np.flatnonzero(gap[1:] & ~gap[:-1]) + 1
            if len(gaps):
                high = max(low, high - 4096) + int(gaps[-1])
            elif len(inner):
                high = int(inner[-1])
            else:  # a word longer than a stretch stays whole
                last = int(at[np.searchsorted(at, low, "right")])
                while high < last and not (separators[data[high]] and not separators[data[high - 1]]):
                    gap = separators[data[high - 1 : min(last, high + size)]]
                    gaps = np.flatnonzero(gap[1:] & ~gap[:-1])
                    high = high + int(gaps[0]) if len(gaps) else min(last, high + size)
        yield low, high
        low = high


def words(
    texts: pa.Array, separators: np.ndarray = WHITE, lower: np.ndarray = SAME, size: int = PIECE_BYTES,
    hashed: bool = True, apart: tuple[np.ndarray, np.ndarray] | None = None,
) -> Iterator[Words]:
    """Words of a batch in order, stretch by stretch; ``row`` counts the texts of the batch.

    ``apart``: two sets of bytes; a word also ends where a byte of one meets a byte of the other.
    """
    data, at = buffers(texts)
    for low, high in stretches(data, at, separators, size):
        part = data[low:high]
        inside = ~separators[part]
        edge = at[np.searchsorted(at, low) : np.searchsorted(at, high)] - low
        before = np.zeros(len(part), bool)
        before[1:] = inside[:-1]
        before[edge] = False
        if apart:
            one, other = apart[0][part], apart[1][part]
            before[1:] &= ~(one[:-1] & other[1:] | other[:-1] & one[1:])
        start = np.flatnonzero(inside & ~before)
        after = np.zeros(len(part), bool)
        after[:-1] = inside[1:] & before[1:]
        after[edge[edge > 0] - 1] = False
        end = np.flatnonzero(inside & ~after) + 1
        row = np.searchsorted(at, start + low, "right") - 1
        key = Hasher(part, lower)(start, end) if hashed else np.zeros(0, np.uint64)
        yield Words(row, key, start, end, part)


def runs(key: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins in a sorted array."""
    return np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All numbers of the ranges [start, start + length), one after another."""
    total = int(length.sum())
    before = np.cumsum(length) - length
    return np.repeat(start - before, length) + np.arange(total)


def documents(
    texts: pa.Array, separators: np.ndarray = WHITE, lower: np.ndarray = SAME, size: int = 2 * PIECE_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Word hashes of whole texts, some texts at a time: first text, number of texts, and row and hash per word.

    Rows count from the first text. A text larger than ``size`` comes alone; its bytes are still hashed in stretches.
    """
    _, at = buffers(texts)
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(at, at[low] + size, "right")) - 1)
        parts = list(words(texts.slice(low, high - low), separators, lower))
        row = np.concatenate([np.zeros(0, np.int64), *(p.row for p in parts)])
        yield low, high - low, row, np.concatenate([np.zeros(0, np.uint64), *(p.key for p in parts)])
        low = high
