"""Token ids of whole texts by a public tokenizer file, with each distinct word encoded once per worker.

The file's pre-tokenizer never joins characters across white space, nor ASCII letters or digits with punctuation other
than an apostrophe, and it ignores the case of letters. So the ids of a text are the ids of its words by these borders,
one after another. Words are looked up by hash; new ones go through the library.
"""

from __future__ import annotations

import os
from functools import cache

import numpy as np
import pyarrow as pa

from lakemill.llm.words import LOWER_AZ, Hasher, ranges, words

CACHED_WORDS = 2_500_000
#: Bytes that never share a pre-token. The characters of special tokens are left out: these are found in whole words.
APART = (
    np.array([b < 128 and chr(b).isalnum() for b in range(256)]),
    np.array([chr(b) in "!\"#$%&()*+,-./:;=?@[\\]^_`{}~" for b in range(256)]),
)


class Lookup:
    """Values of distinct keys: a sorted main part, and a small newer part that is merged in from time to time."""

    def __init__(self):
        self.keys, self.slots, self.new_keys, self.new_slots, self.size = *[np.zeros(0, t) for t in ("u8", "i8") * 2], 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        slots = np.full(len(keys), -1, np.int64)
        for known, values in ((self.keys, self.slots), (self.new_keys, self.new_slots)):
            if len(known):
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                hit = known[at] == keys
                slots[hit] = values[at[hit]]
        return slots

    def add(self, keys: np.ndarray) -> np.ndarray:
        slots = np.arange(self.size, self.size + len(keys))
        self.size += len(keys)
        merged = np.concatenate([self.new_keys, keys])
        order = np.argsort(merged)
        self.new_keys, self.new_slots = merged[order], np.concatenate([self.new_slots, slots])[order]
        if len(self.new_keys) > 50_000 + len(self.keys) // 8:
            merged = np.concatenate([self.keys, self.new_keys])
            order = np.argsort(merged)
            self.keys, self.slots = merged[order], np.concatenate([self.slots, self.new_slots])[order]
            self.new_keys, self.new_slots = self.new_keys[:0], self.new_slots[:0]
        return slots


class WordIds:
    """Ids of words; forgets all of them beyond CACHED_WORDS, so memory stays bounded."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.forget()

    def forget(self) -> None:
        self.known, self.flat = Lookup(), np.zeros(1 << 16, np.uint32)
        self.used, self.place, self.length = 0, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def learn(self, keys: np.ndarray, texts: list[str]) -> np.ndarray:
        got = [x.ids for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        length = np.fromiter(map(len, got), np.int64, len(got))
        total = int(length.sum())
        if self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.zeros(self.used + 2 * total, np.uint32)])
        self.flat[self.used : self.used + total] = [i for ids in got for i in ids]
        self.place = np.concatenate([self.place, self.used + np.cumsum(length) - length])
        self.length = np.concatenate([self.length, length])
        self.used += total
        return self.known.add(keys)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a batch in order, and their number per text."""
        out, count = [np.zeros(0, np.uint32)], np.zeros(len(texts), np.int64)
        for part in words(texts, lower=LOWER_AZ, size=1 << 21, apart=APART):
            if not len(part.key):
                continue
            marks = np.flatnonzero(part.data == ord("<"))
            if len(marks):  # special tokens do mind the case
                odd = np.unique(np.searchsorted(part.start, marks, "right") - 1)
                part.key[odd] = Hasher(part.data)(part.start[odd], part.end[odd])
            keys, first, inverse = np.unique(part.key, return_index=True, return_inverse=True)
            if self.known.size > CACHED_WORDS:
                self.forget()
            slots = self.known.find(keys)
            if len(new := np.flatnonzero(slots < 0)):
                raw = part.data.tobytes()
                at, to = part.start[first[new]].tolist(), part.end[first[new]].tolist()
                slots[new] = self.learn(keys[new], [raw[a:b].decode() for a, b in zip(at, to, strict=True)])
            length = self.length[slots][inverse]
            out.append(self.flat[ranges(self.place[slots][inverse], length)])
            count += np.bincount(part.row, length, len(texts)).astype(np.int64)
        return np.concatenate(out), count


@cache
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def default_path() -> str:
    """The word tokenizer's file on this machine; it is read, never copied."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def with_end(ids: np.ndarray, count: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids with the end id after each text, and the new number per text."""
    return np.insert(ids, np.cumsum(count), np.uint32(end_id)), count + 1


def id_bytes(ids: np.ndarray, length: np.ndarray) -> pa.Array:
    """Consecutive stretches of ids as little-endian unsigned 32-bit values, one binary value each."""
    at = np.zeros(len(length) + 1, np.int64)
    np.cumsum(length * 4, out=at[1:])
    data = pa.py_buffer(np.ascontiguousarray(ids, "<u4"))
    return pa.Array.from_buffers(pa.large_binary(), len(length), [None, pa.py_buffer(at), data]).cast(pa.binary())
