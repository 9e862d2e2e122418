"""Token counts by a byte-level BPE file: whole-token shortcut.

Offline, every string of the vocabulary is encoded on its own; those that give exactly one token are proved. In a
text, a pre-token that is proved counts as one; only the rest is merged by the library, once per distinct pre-token
and worker. Texts are cut before white space that follows something else, where the pre-tokenizer always cuts, and
distinct pieces are counted once.

Defined results: null and empty texts have 0 bytes and 0 tokens; repeated rows stay; other columns of the input are
not read.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.llm.tokens import Lookup
from lakemill.llm.words import WHITE, Hasher, buffers, stretches

#: Fixed value: the split pattern of the byte-level tokenizer.
PRE_TOKENS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
CACHED_WORDS = 1_000_000
#: Pieces with characters beyond the Latin blocks, or with what may begin a special token, are merged as they are.
PLAIN = regex.compile(r"(?:(?!<\|)[\t-\r -~¡-¬®-ɏ])*")
#: Texts with white space beyond ASCII are merged whole: they can't be cut as others can.
WIDE_SPACES = (
    "\x1c\x1d\x1e\x1f\x85\xa0\u1680\u180e\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u200b\u2028\u2029\u202f\u205f\u2060\u3000\ufeff"
)


def rows_with_wide_space(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which texts hold one of WIDE_SPACES, found by first bytes and then by whole sequences."""
    found = []
    for first in {c.encode()[:1] for c in WIDE_SPACES}:
        place = np.flatnonzero(data == first[0])
        for tail in {c.encode()[1:] for c in WIDE_SPACES if c.encode()[:1] == first}:
            hit = place[place + len(tail) < len(data)] if tail else place
            for k, byte in enumerate(tail, 1):
                hit = hit[data[hit + k] == byte]
            found.append(hit)
    rows = np.searchsorted(at, np.concatenate(found), "right") - 1
    return np.unique(rows)


def library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable, else 256 and on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def prove(path: str) -> frozenset[str]:
    """Vocabulary strings that encode alone as one token; their number is bounded by the vocabulary."""
    tokenizer, bytes_of = library(path), byte_alphabet()
    special = {x["content"] for x in json.loads(tokenizer.to_str())["added_tokens"]}
    found = []
    for token in tokenizer.get_vocab(with_added_tokens=False):
        if token not in special:
            try:
                found.append(bytes(bytes_of[c] for c in token).decode())
            except (KeyError, UnicodeDecodeError):
                continue
    got = tokenizer.encode_batch_fast(found, add_special_tokens=False)
    return frozenset(text for text, x in zip(found, got, strict=True) if len(x.ids) == 1)


class Counter:
    """Counts texts; forgets what it has seen beyond CACHED_WORDS, so memory stays bounded."""

    def __init__(self, path: str, proved: frozenset[str]):
        self.library, self.proved = library(path), proved
        self.forget()

    def forget(self) -> None:
        self.known, self.counts, self.merged = Lookup(), np.zeros(0, np.int64), {}

    def merge(self, texts: list[str]) -> list[int]:
        return [len(x.ids) for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def count_new(self, pieces: list[str]) -> list[int]:
        split = [PRE_TOKENS.findall(x) if PLAIN.fullmatch(x) else None for x in pieces]
        proved, merged = self.proved, self.merged
        rest = list({p for x in split if x is not None for p in x if p not in proved and p not in merged})
        merged.update(zip(rest, self.merge(rest), strict=True))
        odd = [k for k, x in enumerate(split) if x is None]
        whole = dict(zip(odd, self.merge([pieces[k] for k in odd]), strict=True))
        return [whole[k] if x is None else sum(1 if p in proved else merged[p] for p in x) for k, x in enumerate(split)]

    def count(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text of a batch."""
        data, at = buffers(texts)
        wide = rows_with_wide_space(data, at)
        if len(wide):
            plain = np.ones(len(texts), bool)
            plain[wide] = False
            data, at = buffers(pc.if_else(pa.array(plain), texts, pa.scalar("", texts.type)))
        tokens = np.zeros(len(texts), np.int64)
        for low, high in stretches(data, at, WHITE, 1 << 21):
            part = data[low:high]
            inside = ~WHITE[part]
            last = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
            texts_end = at[np.searchsorted(at, low, "right") : np.searchsorted(at, high, "right")] - low
            end = np.union1d(last, np.append(texts_end, len(part)))
            begin = np.concatenate([[0], end[:-1]])
            row = np.searchsorted(at, begin + low, "right") - 1
            keys, first, inverse = np.unique(Hasher(part)(begin, end), return_index=True, return_inverse=True)
            if self.known.size > CACHED_WORDS or len(self.merged) > CACHED_WORDS:
                self.forget()
            slots = self.known.find(keys)
            if len(new := np.flatnonzero(slots < 0)):
                raw = part.tobytes()
                places = zip(begin[first[new]].tolist(), end[first[new]].tolist(), strict=True)
                fresh = self.count_new([raw[a:b].decode() for a, b in places])
                self.counts = np.concatenate([self.counts, np.array(fresh, np.int64)])
                slots[new] = self.known.add(keys[new])
            tokens += np.bincount(row, self.counts[slots][inverse], len(texts)).astype(np.int64)
        if len(wide):
            tokens[wide] = self.merge(texts.take(pa.array(wide)).to_pylist())
        return tokens


_counters: dict[str, Counter] = {}


def counter(path: str, proved: Broadcast) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path, proved.value)
    return _counters[path]


@cache
def proved_of(path: str) -> frozenset[str]:
    return prove(path)


def count_tokens(df: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep``, then n_bytes and n_tokens of each row's whole text. One pass, no shuffle."""
    proved = df.sparkSession.sparkContext.broadcast(proved_of(path))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(keep))
            n_tokens = counter(path, proved).count(texts)
            n_bytes = pc.binary_length(texts).fill_null(0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], n_bytes, pa.array(n_tokens)],
                names=[*keep, "n_bytes", "n_tokens"],
            )

    kept = df.select(*keep, F.col(text).alias("__text"))
    kinds = ", ".join(f"`{name}` {kept.schema[name].dataType.simpleString()}" for name in keep)
    return kept.mapInArrow(counted, f"{kinds}, n_bytes long, n_tokens long")
