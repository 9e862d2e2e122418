"""Periodic runs against a brute-force search for all periods and stretches."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from lakemill.llm import periodic, queries
from tests.conftest import SF
from tests.llm.conftest import EDGE, documents


def brute(words):
    """(start, length, period) of all runs, from the definition: for each period, stretches of equal words that far apart."""
    runs = []
    for q in range(1, len(words) // 4 + 1):
        at = 0
        while at + q < len(words):
            end = at
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            stretch = words[at : end + q]
            if end > at and len(stretch) >= max(6, 4 * q):
                smaller = any(all(stretch[i] == stretch[i + d] for i in range(len(stretch) - d)) for d in range(1, q))
                if not smaller:
                    runs.append((at, len(stretch), q))
            at = end + 1
    return sorted(runs, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = (text or "").encode().split()
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    n = len(words)
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    dropped = {i for start, length, q in runs for i in range(start + q, start + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(runs), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def many_texts(seed, number):
    """Texts that are rich in runs: small alphabets, repeated blocks, Fibonacci words, nested repeats."""
    rng = random.Random(seed)
    fib = ["a", "ab"]
    while len(fib[-1]) < 60:
        fib.append(fib[-1] + fib[-2])
    for k in range(number):
        kind = k % 6
        letters = rng.choice(["a", "ab", "abc", "abcdefgh"])
        block = rng.choices(letters, k=rng.randrange(1, 9))
        if kind == 0:
            yield rng.choices(letters, k=rng.randrange(40))
        elif kind == 1:
            yield rng.choices(letters, k=rng.randrange(9)) + block * rng.randrange(1, 9) + rng.choices(letters, k=rng.randrange(9))
        elif kind == 2:
            yield list(rng.choice(fib)) + block * 4 + block[: rng.randrange(len(block))]
        elif kind == 3:
            yield (block * rng.randrange(2, 6) + ["z"]) * rng.randrange(1, 7)
        elif kind == 4:
            yield block * 3 + block[:-1]  # one word short of four periods
        else:
            yield (["x"] * rng.randrange(4, 8) + block) * rng.randrange(3, 6)


@pytest.mark.parametrize("bound", [1, 100, 1 << 16])
def test_find_runs_against_brute_force(bound):
    texts = list(many_texts(bound, 900))
    text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    codes = np.array([ord(c) for t in texts for c in t])
    found = periodic.find_runs(codes, text, bound)
    got = [[] for _ in texts]
    for k, *run in zip(*(x.tolist() for x in found), strict=True):
        got[k].append(tuple(run))
    assert got == [brute(t) for t in texts]
    assert sum(map(len, got)) > 300


def test_extensions_against_comparison():
    """Suffix order and agreement of any two suffixes, as compared letter by letter."""
    rng = random.Random(5)
    for size in (1, 2, 3, 40, 300):
        listed = [rng.randrange(2) for _ in range(size - 1)] + [2]
        both = periodic.Extensions(listed, 3)
        assert np.argsort(both.rank).tolist() == sorted(range(size), key=lambda i: listed[i:])
        pairs = [(i, j) for i in range(size) for j in range(size) if i != j]
        rng.shuffle(pairs)
        for i, j in pairs[:2000]:
            want = next(k for k in range(size) if listed[i + k] != listed[j + k])
            assert both(np.array([i]), np.array([j]))[0] == want


def test_query_against_brute_force(spark):
    want = {r["doc_id"]: brute_row(r["doc_id"], r["text"]) for r in documents(spark).where("length(text) < 6000").collect()}
    got = {r["doc_id"]: tuple(r) for r in queries.op11_periodic_runs(spark, SF).collect()}
    assert len(got) == documents(spark).count() and len(want) > 150
    assert {k: got[k] for k in want} == want
    assert sum(r[1] > 0 for r in want.values()) > 10


def test_edges(spark, edge, nothing):
    short = [(i, t) for i, t in EDGE if len(t or "") < 100_000]
    got = sorted(map(tuple, periodic.periodic_runs(edge, periodic.planted).collect()), key=str)
    want = sorted((brute_row(*row) for row in short), key=str)
    assert [r for r in got if r in want] == want and len(got) == len(EDGE)
    assert periodic.periodic_runs(nothing).collect() == []


def test_very_long_text(spark):
    """One text of 240,000 words, a block 30,000 times and then a long period."""
    words = ["lead"] + ["a", "b", "c"] * 30_000 + [f"w{k}" for k in range(30_000)] * 5
    df = spark.createDataFrame([(None, " ".join(words))], "doc_id long, text string")
    row = periodic.periodic_runs(df).first()
    assert (row["n_runs"], row["start"], row["length"], row["period"]) == (2, 90_001, 150_000, 30_000)
    kept = ["lead", "a", "b", "c", *(f"w{k}" for k in range(30_000))]
    assert row["collapsed_sha256"] == hashlib.sha256(" ".join(kept).encode()).hexdigest()


def test_no_shuffle(spark):
    plan = queries.op11_periodic_runs(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
