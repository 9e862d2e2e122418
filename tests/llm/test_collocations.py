"""Collocations against the SQL twin and a plain count; activation, ties, exact arithmetic and edge rows."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemill.llm import collocations, queries
from tests.check import compare
from tests.conftest import SF
from tests.llm.conftest import EDGE

SF_MIDDLE = "/root/testdata/sf0.01"


def grams(rows, longest=3):
    found = Counter()
    for lang, text in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    found[lang or "und", " ".join(words[i : i + size])] += 1
    return found


def brute(rows, threshold, top=2000):
    f = grams(rows)
    total = Counter()
    for (lang, phrase), n in f.items():
        total[lang] += n if " " not in phrase else 0
    candidates = {k: n for k, n in f.items() if n >= threshold and " " in k[1]}
    ranked, longer = {}, Counter()
    for (lang, phrase), n in candidates.items():
        if phrase.count(" ") == 2:
            for part in (phrase.rsplit(" ", 1)[0], phrase.split(" ", 1)[1]):
                longer[lang, part] = max(longer[lang, part], n)
    for (lang, phrase), a in candidates.items():
        words = phrase.split(" ")
        if 100 * longer[lang, phrase] >= 50 * a:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = f[lang, " ".join(words[:k])], f[lang, " ".join(words[k:])]
            cuts.append((1000000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        ranked.setdefault(lang, []).append((-score, -a, phrase.encode(), left, right))
    return sorted(
        (lang, place + 1, p.decode(), -a, left, right, total[lang], -score)
        for lang, found in ranked.items()
        for place, (score, a, p, left, right) in enumerate(sorted(found)[:top])
    )


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.fixture(scope="module")
def sample():
    rng = random.Random(7)
    vocabulary = ["the", "of", "New", "york", "city", "a", "b", "naïve", "中文", "é"]
    rows = []
    for _ in range(300):
        words = rng.choices(vocabulary, k=rng.randrange(30))
        rows.append((rng.choice(["en", "de", None]), "".join(w + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\r\n"]) for w in words)))
    return rows


def test_against_sql(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_MIDDLE}/documents.parquet'")
    assert compare(queries.op13_collocations(spark, SF_MIDDLE), connection, queries.ORACLES["op13_collocations"]) is None


@pytest.mark.parametrize(("shards", "cells"), [(2, None), (4, 16)])
def test_counts_are_exact(spark, sample, shards, cells):
    """Whatever the number of shards, and with a table of cells so small that most phrases begin early."""
    df = spark.createDataFrame(sample, "lang string, text string").repartition(5)
    counts, totals = collocations.count_phrases(df, 10, shards, cells)
    found = {(r["lang"], r["phrase"]): r["n"] for r in counts.collect()}
    want, every = grams(sample), Counter()
    assert found == {k: n for k, n in want.items() if n >= 10}
    for (lang, phrase), n in want.items():
        every[lang] += n if " " not in phrase else 0
    assert dict(map(tuple, totals.collect())) == every


def test_against_brute_force(spark, sample):
    df = spark.createDataFrame(sample, "lang string, text string").repartition(3)
    assert got(collocations.collocations(df)) == brute(sample, 10)
    assert got(collocations.collocations(df, threshold=3, top=5)) == brute(sample, 3, 5)


def test_activation():
    """Phrases become active only when both subphrases reached the threshold, and are counted for one cycle."""
    lang, words = "en", [b"a", b"b", b"c"]
    keys = np.array([collocations.word_hash(b"en", w) for w in words], np.uint64)
    pairs = collocations.phrase_hash(keys[:2], keys[1:])

    def active(number, steps):
        step = collocations.Step(number, 3, (1, 2, 3), f"no-folder-{number}", 1 << 20, {})
        for length, given, reached in ((1, keys, steps[:3]), (2, pairs, steps[3:])):
            table = collocations.table_of(step, length)
            for cells in collocations.cells_of(given, step.cells):
                table.steps[cells] = reached
        found = [b.to_pylist() for b in collocations._count_part(step, lang, b"A b. b  c, a b c")]
        return {r["phrase"]: (r["since"], r["n"]) for rows in found for r in rows if r["length"] > 1}

    never = collocations.NEVER
    assert active(0, [never] * 5) == {}
    assert active(1, [0, 0, never, never, never]) == {"a b": (1, 2)}
    assert active(2, [0, 0, 1, 1, never]) == {"a b": (1, 2), "b c": (2, 2)}
    assert active(3, [0, 0, 1, 1, 2]) == {"a b": (1, 2), "b c": (2, 2), "a b c": (3, 1)}
    assert active(4, [0, 0, 1, 1, 2]) == {"b c": (2, 2), "a b c": (3, 1)}
    assert active(6, [0, 0, 1, 1, 2]) == {}


def test_exact_arithmetic(spark):
    """Products beyond 64 bits, and a tie after flooring that the smaller cut wins."""
    rows = [("en", 1, "a", 4 * 10**12), ("en", 1, "b", 3 * 10**12), ("en", 1, "c", 3 * 10**12), ("en", 2, "a b", 2 * 10**12 + 1),
            ("en", 2, "b c", 10**12), ("en", 3, "a b c", 10**11)]
    counts = spark.createDataFrame(rows, "lang string, length int, phrase string, n long")
    found = {r["phrase"]: (r["l"], r["r"], r["score"]) for r in collocations.phrase_scores(counts).collect()}
    a, b, c, ab, bc, abc = (n for *_, n in rows)
    assert found["a b"] == (a, b, 10**6 * ab * ab // (a * b))
    assert found["a b c"] == (ab, c, min(10**6 * abc**2 // (a * bc), 10**6 * abc**2 // (ab * c)))
    tie = spark.createDataFrame([("x", 1, "p", 40), ("x", 1, "q", 50), ("x", 1, "r", 40), ("x", 2, "p q", 30), ("x", 2, "q r", 30), ("x", 3, "p q r", 12)],
                                counts.schema)
    assert [r["l"] for r in collocations.phrase_scores(tie).where("phrase = 'p q r'").collect()] == [40]


def test_edges(spark, edge, nothing):
    df = edge.withColumn("lang", F.when(F.col("doc_id") > 5, "en"))
    rows = [("en" if i is not None and i > 5 else None, t) for i, t in EDGE]
    assert got(collocations.collocations(df)) == brute(rows, 10)
    assert collocations.collocations(nothing).collect() == []
    white = spark.createDataFrame([("en", " .. "), (None, None)], "lang string, text string")
    assert collocations.collocations(white).collect() == []
