"""Exact duplicates: tries against sets, owners against a plain grouping, edge rows, spilled subtrees."""

import hashlib
import random
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from lakemill.llm import exact, queries
from tests.check import compare
from tests.conftest import SF
from tests.llm.conftest import EDGE

WHITE = bytes([32, *range(9, 14)])


def expected(rows):
    """doc_id, keep_id, group_size, kept and digest by plain grouping; which of equal rows stays isn't told."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").encode().translate(None, WHITE)].append((-len(text or ""), doc_id is None, doc_id or 0))
    out = []
    for text, members in groups.items():
        best = min(members)
        for k, (_, unnamed, doc_id) in enumerate(sorted(members)):
            keep = None if best[1] else best[2]
            out.append((None if unnamed else doc_id, keep, len(members), k == 0, hashlib.sha256(text).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_against_sql(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert compare(queries.op12_exact_dedup(spark, SF), connection, queries.ORACLES["op12_exact_dedup"]) is None


def test_edges(spark, edge, nothing):
    assert got(exact.exact_groups(edge)) == expected(EDGE)
    assert exact.exact_groups(nothing).collect() == []


@pytest.mark.parametrize("bound", [2_000, 1 << 30])
def test_ties_and_small_bounds(spark, bound):
    """Many tasks, rows that differ in white space only, shared prefixes, a hot text; tries that overflow all the time."""
    rng = random.Random(3)
    base = ["ab" * rng.randrange(40) + rng.choice(["", "c", "x y"]) for _ in range(60)] + ["hot text"] * 200
    rows = [(rng.choice([k, k // 2, None]), rng.choice([t, t + " ", "\t" + t])) for k, t in enumerate(base * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert got(exact.exact_groups(df, held=bound, owned=bound)) == expected(rows)


@pytest.mark.parametrize("bound", [1_000, 20_000, 1 << 30])
def test_merged_keeps_all_strings(tmp_path, bound):
    """Groups of a trie whose subtrees are spilled, again and again, equal a dictionary's."""
    rng = random.Random(bound)
    keys = [bytes(rng.choices(b"ab", k=rng.randrange(30))) * rng.choice([1, 1, 20]) for _ in range(4000)]
    found = [(key, exact.Group(1, exact.Best(0, False, k, 0, k), [(0, k)])) for k, key in enumerate(keys)]
    groups = {min(g.entries): g for g in exact.merged(iter(found), str(tmp_path), bound)}
    want = defaultdict(list)
    for k, key in enumerate(keys):
        want[key].append(k)
    assert {g.best.doc_id: sorted(e for _, e in g.entries) for g in groups.values()} == {v[0]: v for v in want.values()}
    assert all(g.rows == len(g.entries) for g in groups.values())
    assert not [p for p in tmp_path.iterdir() if p.suffix == ".subtree"]


def test_equal_hashes_do_not_join(spark, monkeypatch):
    """Owners compare bytes: if all texts of one length had one hash, groups were the same."""
    monkeypatch.setattr(exact.xxhash, "xxh3_64_intdigest", lambda text: 5)
    trie = exact.Trie()
    for k, text in enumerate([b"ab", b"ba", b"ab"]):
        node, _ = trie.find(text)
        best = exact.Best(0, False, k, 0, k)
        if node.group is None:
            node.group = exact.Group(1, best, [(0, k)])
        else:
            node.group.add(exact.Group(1, best, [(0, k)]))
    batches = list(exact._handed_on(trie, 0))
    assert sorted(zip(*(batches[0][c].to_pylist() for c in ("text", "hash", "rows")), strict=True)) == [(b"ab", 5, 2), (b"ba", 5, 1)]


def test_plan_shuffles_texts_once(spark):
    """Texts go to owners in one exchange; rows join by task and entry."""
    df = exact.exact_groups(queries.table(spark, SF, "documents")).select(F.col("doc_id"), "keep_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
