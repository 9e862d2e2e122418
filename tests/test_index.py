"""Bloom filters and the index of record hashes, against plain sets."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakemill.operators import blooms
from lakemill.sources.hash_index import HASH, HashIndex

DAYS = {name: datetime(2024, 1, day) for day, name in enumerate(("a", "b", "c", "d"), 1)}


@pytest.mark.parametrize("buckets", [1, 16])
def test_bloom_lets_its_own_keys_pass(spark, buckets):
    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("k"))
    more = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("k")).union(spark.createDataFrame([(None,)], "k string"))
    bloom = blooms.build(keys.union(spark.createDataFrame([(None,)], "k string")), "k", buckets)
    passed = {r["k"] for r in blooms.passing(more, "k", bloom, buckets).collect()}
    assert {f"k{n}" for n in range(3000)} <= passed and None not in passed
    assert len(passed) < 3000 + 17_000 * (0.05 if buckets == 1 else 0.002)
    halves = blooms.build(keys.where("k < 'k2'"), "k", buckets).union(blooms.build(keys.where("k >= 'k2'"), "k", buckets))
    assert {r["k"] for r in blooms.passing(more, "k", blooms.united(halves), buckets).collect()} == passed


def test_bloom_sizes():
    assert [blooms.buckets_for(n) for n in (0, 1, 3000, 3001, 10**7, 10**8, 10**9)] == [1, 1, 1, 2, 4096, 16384, None]


def rows(spark, *batches):
    """Bronze rows of batches given as name and letters, each letter a record."""
    return spark.createDataFrame(
        [(f"{ord(x):x}" * 16, DAYS[name], name) for name, letters in batches for x in letters],
        f"{HASH} string, _bronze_ingestion_timestamp timestamp, _bronze_ingestion_batch_id string",
    )


def firsts(spark, name, letters):
    data = [(f"{ord(x):x}" * 16, DAYS[name[0]], name) for x in letters]
    return spark.createDataFrame(data, f"{HASH} string, first_at timestamp, first_batch string")


def seen(spark, index, tmp_path, letters, before=None):
    own = rows(spark, ("d", letters)).select(HASH).distinct()
    moment = None if before is None else (DAYS[before], before)
    found = index.first_seen(own, str(tmp_path / "probe"), before=moment)
    names = {f"{ord(x):x}" * 16: x for x in letters}
    return {} if found is None else {names[r[HASH]]: r["_dq_duplicate_of_batch"] for r in found.collect()}


def test_index_names_the_earliest_batch(spark, tmp_path):
    index = HashIndex(spark, str(tmp_path / "index"), buckets=16)
    assert not index.exists() and seen(spark, index, tmp_path, "xy") == {}
    index.add(firsts(spark, "b", "xyz"), "b")
    index.add(firsts(spark, "c", "pq"), "c")
    assert seen(spark, index, tmp_path, "xpw") == {"x": "b", "p": "c"}
    assert seen(spark, index, tmp_path, "xp", before="c") == {"x": "b"}  # its own and later entries don't count
    index.add(firsts(spark, "a", "x"), "a")  # a batch of an earlier day that comes late
    assert seen(spark, index, tmp_path, "xp") == {"x": "a", "p": "c"}


def test_replaced_batch_gives_its_hashes_to_later_ones(spark, tmp_path):
    index = HashIndex(spark, str(tmp_path / "index"), buckets=16)
    index.add(firsts(spark, "a", "xyz"), "a")
    index.add(firsts(spark, "b", "p"), "b")  # b also holds x and y, which a had first
    index.replace(firsts(spark, "a", "zw"), "a", rows(spark, ("b", "pxy"), ("c", "y")))
    assert seen(spark, index, tmp_path, "xyzwp") == {"x": "b", "y": "b", "z": "a", "w": "a", "p": "b"}
    index.replace(firsts(spark, "b", "p"), "b", rows(spark, ("a", "zw"), ("c", "y")))
    assert seen(spark, index, tmp_path, "xyzwp") == {"y": "c", "z": "a", "w": "a", "p": "b"}


def test_rebuild_and_fold(spark, tmp_path):
    index = HashIndex(spark, str(tmp_path / "index"), buckets=16)
    index.rebuild(rows(spark, ("b", "xxy"), ("a", "yz"), ("c", "")))
    for k in range(8):
        index.add(firsts(spark, f"d{k}", chr(ord("A") + k)), f"d{k}")
    index.fold()
    assert index.filters().select("segment").distinct().count() == 1
    assert seen(spark, index, tmp_path, "xyzAHq") == {"x": "b", "y": "a", "z": "a", "A": "d0", "H": "d7"}


def test_lookup_reads_the_index_only(spark, tmp_path):
    """No bronze rows; entries are not shuffled when few hashes pass the filter."""
    index = HashIndex(spark, str(tmp_path / "index"), buckets=16)
    index.add(firsts(spark, "a", "xyz"), "a")
    found = index.first_seen(rows(spark, ("d", "xq")).select(HASH).distinct(), str(tmp_path / "probe"))
    assert all("/index/entries/" in f or "/probe/" in f for f in found.inputFiles())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
