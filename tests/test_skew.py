"""Hot keys: the spread plans give the same rows as the plain ones."""

import pytest
from pyspark.sql import functions as F

from lakemill.operators.duplicates import mark_duplicates
from lakemill.operators.order_metrics import add_order_metrics
from lakemill.operators.references import flag_reference, orphans
from lakemill.operators.skew import hot_keys, key_profile, spread_join


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def items(spark):
    """3,000 items; order A holds a third, a null order 40, many totals are equal."""
    n = F.col("id")
    return spark.range(0, 3000, 1, 7).select(
        F.concat(F.lit("i"), n.cast("string")).alias("item_id"),
        F.when(n % 3 == 0, "A").when(n % 50 == 1, F.lit(None)).otherwise(F.concat(F.lit("o"), (n % 400).cast("string"))).alias("order_id"),
        (n % 11).cast("decimal(12,2)").alias("line_total"),
    )


def test_hot_keys_finds_the_heavy_ones(items):
    hot, distinct = key_profile(items, "order_id", min_rows=40)
    assert hot == {"A": 1000, None: 40}
    assert abs(distinct - items.select("order_id").dropna().distinct().count()) < 40


def test_no_hot_keys_when_even(spark):
    assert hot_keys(spark.range(1000).withColumn("k", F.col("id") % 100), "k", min_rows=50) == {}


@pytest.mark.parametrize("rows_per_task", [90, 1_000_000])
@pytest.mark.parametrize("hot", [{"A": 1000}, {"A": 1000, None: 40}, {"A": 1000, "o1": 5, "absent": 9}])
def test_order_metrics_same_with_hot_orders(items, hot, rows_per_task):
    assert rows_of(add_order_metrics(items, hot=hot, rows_per_task=rows_per_task)) == rows_of(add_order_metrics(items))


def test_hot_order_is_spread(spark, items):
    """No task of the spread join holds much more than its share of the hot order."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    parents = items.select("order_id").distinct().withColumn("known", F.lit(True))
    joined = spread_join(items, parents.hint("merge"), "order_id", "left", hot={"A": 1000}, salt_by="item_id", rows_per_task=30)
    per_task = joined.groupBy("order_id", F.spark_partition_id().alias("p")).count().filter("order_id = 'A'").collect()
    spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(per_task) > 4 and max(r["count"] for r in per_task) < 500


def test_order_metrics_brute_force(items):
    got = {r["item_id"]: r for r in add_order_metrics(items, hot={"A": 1000, None: 40}, rows_per_task=70).collect()}
    orders = {}
    for row in items.collect():
        orders.setdefault(row["order_id"], []).append((-row["line_total"], row["item_id"]))
    assert len(got) == 3000
    for members in orders.values():
        total = -sum(t for t, _ in members)
        for rank, (negative, item) in enumerate(sorted(members), 1):
            assert got[item]["item_rank_in_order"] == rank
            assert got[item]["order_item_count"] == len(members)
            assert got[item]["order_total_items_value"] == total
            assert got[item]["is_highest_value_item"] == (rank == 1)


@pytest.mark.parametrize("hot", [{"A": 1000}, {"A": 1000, None: 40}])
def test_reference_check_same_with_hot_keys(spark, items, hot):
    parents = spark.createDataFrame([("A",), ("A",), ("o4",), ("o8",)], "order_id string")
    plain = flag_reference(items, parents, "order_id", "known", salt_by="item_id")
    spread = flag_reference(items, parents, "order_id", "known", salt_by="item_id", hot=hot, rows_per_task=10)
    assert rows_of(plain) == rows_of(spread)
    assert plain.count() == 3000
    lost = orphans(items, parents, "order_id", salt_by="item_id", hot=hot)
    assert rows_of(lost) == rows_of(plain.filter(~F.col("known")).drop("known"))


def test_unknown_parents_give_null(items):
    flagged = flag_reference(items, None, "order_id", "known", salt_by="item_id")
    assert flagged.filter(F.col("known").isNotNull()).isEmpty()


@pytest.mark.parametrize("min_hot_rows", [5, 1_000_000])
def test_duplicates_keep_every_row(spark, min_hot_rows):
    """A third of the batch is one record; its hash came with two earlier batches."""
    n = F.col("id")
    batch = spark.range(90).select(
        F.when(n % 3 == 0, "same").otherwise(n.cast("string")).alias("a"),
        F.lit(None).cast("string").alias("b"),
        n.alias("_line"),
    )
    seen = mark_duplicates(batch.filter("a in ('same', '1')"), None, salt_by="_line").select("_bronze_record_hash").distinct()
    history = seen.withColumns({
        "_bronze_ingestion_timestamp": F.lit("2024-01-02").cast("timestamp"), "_bronze_ingestion_batch_id": F.lit("late"),
    }).unionByName(seen.withColumns({
        "_bronze_ingestion_timestamp": F.lit("2024-01-01").cast("timestamp"), "_bronze_ingestion_batch_id": F.lit("early"),
    }))
    marked = mark_duplicates(
        batch, history, salt_by="_line", within_batch=True, min_hot_rows=min_hot_rows, rows_per_task=4
    ).collect()
    assert len(marked) == 90
    for row in marked:
        known = row["a"] in ("same", "1")
        assert row["_dq_is_duplicate"] == known
        assert row["_dq_duplicate_of_batch"] == ("early" if known else None)
        assert row["_dq_dup_in_batch"] == (row["a"] == "same")


def test_profile_of_nothing(spark):
    assert key_profile(spark.createDataFrame([], "k string"), "k", min_rows=1) == ({}, 0)
