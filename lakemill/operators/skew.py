"""Hot keys: find them with a bounded sketch, spread them over many tasks.

A join or window on a key sends all rows of one key to one task. When one key holds a
large share of the rows that task decides the run time, or dies. The operators here take
the hot keys with their row counts and spread only those, each over as many tasks as its
count asks for; everything else keeps the plain plan.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakemill.operators.line_numbers import with_positions

MIN_HOT_ROWS = 1_000_000
ROWS_PER_TASK = 500_000
_MERGERS = 256

HotKeys = Mapping[str | None, int]


def key_profile(
    df: DataFrame,
    key: str,
    *,
    min_rows: int = MIN_HOT_ROWS,
    limit: int = 10_000,
    tracked: int = 20_000,
) -> tuple[dict[str | None, int], int]:
    """Hot keys, as text, with their row counts, and the approximate number of distinct keys.

    One pass over one column. Each task keeps a frequent-items sketch of at most
    ``tracked`` entries; no key is shuffled, and the sketches are merged in ``_MERGERS``
    groups before one task merges those. At most ``limit`` values reach the driver.
    ``None`` stands for null. A key that is not returned is still handled, by the plain
    plan.
    """
    c = F.col(key).cast("string")
    partial = df.groupBy(F.pmod(F.spark_partition_id(), F.lit(_MERGERS)).alias("merger")).agg(
        F.call_function("approx_top_k_accumulate", c, F.lit(tracked)).alias("items"),
        F.hll_sketch_agg(c).alias("distinct"),
        F.count_if(c.isNull()).alias("nulls"),
    )
    items = F.call_function("approx_top_k_combine", "items", F.lit(tracked))
    # Grouped by a constant: without rows there is then no result row, and nothing to merge.
    found = partial.groupBy(F.lit("all").alias("all")).agg(
        F.call_function("approx_top_k_estimate", items, F.lit(limit)).alias("top"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("distinct"),
        F.sum("nulls").alias("nulls"),
    ).first()
    if found is None:
        return {}, 0
    counts = {row["item"]: row["count"] for row in found["top"]}
    counts[None] = found["nulls"]
    return {item: rows for item, rows in counts.items() if rows >= min_rows}, found["distinct"]


def hot_keys(df: DataFrame, key: str, *, min_rows: int = MIN_HOT_ROWS) -> dict[str | None, int]:
    """Keys that hold at least ``min_rows`` rows (see ``key_profile``). Runs one job over the key column."""
    return key_profile(df, key, min_rows=min_rows)[0]


def is_hot(key: Column, hot: HotKeys) -> Column:
    """True or false, never null."""
    listed = F.coalesce(key.cast("string").isin([h for h in hot if h is not None]), F.lit(False))
    return (key.isNull() | listed) if None in hot else listed


def salts_per_key(key: Column, hot: HotKeys, rows_per_task: int = ROWS_PER_TASK) -> Column:
    """Number of salts of a key: a power of two that grows with its rows; 1 if it is not hot."""
    groups: dict[int, dict[str | None, int]] = {}
    for item, rows in hot.items():
        salts = 1 << (max(2, ceil(rows / rows_per_task)) - 1).bit_length()
        groups.setdefault(salts, {})[item] = rows
    number = F
    for salts, members in groups.items():
        number = number.when(is_hot(key, members), F.lit(salts))
    return number.otherwise(F.lit(1))


def spread_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str,
    *,
    hot: HotKeys | None = None,
    salt_by: str,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``left`` joined to a ``right`` that has one row per key, with hot keys spread.

    Rows of ``left`` with a hot key get a salt from ``salt_by``, a column that tells the
    rows of one key apart and is the same when a task is run again. The few hot rows of
    ``right`` are repeated once per salt.
    """
    if not hot:
        return left.join(right, key, how)
    salts = salts_per_key(F.col(key), hot, rows_per_task)
    left = left.withColumn("_salt", F.pmod(F.xxhash64(salt_by), salts).cast("int"))
    right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return left.join(right, [key, "_salt"], how).drop("_salt")


def stored_once(df: DataFrame) -> DataFrame:
    """Materialise on shared storage, so that a lost executor cannot change the rows. Goes when the driver ends."""
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:  # only a local session may fall back to its warehouse
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        root = f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints"
    path = f"{root.rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


def ranked_by_range(
    df: DataFrame, key: str, order: Sequence[Column], rank: str, *, rows: int, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """``row_number`` per key, as bigint, for keys too large for one task; ``rows``: about how many in all.

    Rows are range-partitioned by (key, order), so a large key covers many partitions in
    order. Inside a partition the rank is the distance from the key's first row; the rows
    the key has in earlier partitions are added from a table with one row per
    (partition, key). ``order`` must be a total order within a key.
    """
    tasks = max(2, ceil(rows / rows_per_task))
    sorted_rows = df.repartitionByRange(tasks, F.col(key), *order).sortWithinPartitions(F.col(key), *order)
    placed = stored_once(with_positions(sorted_rows))
    earlier = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_part", key)
        .agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_rows"))
        .select(
            F.col("_part").alias("_start_part"),
            F.col(key).alias("_start_key"),
            "_first",
            F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        )
    )
    same = (F.col("_part") == F.col("_start_part")) & F.col(key).eqNullSafe(F.col("_start_key"))
    # One row per (partition, hot key) that meet: at most partitions + hot keys rows.
    joined = placed.join(F.broadcast(starts), same)
    number = F.col("_before") + F.col("_pos") - F.col("_first") + 1
    return joined.withColumn(rank, number).select(*df.columns, rank)
