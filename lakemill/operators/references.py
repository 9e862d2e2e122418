"""Referential checks between tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.operators import blooms
from lakemill.operators.skew import ROWS_PER_TASK, HotKeys, spread_join

#: Rows that a batch is taken to have if that isn't known; sets the size of the filter of its keys (8 MB).
USUAL_ROWS = 6_000_000


def known_keys(parents: DataFrame, key: str, keys: DataFrame, rows: int | None) -> DataFrame:
    """Distinct parent keys that may be among ``keys``.

    A Bloom filter of the keys, bounded in size and broadcast, is applied where the parents are scanned, so parent rows
    that no row of the batch refers to are not shuffled. A batch too large for a filter takes all parents.
    """
    buckets = blooms.buckets_for(USUAL_ROWS if rows is None else rows)
    found = parents.select(key)
    if buckets is not None:
        found = blooms.passing(found, key, blooms.build(keys, key, buckets), buckets)
    return found.distinct()


def flag_reference(
    df: DataFrame,
    parents: DataFrame | None,
    key: str,
    flag: str,
    *,
    salt_by: str,
    hot: HotKeys | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    keys: DataFrame | None = None,
    rows: int | None = None,
) -> DataFrame:
    """True where ``key`` exists among the parents, false where not, null without a parent table.

    ``keys``: the key column of the batch in a cheaper form than ``df``, or more keys; ``rows``: about how many those are.
    """
    if parents is None:
        return df.withColumn(flag, F.lit(None).cast("boolean"))
    known = known_keys(parents, key, df if keys is None else keys, rows).withColumn(flag, F.lit(True))
    joined = spread_join(df, known, key, "left", hot=hot, salt_by=salt_by, rows_per_task=rows_per_task)
    return joined.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def orphans(
    df: DataFrame,
    parents: DataFrame,
    key: str,
    *,
    salt_by: str,
    hot: HotKeys | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    rows: int | None = None,
) -> DataFrame:
    """Rows whose ``key`` has no parent. ``rows``: about how many rows there are, if that is known."""
    known = known_keys(parents, key, df, rows)
    return spread_join(df, known, key, "left_anti", hot=hot, salt_by=salt_by, rows_per_task=rows_per_task)
