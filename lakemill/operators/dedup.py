"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def newest_per_key(df: DataFrame, key: str, newest: str, tie_breakers: Sequence[str | Column] = ()) -> DataFrame:
    """The row with the greatest ``newest`` per key; ties by ``tie_breakers``, ascending.

    Written as rank-and-filter, which Spark runs with a group limit before the shuffle:
    every task sends at most one row per key, so a hot key costs one row per task.
    """
    order = Window.partitionBy(key).orderBy(F.col(newest).desc_nulls_last(), *tie_breakers)
    ranked = df.withColumn("_row_num", F.row_number().over(order))
    return ranked.filter(F.col("_row_num") == 1).drop("_row_num")


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()
