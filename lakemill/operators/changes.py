"""Change rows: a table, its updates and new rows, reduced to the present state."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.operators.dedup import newest_per_key


def stack_changes(*parts: DataFrame) -> DataFrame:
    """All rows of the parts; ``_change_order`` grows with the position of the part."""
    numbered = [part.withColumn("_change_order", F.lit(i)) for i, part in enumerate(parts)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered)


def current_rows(changes: DataFrame, key: str, tie_breakers: Sequence[str | Column] = ()) -> DataFrame:
    return newest_per_key(changes, key, "_change_order", tie_breakers).drop("_change_order")
