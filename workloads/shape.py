"""Result shaping shared by the check queries."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, IntegerType, TimestampNTZType, TimestampType

AS_OF = date(2025, 1, 1)


def plain(df: DataFrame) -> DataFrame:
    """Decimals as double, days and moments as text: types that every client shows alike."""

    def shown(field):
        c = F.col(field.name)
        if isinstance(field.dataType, DecimalType):
            return c.cast("double").alias(field.name)
        if isinstance(field.dataType, DateType):
            return F.date_format(c, "yyyy-MM-dd").alias(field.name)
        if isinstance(field.dataType, (TimestampType, TimestampNTZType)):
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(field.name)
        if isinstance(field.dataType, IntegerType):
            return c.cast("bigint").alias(field.name)
        return c

    return df.select(*[shown(f) for f in df.schema.fields])


class Checks:
    """Check queries and their SQL twins by name."""

    def __init__(self):
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}

    def query(self, name: str, oracle: str, optional: Sequence[str] = ()):
        """Register a query. ``optional``: numbers and flags that may be null, shown as double
        on both sides because clients differ in the type they give such columns."""

        def register(function):
            def run(spark: SparkSession, sf_dir: str) -> DataFrame:
                return function(spark, sf_dir).withColumns({c: F.col(c).cast("double") for c in optional})

            shown = ", ".join(f"cast({c} AS double) AS {c}" for c in optional)
            self.queries[name] = run if optional else function
            self.oracles[name] = f"SELECT * REPLACE ({shown}) FROM (\n{oracle}\n)" if optional else oracle
            return self.queries[name]

        return register
