"""Schema drift against a feed contract: names only, extra columns are kept as JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def detect_drift(df: DataFrame, expected: Sequence[str]) -> dict:
    """Compare column names; reads metadata only."""
    found, wanted = set(df.columns), set(expected)
    return {
        "has_changes": found != wanted,
        "new_columns": sorted(found - wanted),
        "missing_columns": sorted(wanted - found),
        "source_column_count": len(found),
        "expected_column_count": len(wanted),
    }


def _exactly(name: str) -> Column:
    """The column of that name, also when a feed's header has dots or spaces in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def conform(df: DataFrame, expected: Sequence[str], keep: Sequence[str] = ()) -> tuple[DataFrame, dict]:
    """Exactly the expected columns, plus ``_extra_fields`` with the others as JSON, and those to ``keep``.

    ``_extra_fields`` is null when there is nothing extra; missing columns become null strings.
    """
    changes = detect_drift(df.drop(*keep), expected)
    extra = [_exactly(c) for c in changes["new_columns"]]
    columns = [_exactly(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in expected]
    folded = F.to_json(F.struct(*extra)) if extra else F.lit(None).cast("string")
    if len(extra) > 0:  # rows of files that lack all of these columns
        folded = F.when(F.coalesce(*extra).isNotNull(), folded)
    return df.select(*columns, folded.alias("_extra_fields"), *keep), changes


def source_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if not c.startswith("_")]


def drop_technical_columns(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_")])
