"""Row-level quality flags. Rows are marked, never changed or dropped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.functions.rules import ERROR, WARNING, Rule
from lakemill.operators.drift import source_columns


def _codes(rules: Sequence[Rule], severity: str) -> Column:
    # Written without a lambda: higher-order functions evaluate their input outside of
    # generated code, and all rule conditions with it.
    none = F.array().cast("array<string>")
    hits = [F.when(r.violated, F.array(r.code)).otherwise(none) for r in rules if r.severity == severity]
    return F.flatten(F.array(*hits)) if hits else none


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``_dq_errors`` and ``_dq_warnings``: the codes of the violated rules, in rule order."""
    return df.withColumns(
        {"_dq_errors": _codes(rules, ERROR), "_dq_warnings": _codes(rules, WARNING)}
    )


def completeness(columns: Sequence[str]) -> Column:
    """Share of the given columns that are filled, in percent, decimal(5,2)."""
    filled = sum(
        (F.when(F.trim(F.col(c)) != "", 1).otherwise(0) for c in columns), start=F.lit(0)
    )
    return (filled / len(columns) * 100).cast("decimal(5,2)")


def summarise_flags(df: DataFrame) -> DataFrame:
    """Replace the code arrays by score, counts and JSON details."""
    errors, warnings = F.col("_dq_errors"), F.col("_dq_warnings")
    return df.withColumns(
        {
            "_dq_completeness_score": completeness(source_columns(df)),
            "_dq_has_errors": F.size(errors) > 0,
            "_dq_error_count": F.size(errors),
            "_dq_warning_count": F.size(warnings),
            "_dq_error_details": F.to_json(errors),
            "_dq_warning_details": F.to_json(warnings),
        }
    ).drop("_dq_errors", "_dq_warnings")


def validate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return summarise_flags(apply_rules(df, rules))


def explode_codes(df: DataFrame, key: str) -> DataFrame:
    """One row per violated rule: key, code, severity. Expects ``apply_rules`` output."""
    codes = F.posexplode(F.concat("_dq_errors", "_dq_warnings")).alias("_pos", "code")
    rows = df.select(F.col(key), F.size("_dq_errors").alias("_errors"), codes)
    severity = F.when(F.col("_pos") < F.col("_errors"), ERROR).otherwise(WARNING)
    return rows.select(key, "code", severity.alias("severity"))


def batch_score(df: DataFrame) -> DataFrame:
    """One row: counts and share of rows without errors (0 for an empty batch)."""
    total, bad = F.count(F.lit(1)), F.count_if("_dq_has_errors")
    score = F.when(total > 0, (total - bad) / total * 100).otherwise(F.lit(0.0))
    return df.agg(
        total.alias("records_total"),
        bad.alias("records_with_errors"),
        score.cast("decimal(5,2)").alias("data_quality_score"),
    )
