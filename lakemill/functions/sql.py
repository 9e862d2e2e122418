"""The column functions and the trend queries as SQL functions, for users who write SQL.

``register`` makes temporary functions of the session: scalar ones, and table functions whose parameters are bound, not
pasted into a text. Their vocabularies are those of ``lakemill.functions.text``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession

from lakemill.functions import text


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _listed(values: Sequence[str]) -> str:
    return ", ".join(map(_quoted, values))


def _synonyms(word: str, groups: Mapping[str, Sequence[str]], default: str) -> str:
    cases = " ".join(f"WHEN {word} IN ({_listed(words)}) THEN {_quoted(name)}" for name, words in groups.items())
    return f"CASE {cases} ELSE {default} END"


FOLDED = "lower(trim(value))"
DIGITS = "regexp_replace(value, '[^0-9]', '')"
#: Name, type of the result and body; each takes one text, ``value``.
SCALARS = {
    "payment_method": ("STRING", _synonyms(FOLDED, text.PAYMENT_SYNONYMS, "'other'")),
    "product_category": ("STRING", f"initcap({_synonyms(f'coalesce({FOLDED}, {_quoted('uncategorized')})', text.CATEGORY_SYNONYMS, f'coalesce({FOLDED}, {_quoted('uncategorized')})')})"),
    "customer_segment": ("STRING", f"CASE WHEN {FOLDED} IN ({_listed(text.SEGMENTS)}) THEN {FOLDED} ELSE 'standard' END"),
    "yes_no": ("BOOLEAN", f"CASE WHEN {FOLDED} IN ({_listed(text.TRUE_WORDS)}) THEN true WHEN {FOLDED} IN ({_listed(text.FALSE_WORDS)}) THEN false END"),
    "is_blank": ("BOOLEAN", f"value IS NULL OR NOT rlike(value, {_quoted(chr(92) + 'S')})"),
    "email_valid": ("BOOLEAN", f"coalesce(rlike(value, {_quoted(text.EMAIL_PATTERN)}), false)"),
    "us_phone": ("STRING", f"CASE WHEN length({DIGITS}) >= 10 THEN regexp_replace({DIGITS}, {_quoted(text.TEN_DIGITS)}, {_quoted(text.PHONE_SHAPE)}) END"),
}
#: Name, parameters, columns of the result and body.
TABLES = {
    "quality_trend": (
        "name STRING, as_of DATE, days INT",
        "ingestion_date DATE, records_total BIGINT, records_with_errors BIGINT, data_quality_score DECIMAL(5,2), "
        "processing_duration_seconds DECIMAL(10,2)",
        "SELECT ingestion_date, records_total, records_with_errors, data_quality_score, processing_duration_seconds "
        "FROM {bronze_batch_log} WHERE table_name = quality_trend.name "
        "AND ingestion_date >= date_sub(quality_trend.as_of, quality_trend.days)",
    ),
    "pipeline_performance": (
        "name STRING, as_of DATE, days INT",
        "execution_date DATE, status STRING, duration_seconds DECIMAL(10,2), records_processed BIGINT, triggered_by STRING",
        "SELECT execution_date, status, duration_seconds, records_processed, triggered_by FROM {executions} "
        "WHERE pipeline_name = pipeline_performance.name "
        "AND execution_date >= date_sub(pipeline_performance.as_of, pipeline_performance.days)",
    ),
}


def register(spark: SparkSession, *, prefix: str = "lake_", views: Mapping[str, str] | None = None) -> list[str]:
    """Make the functions; returns their names.

    ``views``: views or tables for ``bronze_batch_log`` and ``executions`` (the present state of each run, as
    ``AuditLog.executions`` gives it); without one the table functions that need it are left out.
    """
    made = []
    for name, (kind, body) in SCALARS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}(value STRING) RETURNS {kind} RETURN {body}")
        made.append(prefix + name)
    for name, (parameters, columns, body) in TABLES.items():
        known = dict(views or {})
        if any("{" + v + "}" in body and v not in known for v in ("bronze_batch_log", "executions")):
            continue
        body = body.format(**known).replace(f"{name}.", f"{prefix}{name}.")
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({parameters}) RETURNS TABLE ({columns}) RETURN {body}")
        made.append(prefix + name)
    return made
