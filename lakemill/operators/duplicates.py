"""Mark rows whose content was already ingested by an earlier batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.functions.hashing import record_hash
from lakemill.operators.drift import source_columns
from lakemill.operators.skew import MIN_HOT_ROWS, ROWS_PER_TASK, hot_keys, spread_join

#: Hash of a record's content as it landed.
HASH = "_bronze_record_hash"


def with_landing_hash(df: DataFrame) -> DataFrame:
    """Add the content hash of the source columns, unless it is there already."""
    if HASH in df.columns:
        return df
    return df.withColumn(HASH, record_hash(source_columns(df)))


def first_seen(history: DataFrame) -> DataFrame:
    """One row per content hash of the history: the earliest batch that brought it."""
    earliest = F.min(F.struct("_bronze_ingestion_timestamp", "_bronze_ingestion_batch_id"))
    return history.groupBy(HASH).agg(
        earliest.getField("_bronze_ingestion_batch_id").alias("_dq_duplicate_of_batch")
    )


def mark_duplicates(
    df: DataFrame,
    history: DataFrame | None,
    *,
    salt_by: str,
    within_batch: bool = False,
    counted: DataFrame | None = None,
    rows: int | None = None,
    min_hot_rows: int = MIN_HOT_ROWS,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add ``_bronze_record_hash``, ``_dq_is_duplicate`` and ``_dq_duplicate_of_batch``.

    The row count never changes. ``history`` has one row per hash (``_dq_duplicate_of_batch``: the earliest batch with that
    content), as ``HashIndex.first_seen`` gives them, or is a bronze table: then the batch is cut to its distinct hashes, the
    table to those of its rows that have one of them, and that to one row per hash.

    As copies of one record may be a large share of the batch, its hot hashes are found first, which runs one job over the
    hash column, and spread. ``rows``: size of the batch if it is known; below ``min_hot_rows`` no hash can be hot.

    ``within_batch`` adds ``_dq_dup_in_batch`` for content that this batch repeats itself.
    ``counted`` is the batch in a cheaper form than ``df``, to count the hashes in.
    """
    hashed = with_landing_hash(df)
    if history is None and not within_batch:
        return hashed.withColumns(
            {"_dq_is_duplicate": F.lit(False), "_dq_duplicate_of_batch": F.lit(None).cast("string")}
        )
    scanned = with_landing_hash(df if counted is None else counted).select(HASH)
    hot = {} if rows is not None and rows < min_hot_rows else hot_keys(scanned, HASH, min_rows=min_hot_rows)
    own = scanned.groupBy(HASH).agg(F.count(F.lit(1)).alias("_copies"))

    seen = history
    if history is not None and "_dq_duplicate_of_batch" not in history.columns:
        stamps = history.select(HASH, "_bronze_ingestion_timestamp", "_bronze_ingestion_batch_id")
        seen = first_seen(stamps.join(own.select(HASH), HASH, "left_semi"))
    if within_batch:
        nowhere = F.lit(None).cast("string").alias("_dq_duplicate_of_batch")
        lookup = own.join(seen, HASH, "left") if seen is not None else own.select("*", nowhere)
    else:
        lookup = seen

    joined = spread_join(hashed, lookup, HASH, "left", hot=hot, salt_by=salt_by, rows_per_task=rows_per_task)
    joined = joined.withColumn("_dq_is_duplicate", F.col("_dq_duplicate_of_batch").isNotNull())
    if within_batch:
        joined = joined.withColumn("_dq_dup_in_batch", F.col("_copies") > 1).drop("_copies")
    return joined
