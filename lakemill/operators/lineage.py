"""Lineage columns of the bronze and silver layers."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemill.functions.hashing import record_hash
from lakemill.operators.drift import source_columns


def _moment(at: datetime | None) -> Column:
    return F.current_timestamp() if at is None else F.lit(at).cast("timestamp")


def add_bronze_lineage(
    df: DataFrame,
    *,
    batch_id: str,
    source_file: str,
    ingested_at: datetime | None = None,
    schema_version: str = "1.0",
) -> DataFrame:
    at = _moment(ingested_at)
    file = F.col("_file") if "_file" in df.columns else F.lit(source_file)
    return df.withColumns(
        {
            "_bronze_ingestion_timestamp": at,
            "_bronze_ingestion_date": F.date_format(at, "yyyy-MM-dd"),
            "_bronze_source_file": file,
            "_bronze_ingestion_batch_id": F.lit(batch_id),
            "_bronze_raw_record": F.to_json(F.struct(*source_columns(df))),
            "_bronze_file_hash": F.md5(file),
            "_schema_version": F.lit(schema_version),
        }
    )


def add_silver_lineage(
    df: DataFrame,
    *,
    batch_id: str,
    hash_columns: Sequence[str],
    processed_at: datetime | None = None,
) -> DataFrame:
    """``hash_columns`` must not depend on the day of the run, so that hashes stay equal."""
    at = _moment(processed_at)
    return df.withColumns(
        {
            "_silver_processing_timestamp": at,
            "_silver_processing_date": at.cast("date"),
            "_silver_batch_id": F.lit(batch_id),
            "_silver_source_batch_id": F.col("_bronze_ingestion_batch_id"),
            "_silver_record_hash": record_hash(hash_columns),
        }
    )
