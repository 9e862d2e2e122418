"""Silver refinement as a stream over the bronze files, with the batch transforms."""

from __future__ import annotations

import hashlib
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lakemill.operators.audit import AuditLog
from lakemill.operators.skew import MIN_HOT_ROWS
from lakemill.plans.silver import SILVER, refine


def refine_available(
    spark: SparkSession,
    table: str,
    bronze_path: str,
    silver_path: str,
    checkpoint_path: str,
    *,
    as_of: date,
    orders_path: str | None = None,
    min_hot_rows: int = MIN_HOT_ROWS,
    audit: AuditLog | None = None,
) -> StreamingQuery:
    """Refine all bronze batches that arrived since the last run, then stop.

    The stream only tells that files came: a micro-batch refines what the ledger doesn't hold yet. So a bronze batch that
    is ingested again replaces its silver rows, and a micro-batch that is repeated after a failure has the same silver
    batch id and replaces what it wrote before. The id comes from the checkpoint path, so a new stream needs a new one.
    """
    schema = SILVER[table].contract.bronze_schema
    stream = hashlib.md5(checkpoint_path.encode()).hexdigest()[:8]

    def refine_batch(rows: DataFrame, epoch: int) -> None:
        refine(
            spark, table, bronze_path, silver_path, batch_id=f"{table}-{stream}-{epoch}", as_of=as_of,
            orders_path=orders_path, min_hot_rows=min_hot_rows, audit=audit,
        )

    return (
        spark.readStream.schema(schema)
        .parquet(bronze_path)
        .writeStream.foreachBatch(refine_batch)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
