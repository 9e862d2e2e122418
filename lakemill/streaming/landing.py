"""Landing files to bronze as a stream: each new file is ingested once, in the micro-batch that finds it."""

from __future__ import annotations

import hashlib
from datetime import date
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakemill.contracts import FeedContract
from lakemill.operators.audit import AuditLog
from lakemill.operators.skew import MIN_HOT_ROWS
from lakemill.plans.bronze import ingest


def ingest_available(
    spark: SparkSession,
    contract: FeedContract,
    landing_path: str,
    bronze_path: str,
    checkpoint_path: str,
    *,
    as_of: date,
    max_files: int | None = None,
    min_hot_rows: int = MIN_HOT_ROWS,
    audit: AuditLog | None = None,
) -> StreamingQuery:
    """Ingest all landing files that arrived since the last run, then stop; ``max_files``: files per micro-batch.

    The stream's source keeps which files it has seen; a micro-batch ingests its files as one bronze batch, whose id comes
    from the checkpoint and the epoch, so one that is repeated after a failure replaces what it wrote. What content came
    first is state that outlives the query: the hash index beside the bronze table, which the batch path shares. Rows thus
    equal those of ``ingest`` over the same groups of files, whether they were streamed or not.
    """
    stream = hashlib.md5(checkpoint_path.encode()).hexdigest()[:8]

    def ingest_batch(lines: DataFrame, epoch: int) -> None:
        found = lines.select("file").distinct().collect()  # the files of a micro-batch, as the source listed them
        files = sorted(unquote(row["file"]) for row in found)
        if files:
            ingest(
                spark, contract, files, bronze_path, batch_id=f"{contract.name}-{stream}-{epoch:06d}", as_of=as_of,
                min_hot_rows=min_hot_rows, audit=audit,
            )

    reader = spark.readStream.format("text")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return (
        reader.load(landing_path)
        .select(F.col("_metadata.file_path").alias("file"))
        .writeStream.foreachBatch(ingest_batch)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
