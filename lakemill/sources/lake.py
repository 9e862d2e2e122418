"""Layer tables: existence, scans of batches, appends."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import UTC, datetime

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

BATCH = "_bronze_ingestion_batch_id"
INGESTED_ON = "_bronze_ingestion_date"
INGESTED_AT = "_bronze_ingestion_timestamp"
SILVER_BATCH = "_silver_batch_id"


def read_table(
    spark: SparkSession, path: str, schema: StructType | str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Scan a table. With a schema no footer is read to plan the scan; without one the
    schemas of all files are merged."""
    reader = spark.read.format(fmt)
    reader = reader.option("mergeSchema", True) if schema is None else reader.schema(schema)
    return reader.load(path)


def existing_table(
    spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet"
) -> DataFrame | None:
    """The table, or null if its folder does not exist. Other failures are raised."""
    try:
        return read_table(spark, path, schema, fmt)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def table_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    return existing_table(spark, path, "_probe string", fmt) is not None


def one_batch(df: DataFrame, batch_id: str) -> DataFrame:
    return df.filter(F.col(BATCH) == batch_id)


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: StructType | str) -> DataFrame:
    """Few rows of the driver as a local relation: written by one task, without a Python worker. Moments without a zone are
    those of the driver's zone."""
    struct = StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def known(value):
        return value.astimezone(UTC) if isinstance(value, datetime) else value

    columns = [[known(row[k]) for row in rows] for k in range(len(struct.fields))]
    arrow = to_arrow_schema(struct)
    return spark.createDataFrame(pa.table([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow), struct)


def folder_name(spark: SparkSession, value: str) -> str:
    """A partition value as it stands in a folder's name."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)


# The manifest beside a bronze table: each batch that was stored whole, when, and with how many rows.
MANIFEST = "bronze_batch string, version timestamp, ingested_at timestamp, records bigint"


def manifest_path(bronze_path: str) -> str:
    return f"{bronze_path.rstrip('/')}_manifest"


def note_batch(spark: SparkSession, bronze_path: str, batch_id: str, ingested_at: datetime, records: int) -> None:
    """Note that a batch is stored whole; until then ``refine`` doesn't see it."""
    row = (batch_id, datetime.now(), ingested_at, records)
    small_table(spark, [row], MANIFEST).write.mode("append").parquet(manifest_path(bronze_path))


def noted_batches(spark: SparkSession, bronze_path: str) -> DataFrame | None:
    """The newest note on each batch; null without a manifest."""
    notes = existing_table(spark, manifest_path(bronze_path), MANIFEST)
    if notes is None:
        return None
    newest = F.max_by(F.struct("version", "ingested_at", "records"), "version").alias("n")
    return notes.groupBy("bronze_batch").agg(newest).select("bronze_batch", "n.version", "n.ingested_at", "n.records")


def make_manifest(spark: SparkSession, bronze_path: str, schema: StructType) -> None:
    """Note the batches of a bronze table that has no manifest, from one pass over three narrow columns."""
    bronze = read_table(spark, bronze_path, schema)
    found = bronze.select(BATCH, INGESTED_AT, F.col("_metadata.file_modification_time").alias("at")).groupBy(BATCH)
    rows = found.agg(F.max("at").alias("version"), F.min(INGESTED_AT).alias("ingested_at"), F.count(F.lit(1)).alias("records"))
    rows.withColumnRenamed(BATCH, "bronze_batch").coalesce(1).write.mode("append").parquet(manifest_path(bronze_path))


# The ledger beside a silver table: which bronze batch, in which state, went into which silver batch.
LEDGER = "bronze_batch string, version timestamp, silver_batch string, recorded_at timestamp"


def ledger_path(silver_path: str) -> str:
    return f"{silver_path.rstrip('/')}_ledger"


def record_batches(spark: SparkSession, silver_path: str, versions: Mapping[str, datetime | None], silver_batch: str) -> None:
    """Note that these bronze batches were read for a silver batch, also those that left no row in it."""
    now = datetime.now()
    rows = [(batch, version, silver_batch, now) for batch, version in sorted(versions.items())]
    small_table(spark, rows, LEDGER).write.mode("append").parquet(ledger_path(silver_path))


def recorded_batches(spark: SparkSession, silver_path: str) -> DataFrame | None:
    """The newest note on each bronze batch."""
    ledger = existing_table(spark, ledger_path(silver_path), LEDGER)
    if ledger is None:
        return None
    newest = F.max_by(F.struct("version", "silver_batch"), "recorded_at").alias("n")
    return ledger.groupBy("bronze_batch").agg(newest).select("bronze_batch", "n.version", "n.silver_batch")


def pending_batches(spark: SparkSession, bronze_path: str, silver_path: str) -> DataFrame | None:
    """Batches that no silver batch has read in their present state: bronze_batch, version, records, and the silver batch
    that read an earlier state (null for a new batch). Reads the manifest and the ledger only; null without a manifest."""
    notes, done = noted_batches(spark, bronze_path), recorded_batches(spark, silver_path)
    if notes is None:
        return None
    if done is None:
        return notes.select("bronze_batch", "version", "records", F.lit(None).cast("string").alias("silver_batch"))
    earlier = done.withColumnRenamed("version", "seen")
    pending = notes.join(earlier, "bronze_batch", "left")
    return pending.where("seen IS NULL OR version > seen").select("bronze_batch", "version", "records", "silver_batch")


def told(observation: Observation) -> dict[str, int] | None:
    """What a write told; null if the optimizer had found out that there was nothing to write, and dropped the counts."""
    try:
        return observation.get
    except Py4JJavaError:
        return None


def staged(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """The rows as a stored table, so that later passes do not compute them again."""
    df.write.format(fmt).mode("overwrite").save(path)
    return read_table(df.sparkSession, path, df.schema, fmt)


def drop_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str], fmt: str) -> None:
    """Write partitions, each in place of a former version of itself."""
    (
        df.write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .save(path)
    )


def write_bronze_batch(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Add one batch, partitioned by ingestion day and batch id.

    Only the partitions of this batch are replaced, so a repeated run of a failed batch
    does not store rows twice.
    """
    _replace_partitions(df, path, [INGESTED_ON, BATCH], fmt)


def batch_folders(spark: SparkSession, path: str, depth: int, batch_id: str) -> dict[str, set[str]]:
    """Folders of a silver batch and the files in them; one folder per partition that the batch has rows in."""
    jvm = spark._jvm
    name = folder_name(spark, batch_id)
    pattern = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}{'/*' * depth}/{SILVER_BATCH}={name}")
    store = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    found = store.globStatus(pattern) or []
    return {str(f.getPath()): {str(x.getPath()) for x in store.listStatus(f.getPath())} for f in found}


def write_silver_batch(
    df: DataFrame, path: str, partition_by: Sequence[str], *, batch_id: str, gather: bool, fmt: str = "parquet",
    told: Observation | None = None, metrics: Sequence[Column] = (),
) -> None:
    """Add one silver batch, partitioned by the given columns and, within those, its id.

    ``told`` gets the ``metrics`` of the rows as they are written. A batch that was written before is replaced as a whole: partitions it no longer has rows in are dropped.
    ``gather``: the rows of a task fall into many partitions. ``REBALANCE`` then brings
    those of a partition together in files of the advisory size, and splits a partition
    that is too large for one task. Without it each task writes its own file.
    """
    rows = df.hint("rebalance", *[F.col(c) for c in partition_by]) if gather else df
    if told is not None:
        rows = rows.observe(told, *metrics)
    spark, depth = df.sparkSession, len(partition_by)
    before = batch_folders(spark, path, depth, batch_id)
    _replace_partitions(rows, path, [*partition_by, SILVER_BATCH], fmt)
    for folder, files in batch_folders(spark, path, depth, batch_id).items():
        if before.get(folder) == files:
            drop_folder(spark, folder)
