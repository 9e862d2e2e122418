"""Pack the small files of closed silver batches into few large ones.

A silver batch lies in a folder of its own in each partition it has rows in, so that it can be replaced. Closed batches are
packed together into a segment: files of about ``target_rows`` rows, in the order of the partition columns, which are
ordinary columns there and prune by the statistics in the files. A log tells which segment a batch lies in; readers take
a batch from there or, without a note, from its folders. So a batch moves as a whole when its note is written, a run that
stops before leaves all as it was, and a packed batch that is made again is read from its new folders.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from math import ceil

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from lakemill.sources import lake

LOG = "silver_batch string, segment string, noted_at timestamp"
TARGET_ROWS = 1_000_000


@dataclass(frozen=True)
class Packed:
    batches: tuple[str, ...]
    rows: int
    files: int


def _packed_path(silver_path: str) -> str:
    return f"{silver_path.rstrip('/')}_packed"


def _log_path(silver_path: str) -> str:
    return f"{silver_path.rstrip('/')}_packed_log"


def packed_batches(spark: SparkSession, silver_path: str) -> DataFrame | None:
    """silver_batch and segment of the batches that are read from segments; null if nothing was ever packed."""
    log = lake.existing_table(spark, _log_path(silver_path), LOG)
    if log is None:
        return None
    newest = F.max_by(F.struct("segment"), "noted_at").getField("segment").alias("segment")
    return log.groupBy("silver_batch").agg(newest).where("segment IS NOT NULL")


def _note(spark: SparkSession, silver_path: str, batches: Sequence[str], segment: str | None) -> None:
    now = datetime.now()
    rows = lake.small_table(spark, [(b, segment, now) for b in batches], LOG)
    rows.write.mode("append").parquet(_log_path(silver_path))


def silver_rows(spark: SparkSession, silver_path: str, schema: StructType | str | None = None) -> DataFrame | None:
    """The rows of a silver table, packed or not; null if there is no such table.

    The log has one row per silver batch; it is broadcast.
    """
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    live = packed_batches(spark, silver_path)
    if live is None:
        if wanted is None:
            return lake.read_table(spark, silver_path) if lake.table_exists(spark, silver_path) else None
        return lake.existing_table(spark, silver_path, wanted)
    read = StructType(list((wanted or lake.read_table(spark, _packed_path(silver_path)).drop("segment").schema).fields))
    if lake.SILVER_BATCH not in read.names:
        read = read.add(lake.SILVER_BATCH, StringType())
    batch = F.col("silver_batch").alias(lake.SILVER_BATCH)
    packed = lake.read_table(spark, _packed_path(silver_path), StructType(list(read.fields)).add("segment", StringType()))
    packed = packed.join(F.broadcast(live.select(batch, "segment")), [lake.SILVER_BATCH, "segment"], "left_semi").drop("segment")
    rows = lake.existing_table(spark, silver_path, read)
    if rows is None:
        rows = packed
    else:
        rows = rows.join(F.broadcast(live.select(batch)), lake.SILVER_BATCH, "left_anti").unionByName(packed)
    return rows.select(*(wanted or read).names)


def compact(
    spark: SparkSession, silver_path: str, partition_by: Sequence[str], *, keep_open: Sequence[str] = (),
    target_rows: int = TARGET_ROWS,
) -> Packed:
    """Pack all batches in the ledger that lie in folders, but for ``keep_open``, into one new segment.

    Rows and values stay as they are. The ids of silver batches reach the driver.
    """
    recorded = lake.recorded_batches(spark, silver_path)
    live = packed_batches(spark, silver_path)
    if recorded is None:
        return Packed((), 0, 0)
    names = recorded.select("silver_batch").distinct()
    if live is not None:
        names = names.join(live, "silver_batch", "left_anti")
    batches = sorted({r[0] for r in names.collect()} - set(keep_open))
    folders = {b: lake.batch_folders(spark, silver_path, len(partition_by), b) for b in batches}
    if not any(folders.values()):
        return Packed((), 0, 0)
    rows = lake.read_table(spark, silver_path).where(F.col(lake.SILVER_BATCH).isin(batches))
    number = rows.count()  # from the files' footers
    files, segment = max(1, ceil(number / target_rows)), f"pack-{uuid.uuid4().hex}"
    order = [F.col(c) for c in partition_by]
    # The hash parts the rows of a partition that is larger than a file.
    dealt = rows.repartitionByRange(files, *order, F.xxhash64(*[F.col(c) for c in rows.columns]))
    told = Observation()
    written = dealt.sortWithinPartitions(*order).observe(told, F.count(F.lit(1)).alias("rows"))
    folder = f"{_packed_path(silver_path)}/segment={segment}"
    written.write.mode("overwrite").parquet(folder)
    packed = (lake.told(told) or {"rows": 0})["rows"]
    if packed != number:
        lake.drop_folder(spark, folder)
        raise RuntimeError(f"{silver_path}: {packed} of {number} rows were packed")
    _note(spark, silver_path, batches, segment)
    for found in folders.values():
        for name in found:
            lake.drop_folder(spark, name)
    return Packed(tuple(batches), number, files)


def unpack(spark: SparkSession, silver_path: str, batch_id: str) -> None:
    """Note that a batch was made again and lies in its own folders, if it was packed."""
    live = packed_batches(spark, silver_path)
    if live is not None and not live.where(F.col("silver_batch") == batch_id).isEmpty():
        _note(spark, silver_path, [batch_id], None)
