"""Dense line numbers 1..n over a scan, without sending all rows to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_ROW_BITS = (1 << 33) - 1


def with_positions(scan: DataFrame) -> DataFrame:
    """Add ``_part`` and ``_pos``: the scan partition of a row and its position in there."""
    return scan.withColumns(
        {
            "_part": F.spark_partition_id(),
            "_pos": F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)),
        }
    )


def with_files(scan: DataFrame) -> DataFrame:
    """Add ``_file`` and ``_block``: the file of a row, and where the part of the file begins that its task read."""
    return scan.withColumns({"_file": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start")})


def number_positions(placed: DataFrame, column: str) -> DataFrame:
    """Dense numbers in the order of (``_part``, ``_pos``), or per file if the rows have ``_file`` and ``_block``.

    The running total of the rows per partition, a table with one row per scan partition (per block of a file),
    is broadcast; each row adds its position.
    """
    if "_file" in placed.columns:
        blocks = placed.groupBy("_file", "_block").agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_rows"))
        before = F.sum("_rows").over(Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
        offsets = blocks.select("_file", "_block", "_first", F.coalesce(before, F.lit(0)).alias("_before"))
        number = F.col("_before") + F.col("_pos") - F.col("_first") + 1
        numbered = placed.join(F.broadcast(offsets), ["_file", "_block"]).withColumn(column, number)
        return numbered.drop("_part", "_pos", "_block", "_first", "_before")
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    numbered = placed.join(F.broadcast(offsets), "_part")
    return numbered.withColumn(column, F.col("_before") + F.col("_pos") + 1).drop("_part", "_pos", "_before")


def number_lines(scan: DataFrame, column: str = "_bronze_source_line_number") -> DataFrame:
    """Number the rows of a bare file scan, whose partitions are the same in both passes."""
    return number_positions(with_positions(scan), column)
