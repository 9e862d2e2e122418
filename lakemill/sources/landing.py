"""Landing files: CSV whose header may differ from file to file."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.operators.line_numbers import with_files

#: A path with more different headers is not taken as one feed.
MOST_HEADERS = 200


@dataclass(frozen=True)
class Header:
    """Columns of a header line, in order, and the files that have it (null: the one file or all files of the path)."""

    columns: tuple[str, ...]
    files: tuple[str, ...] | None


def first_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file and its first line; files without any line are left out. One pass over the bytes, one row per file."""
    lines = spark.read.text(path).select(
        F.col("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
    )
    return lines.where("block = 0").groupBy("file").agg(F.min_by("value", "at").alias("line"))


def headers(spark: SparkSession, path: str | list[str]) -> list[Header]:
    """The different headers of a path. A path of one file is not scanned; of many, names and first lines reach the driver."""
    reader = spark.read.option("header", True)
    if len(spark.read.text(path).inputFiles()) < 2:
        return [Header(tuple(reader.csv(path).columns), None)]
    files: dict[str, list[str]] = {}
    for row in first_lines(spark, path).collect():
        files.setdefault(row["line"], []).append(unquote(row["file"]))
    if len(files) > MOST_HEADERS:
        raise ValueError(f"{path} has files with {len(files)} different headers")
    if len(files) < 2:
        return [Header(tuple(reader.csv(path).columns), None)]
    return [Header(tuple(reader.csv(min(names)).columns), tuple(sorted(names))) for _, names in sorted(files.items())]


def read_landing(spark: SparkSession, path: str | list[str], *, files: bool = False) -> tuple[DataFrame, list[Header]]:
    """All rows of a path (or several), every column as text, empty fields as null, and the headers found.

    Each group of files with the same header is one scan under its own columns; rows are then put together by column name,
    so a file with columns in another order, with more or with fewer of them shifts nothing. ``files``: keep the file of
    each row, and where the part of it begins that its task read (``_file``, ``_block``).
    """
    found = headers(spark, path)

    def scan(header: Header) -> DataFrame:
        schema = ", ".join("`" + c.replace("`", "``") + "` string" for c in header.columns)
        reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False)
        rows = reader.csv(path if header.files is None else list(header.files))
        return with_files(rows) if files else rows

    scans = [scan(header) for header in found]
    return reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), scans), found


def read_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The rows of ``read_landing``."""
    return read_landing(spark, path)[0]


def drift_by_header(found: Sequence[Header], expected: Sequence[str]) -> list[dict]:
    """Per header that isn't the expected one: columns it has more and lacks, whether order differs, number of files, one of them."""
    drifted = []
    for header in found:
        if list(header.columns) != list(expected):
            drifted.append({
                "new_columns": sorted(set(header.columns) - set(expected)),
                "missing_columns": sorted(set(expected) - set(header.columns)),
                "reordered": [c for c in header.columns if c in set(expected)] != [c for c in expected if c in set(header.columns)],
                "files": 1 if header.files is None else len(header.files),
                "example": None if header.files is None else header.files[0],
            })
    return drifted
