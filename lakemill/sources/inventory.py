"""Warehouse sheets: rows below the titles, derived stock columns and totals."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakemill.operators.line_numbers import with_positions

VOLUMETRIC_DIVISOR = 166


def column_name(header: str) -> str:
    """``Current Stock`` -> ``current_stock``; a unit in brackets is left out: ``Length (in)`` -> ``length``."""
    return re.sub(r"\W+", "_", re.sub(r"\(.*?\)", "", header).strip().lower()).strip("_")


def read_sheet(spark: SparkSession, path: str, headers: Sequence[str], width: int = 64) -> DataFrame:
    """A sheet saved as one CSV file, every column as text, named by ``column_name``.

    Title and empty rows above the header are left out: the header is the first row that holds all of ``headers``.
    Sheets have at most ``width`` columns. One job looks for the header; only that row reaches the driver.
    """
    schema = StructType([StructField(f"_c{k}", StringType()) for k in range(width)])
    cells = with_positions(spark.read.schema(schema).csv(path))
    row = F.array(*[F.trim(c) for c in schema.names])
    header = cells.where(reduce(lambda a, b: a & b, [F.array_contains(row, h) for h in headers])).orderBy("_part", "_pos").first()
    if header is None:
        raise ValueError(f"no row of {path} holds the headers {list(headers)}")
    names = {c: column_name(header[c]) for c in schema.names if header[c] and header[c].strip()}
    below = (F.col("_part") > header["_part"]) | ((F.col("_part") == header["_part"]) & (F.col("_pos") > header["_pos"]))
    filled = F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in names])
    return cells.where(below & filled.isNotNull()).select(*[F.col(c).alias(name) for c, name in names.items()])


def stock_values(inventory: DataFrame) -> DataFrame:
    """Available stock and value from their parts, also where a sheet holds an error text."""
    stock = F.col("current_stock").try_cast("bigint")
    reserved = F.col("reserved_stock").try_cast("bigint")
    cost = F.col("unit_cost").try_cast("decimal(12,2)")
    return inventory.withColumns(
        {
            "available_stock": F.try_subtract(stock, reserved),
            "computed_value": (stock * cost).try_cast("decimal(20,2)"),
        }
    )


def volumetric_weight(dimensions: DataFrame) -> DataFrame:
    """Weight by volume; sizes may be text, as in a sheet read from CSV."""
    length, width, height = (F.col(c).try_cast("decimal(12,4)") for c in ("length", "width", "height"))
    volume = length * width * height
    return dimensions.withColumn("volumetric_weight", F.round(volume / VOLUMETRIC_DIVISOR, 2))


def stated_value(inventory: DataFrame) -> DataFrame:
    """Sum of the stated values; error texts such as ``#DIV/0!`` count as 0."""
    value = F.coalesce(F.col("total_value").try_cast("decimal(20,2)"), F.lit(0))
    return inventory.agg(F.sum(value).alias("total_inventory_value"))


def sheet_summary(inventory: DataFrame, warehouses: DataFrame, dimensions: DataFrame) -> DataFrame:
    """Metric and value: products, warehouses, total inventory value."""
    counts = [
        frame.agg(F.count(F.lit(1)).cast("decimal(38,2)").alias("value")).select(F.lit(name).alias("metric"), "value")
        for name, frame in [("total_products", dimensions), ("total_warehouses", warehouses)]
    ]
    value = stated_value(inventory).select(
        F.lit("total_inventory_value").alias("metric"), F.col("total_inventory_value").cast("decimal(38,2)").alias("value")
    )
    return counts[0].unionByName(counts[1]).unionByName(value)
