"""Product catalogue XML -> products, attributes and images."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakemill.functions.dates import parse_timestamp
from lakemill.functions.text import folded

# Layout of one Product element. ``_x`` is an attribute, ``_VALUE`` the text.
PRODUCT = """
    _id string, _product_id string, _status string, SKU string, Title string, Description string,
    Category struct<_VALUE:string,MainCategory:string,SubCategory:string>, Brand string,
    Pricing struct<_currency:string,ListPrice:string,SalePrice:string>,
    Inventory struct<StockQuantity:struct<_VALUE:string,_warehouse:string>,Availability:string>,
    Attributes struct<Attribute:array<struct<_VALUE:string,_name:string>>>,
    Images struct<Image:array<struct<_VALUE:string,_type:string>>>,
    Reviews struct<AverageRating:string,ReviewCount:string>,
    Shipping struct<Weight:struct<_VALUE:string,_unit:string>,Dimensions:struct<_VALUE:string,_unit:string>>,
    Dates struct<Created:string,LastUpdated:string>
"""
DATES = ["yyyy-MM-dd", "MM/dd/yyyy", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]"]
WEIGHT_UNITS = {"kg": ["kg"], "lb": ["lb", "lbs"]}
LENGTH_UNITS = {"cm": ["cm"], "in": ["in", "inches"]}


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Products from XML files.

    The files are cut at each closing tag, so that one large file is read by many tasks;
    the XML reader takes a file with records of several lines as one task.
    """
    pieces = spark.read.option("lineSep", "</Product>").text(path)
    opened = pieces.select(F.regexp_extract("value", r"(?s)(<Product[\s>].*)", 1).alias("value"))
    elements = opened.filter(F.col("value") != "")
    return parse_products(elements.select(F.concat("value", F.lit("</Product>")).alias("value")))


def parse_products(df: DataFrame, column: str = "value") -> DataFrame:
    """Products from a text column with one Product element per row."""
    schema = StructType.fromDDL(PRODUCT)
    return df.select(F.from_xml(column, schema).alias("product")).select("product.*")


def _product_id() -> Column:
    return F.coalesce("_id", "_product_id")


def _unit(c: Column, units: dict[str, list[str]]) -> Column:
    word = folded(c)
    mapped = F
    for name, words in units.items():
        mapped = mapped.when(word.isin(words), F.lit(name))
    return mapped


def _price(c: Column) -> Column:
    """Decimal price; blank, unreadable and negative prices are null."""
    value = c.try_cast("decimal(12,2)")
    return F.when(value >= 0, value)


def _filled(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def products(catalogue: DataFrame) -> DataFrame:
    currency = F.upper(F.trim("Pricing._currency"))
    size = F.split("Shipping.Dimensions._VALUE", "x")
    nested_main = F.col("Category.MainCategory")
    return catalogue.select(
        _product_id().alias("product_id"),
        _filled(F.lower("_status")).alias("status"),
        _filled(F.col("SKU")).alias("sku"),
        F.col("Title").alias("title"),
        F.col("Description").alias("description"),
        _filled(F.coalesce(nested_main, F.col("Category._VALUE"))).alias("main_category"),
        F.col("Category.SubCategory").alias("sub_category"),
        _filled(F.col("Brand")).alias("brand"),
        F.when(currency.isin("USD", "$", "US$"), "USD").otherwise(_filled(currency)).alias("currency"),
        _price(F.col("Pricing.ListPrice")).alias("list_price"),
        _price(F.col("Pricing.SalePrice")).alias("sale_price"),
        F.col("Inventory.StockQuantity._VALUE").try_cast("int").alias("stock_quantity"),
        F.col("Inventory.StockQuantity._warehouse").alias("warehouse"),
        _filled(F.replace(F.lower("Inventory.Availability"), F.lit(" "), F.lit("_"))).alias("availability"),
        F.col("Reviews.AverageRating").try_cast("decimal(3,1)").alias("average_rating"),
        F.col("Reviews.ReviewCount").try_cast("int").alias("review_count"),
        F.col("Shipping.Weight._VALUE").try_cast("decimal(10,2)").alias("weight"),
        _unit(F.col("Shipping.Weight._unit"), WEIGHT_UNITS).alias("weight_unit"),
        *[F.get(size, F.lit(i)).try_cast("int").alias(n) for i, n in enumerate(["length", "width", "height"])],
        _unit(F.col("Shipping.Dimensions._unit"), LENGTH_UNITS).alias("dimension_unit"),
        parse_timestamp(F.col("Dates.Created"), DATES).cast("date").alias("created_on"),
        parse_timestamp(F.col("Dates.LastUpdated"), DATES).alias("updated_at"),
    )


def attributes(catalogue: DataFrame) -> DataFrame:
    """One row per product attribute, in document order, names in lower case."""
    listed = catalogue.select(
        _product_id().alias("product_id"), F.posexplode("Attributes.Attribute").alias("position", "attribute")
    )
    return listed.select(
        "product_id", "position", F.lower("attribute._name").alias("name"), F.col("attribute._VALUE").alias("value")
    )


def images(catalogue: DataFrame) -> DataFrame:
    listed = catalogue.select(
        _product_id().alias("product_id"), F.posexplode("Images.Image").alias("position", "image")
    )
    return listed.select(
        "product_id", "position", F.col("image._type").alias("type"), F.col("image._VALUE").alias("url")
    )
