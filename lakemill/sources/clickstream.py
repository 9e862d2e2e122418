"""Clickstream JSON lines -> flat events."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.functions.dates import EVENT_TIMES, parse_timestamp
from lakemill.functions.text import yes_no

# Layout of one event. Mixed JSON types are read as text.
EVENT = """
    event_id string, event_type string, timestamp string, session_id string, user_id string,
    device struct<type:string,browser:string,os:string,screen_resolution:string>,
    device_type string, browser string,
    location struct<country:string,state:string,city:string,ip_address:string>,
    product struct<product_id:string,product_name:string,category:string,price:decimal(12,2),in_stock:string>,
    cart_action struct<product_id:string,quantity:int,price:decimal(12,2)>,
    search_query string, results_count int,
    order struct<order_id:string,total_amount:decimal(12,2),items_count:int>,
    page struct<url:string,referrer:string,load_time_ms:int>,
    marketing struct<campaign_id:string,source:string,medium:string>,
    metadata struct<user_agent:string,ab_test_variant:string>,
    _corrupt_record string
"""
#: A line that can't be read is kept as text in this column.
CORRUPT = {"columnNameOfCorruptRecord": "_corrupt_record"}


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EVENT).options(**CORRUPT).json(path)


def parse_events(lines: DataFrame, column: str = "value") -> DataFrame:
    """Events from a text column with one JSON object per row."""
    return lines.select(F.from_json(column, EVENT, CORRUPT).alias("event")).select("event.*")


def flatten_events(events: DataFrame) -> DataFrame:
    """One flat row per event; nested and flat device layouts end in the same columns."""
    return events.select(
        "event_id",
        "event_type",
        parse_timestamp(F.col("timestamp"), EVENT_TIMES).alias("event_time"),
        "session_id",
        "user_id",
        F.lower(F.coalesce("device.type", "device_type")).alias("device_type"),
        F.lower(F.coalesce("device.browser", "browser")).alias("browser"),
        F.lower("device.os").alias("os"),
        F.col("device.screen_resolution").alias("screen_resolution"),
        *[F.col(f"location.{c}").alias(c) for c in ("country", "state", "city", "ip_address")],
        F.coalesce("product.product_id", "cart_action.product_id").alias("product_id"),
        F.col("product.product_name").alias("product_name"),
        F.col("product.category").alias("category"),
        F.coalesce("product.price", "cart_action.price").alias("price"),
        yes_no(F.col("product.in_stock")).alias("in_stock"),
        F.col("cart_action.quantity").alias("quantity"),
        "search_query",
        "results_count",
        F.col("order.order_id").alias("order_id"),
        F.col("order.total_amount").alias("order_total"),
        F.col("order.items_count").alias("order_items"),
        F.col("page.url").alias("page_url"),
        F.col("page.referrer").alias("referrer"),
        F.col("page.load_time_ms").alias("load_time_ms"),
        F.col("marketing.campaign_id").alias("campaign_id"),
        F.col("marketing.source").alias("marketing_source"),
        F.col("marketing.medium").alias("marketing_medium"),
        F.col("metadata.user_agent").alias("user_agent"),
        F.col("metadata.ab_test_variant").alias("ab_test_variant"),
        "_corrupt_record",
    )


def events_by_type(events: DataFrame) -> DataFrame:
    """Events per type, most frequent first."""
    named = events.groupBy(F.coalesce("event_type", F.lit("unknown")).alias("event_type"))
    return named.agg(F.count(F.lit(1)).alias("events")).orderBy(F.desc("events"), "event_type")


# Fields of an event that should be numbers, and their types.
NUMBERS = {
    "price": ("$.product.price", "decimal(12,2)"), "cart_price": ("$.cart_action.price", "decimal(12,2)"),
    "quantity": ("$.cart_action.quantity", "int"), "results_count": ("$.results_count", "int"),
    "order_total": ("$.order.total_amount", "decimal(12,2)"), "order_items": ("$.order.items_count", "int"),
}


def parse_mixed(lines: DataFrame, column: str = "value", numbers: Mapping[str, tuple[str, str]] = NUMBERS) -> DataFrame:
    """Events whose numbers come in mixed JSON types, with their values kept.

    A number in quotes is read as that number, also with a currency sign, thousands commas or blanks; an array of one
    value as that value. ``mixed_types`` lists ``field:TYPE`` of what was no plain number, and ``unread`` keeps, as JSON
    text by field, what still is none: other texts, longer arrays, objects. A line that is no JSON has a null event_id,
    no numbers, and is kept in ``_corrupt_record``.
    """
    events = lines.select(F.col(column).alias("_line"), F.try_parse_json(F.col(column)).alias("_event"))
    found = {name: F.try_variant_get("_event", path, "variant") for name, (path, _) in numbers.items()}
    events = events.withColumns({f"_v_{name}": value for name, value in found.items()})
    values, flags, kept = {}, [], []
    for name, (_, kind) in numbers.items():
        given = F.col(f"_v_{name}")
        shape = F.schema_of_variant(given)
        array = shape.startswith("ARRAY") & F.try_variant_get(given, "$[1]", "variant").isNull()
        inner = F.when(array, F.try_variant_get(given, "$[0]", "string")).otherwise(F.try_variant_get(given, "$", "string"))
        value = F.regexp_replace(inner, r"[$,\s]", "").try_cast(kind)
        values[name] = value
        plain = shape.rlike("^(BIGINT|DECIMAL|DOUBLE|VOID)")
        flags.append(F.when(~plain, F.concat(F.lit(f"{name}:"), F.regexp_extract(shape, "^[A-Z]+", 0))))
        kept.append(F.when(~plain & value.isNull(), F.struct(F.lit(name).alias("key"), F.to_json(given).alias("value"))))
    return events.select(
        F.try_variant_get("_event", "$.event_id", "string").alias("event_id"),
        F.try_variant_get("_event", "$.event_type", "string").alias("event_type"),
        *[value.alias(name) for name, value in values.items()],
        F.array_compact(F.array(*flags)).alias("mixed_types"),
        F.map_from_entries(F.array_compact(F.array(*kept))).alias("unread"),
        F.when(F.col("_event").isNull(), F.col("_line")).alias("_corrupt_record"),
    )
