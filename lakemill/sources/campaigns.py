"""Campaign logs in five text layouts, and campaign performance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Layouts of a log line and the actions it may name.
JSON_LINE = """
    timestamp string, level string, campaign_id string, customer_id string, channel string,
    action string, message_id string,
    metadata struct<device:string,os:string,ip_address:string>
"""
LAYOUTS = {
    "json": r"^\{.*\}\s*$",
    "key_value": r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2} \[\w+\] \w+=",
    "piped": r"^\d{4}-\d{2}-\d{2}T[\d:.]+ \| ",
    "bracketed": r"^\[\d{8} [\d:.]+\] \w+: ",
    "free_text": r"^\d{2}/[A-Z][a-z]{2}/\d{4}:\d{2}:\d{2}:\d{2} ",
}
TIMES = {
    "json": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]",
    "key_value": "yyyy-MM-dd HH:mm:ss",
    "piped": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]",
    "bracketed": "yyyyMMdd HH:mm:ss.SSS",
    "free_text": "dd/MMM/yyyy:HH:mm:ss",
}
FREE_TEXT_ACTIONS = {
    "sent": "sent to customer",
    "clicked": "clicked link",
    "delivered": "delivered successfully",
    "bounced": "bounced",
    "unsubscribed": "unsubscribed",
    "failed": "Failed to send",
    "converted": "conversion recorded",
}


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def _found(line: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(line, pattern, 1), F.lit(""))


def parse_log(lines: DataFrame, column: str = "value") -> DataFrame:
    """One row per line with the fields its layout carries.

    Lines of no known layout are kept with ``format`` = ``unparsed``. The layout is
    decided once per line; each field is read from the JSON object, from the pairs or
    from the text accordingly.
    """
    line = F.col(column)
    layout = F
    for name, pattern in LAYOUTS.items():
        layout = layout.when(line.rlike(pattern), F.lit(name))
    tagged = lines.select(line.alias("raw"), layout.otherwise("unparsed").alias("format"))

    raw, fmt = F.col("raw"), F.col("format")
    read = tagged.withColumn("_json", F.when(fmt == "json", F.from_json("raw", JSON_LINE)))

    def pair(name: str) -> Column:
        return _found(raw, rf"(?i) {name}=(\S+)")

    time_text = (
        F.when(fmt == "json", F.col("_json.timestamp"))
        .when(fmt == "key_value", F.substring(raw, 1, 19))
        .when(fmt == "piped", _found(raw, r"^(\S+)"))
        .when(fmt == "bracketed", _found(raw, r"^\[([^\]]+)\]"))
        .when(fmt == "free_text", F.substring(raw, 1, 20))
    )
    moment = F
    for name, pattern in TIMES.items():
        moment = moment.when(fmt == name, F.try_to_timestamp("_time", F.lit(pattern)))
    worded = F
    for action, words in FREE_TEXT_ACTIONS.items():
        worded = worded.when(raw.contains(words), F.lit(action))
    level = (
        F.when(fmt == "json", F.col("_json.level"))
        .when(fmt == "key_value", _found(raw, r"\[(\w+)\]"))
        .when(fmt == "piped", pair("level"))
        .when(fmt == "bracketed", _found(raw, r"\] (\w+): "))
        .when(fmt == "free_text", _found(raw, r"^\S+ (ERROR): "))
    )
    campaign = (
        F.when(fmt == "json", F.col("_json.campaign_id"))
        .when(fmt.isin("key_value", "piped"), pair("campaign"))
        .when(fmt.isin("bracketed", "free_text"), _found(raw, r"[Cc]ampaign (CAMP\d+)"))
    )
    customer = (
        F.when(fmt == "json", F.col("_json.customer_id"))
        .when(fmt.isin("key_value", "piped"), pair("customer"))
        .when(fmt.isin("bracketed", "free_text"), _found(raw, r"(CUST\d+)"))
    )
    channel = (
        F.when(fmt == "json", F.col("_json.channel"))
        .when(fmt == "key_value", pair("channel"))
        .when(fmt == "free_text", _found(raw, r" via (\w+)"))
    )
    action = (
        F.when(fmt == "json", F.col("_json.action"))
        .when(fmt.isin("key_value", "piped"), pair("action"))
        .when(fmt == "bracketed", _found(raw, r" - (\w+) event "))
        .when(fmt == "free_text", worded)
    )
    return read.withColumn("_time", time_text).select(
        moment.alias("ts"),
        F.upper(level).alias("level"),
        campaign.alias("campaign_id"),
        customer.alias("customer_id"),
        channel.alias("channel"),
        action.alias("action"),
        F.when(fmt == "key_value", pair("status")).alias("status"),
        F.col("_json.message_id").alias("message_id"),
        fmt,
        raw,
    )


def _rate(part: str, whole: str) -> Column:
    share = F.round(F.try_divide(F.col(part) * 100, F.col(whole)), 2)
    return F.when(F.col(whole) > 0, share).otherwise(F.lit(0.0))


def campaign_rates(performance: DataFrame) -> DataFrame:
    """Bounce, open, click and conversion rate and return on cost, in percent."""
    bounced = performance.withColumn("_bounced", F.col("sent_count") - F.col("delivered_count"))
    gain = F.col("revenue") - F.col("cost")
    return bounced.withColumns(
        {
            "bounce_rate": _rate("_bounced", "sent_count"),
            "open_rate": _rate("opened_count", "delivered_count"),
            "click_rate": _rate("clicked_count", "opened_count"),
            "conversion_rate": _rate("converted_count", "clicked_count"),
            "roi": F.round(F.try_divide(gain * 100, F.col("cost")), 2),
        }
    ).drop("_bounced")


def campaign_totals(rates: DataFrame) -> DataFrame:
    return rates.agg(
        F.count(F.lit(1)).alias("campaigns"),
        F.sum("sent_count").alias("sent"),
        F.avg("open_rate").alias("avg_open_rate"),
        F.avg("conversion_rate").alias("avg_conversion_rate"),
    )
