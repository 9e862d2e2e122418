"""Queries over the other feeds: texts are derived from the tables, then parsed back."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemill.operators import quality
from lakemill.sources import campaigns, catalogue, clickstream, inventory, reviews
from workloads import derive, duck
from workloads.derive import money, pad, ymd
from workloads.shape import Checks, plain

# Fixed values in the texts below: names of elements and fields, and wordings of log lines, as the readers must find them.

CHECKS = Checks()
query = CHECKS.query


def quoted(name: str, value: str) -> str:
    return f"'\"{name}\": \"' || {value} || '\"'"


def bare(name: str, value: str) -> str:
    return f"'\"{name}\": ' || {value}"


def obj(*parts: str) -> str:
    return "'{' || " + " || ', ' || ".join(parts) + " || '}'"


CLOCK = f"{pad('hour(ts)', 2)} || ':' || {pad('minute(ts)', 2)} || ':' || {pad('second(ts)', 2)}"
TIME = f"{ymd('ts')} || ' ' || {CLOCK}"

# ---- clickstream -----------------------------------------------------------------------------

EVENTS = f"""
SELECT event_id AS id, user_id, event_type, ts, cast(round(value * 100) AS bigint) AS cents, {TIME} AS time_text,
    CASE event_id % 3 WHEN 0 THEN 'Mobile' WHEN 1 THEN 'DESKTOP' ELSE 'tablet' END AS device,
    CASE event_id % 4 WHEN 0 THEN 'Chrome' WHEN 1 THEN 'safari' ELSE 'Brave' END AS browser,
    CASE event_id % 6 WHEN 0 THEN 'true' WHEN 1 THEN 'false' WHEN 2 THEN '"true"' WHEN 3 THEN '"false"' WHEN 4 THEN '1' ELSE '0' END AS stock
FROM {{events}}"""

DEVICE = obj(quoted("type", "device"), quoted("browser", "browser"), quoted("os", "'Windows'"), "'\"screen_resolution\": null'")
LINES = f"""
SELECT {obj(
    quoted('event_id', "'ev-' || cast(id AS string)"),
    quoted('event_type', 'event_type'),
    quoted('timestamp', "CASE WHEN id % 50 = 0 THEN time_text ELSE replace(time_text, ' ', 'T') END"),
    quoted('session_id', f"'sess_' || {pad('id % 5000', 8)}"),
    bare('user_id', f"CASE WHEN id % 3 = 0 THEN 'null' ELSE '\"CUST' || {pad('user_id', 6)} || '\"' END"),
    "CASE WHEN id % 10 = 0 THEN " + quoted('device_type', 'device') + " || ', ' || " + quoted('browser', 'browser')
    + " ELSE '\"device\": ' || " + DEVICE + " END",
)} AS head,
    CASE WHEN id % 7 <> 0 THEN ', "location": ' || {obj(quoted('country', "'US'"), quoted('city', "'City ' || cast(user_id AS string)"))} ELSE '' END
    || CASE event_type
        WHEN 'view' THEN ', "product": ' || {obj(quoted('product_id', f"'PROD' || {pad('user_id', 6)}"), bare('price', money('cents')), bare('in_stock', 'stock'))}
        WHEN 'click' THEN ', "cart_action": ' || {obj(quoted('product_id', f"'PROD' || {pad('user_id', 6)}"), bare('quantity', "cast(1 + id % 5 AS string)"), bare('price', money('cents')))}
        WHEN 'signup' THEN ', "search_query": "laptop", "results_count": ' || cast(id % 500 AS string)
        WHEN 'purchase' THEN ', "order": ' || {obj(quoted('order_id', f"'ORD' || {pad('id', 8)}"), bare('total_amount', money('cents')), bare('items_count', "cast(1 + id % 10 AS string)"))}
        ELSE '' END AS tail
FROM events_base"""


def event_lines(spark, sf_dir):
    base = derive.run(spark, sf_dir, EVENTS)
    lines = spark.sql(LINES.replace("{", "{{").replace("}", "}}").replace("events_base", "{events_base}"), events_base=base)
    closed = F.concat(F.expr("substring(head, 1, length(head) - 1)"), F.col("tail"), F.lit("}"))
    return lines.select(closed.alias("value"))


@query("events_flat", duck.cte(e=derive.duck(EVENTS)) + f"""
SELECT 'ev-' || cast(id AS string) AS event_id, event_type, time_text AS event_time, 'sess_' || {pad('id % 5000', 8)} AS session_id,
    CASE WHEN id % 3 <> 0 THEN 'CUST' || {pad('user_id', 6)} END AS user_id, lower(device) AS device_type, lower(browser) AS browser,
    CASE WHEN id % 10 <> 0 THEN 'windows' END AS os, CASE WHEN id % 7 <> 0 THEN 'US' END AS country,
    CASE WHEN id % 7 <> 0 THEN 'City ' || cast(user_id AS string) END AS city,
    CASE WHEN event_type IN ('view', 'click') THEN 'PROD' || {pad('user_id', 6)} END AS product_id,
    CASE WHEN event_type IN ('view', 'click') THEN cast({money('cents')} AS double) END AS price,
    CASE WHEN event_type = 'view' THEN id % 6 IN (0, 2, 4) END AS in_stock,
    CASE WHEN event_type = 'click' THEN 1 + id % 5 END AS quantity,
    CASE WHEN event_type = 'signup' THEN 'laptop' END AS search_query, CASE WHEN event_type = 'signup' THEN id % 500 END AS results_count,
    CASE WHEN event_type = 'purchase' THEN 'ORD' || {pad('id', 8)} END AS order_id,
    CASE WHEN event_type = 'purchase' THEN cast({money('cents')} AS double) END AS order_total,
    CASE WHEN event_type = 'purchase' THEN 1 + id % 10 END AS order_items
FROM e""", optional=["in_stock", "order_items", "quantity", "results_count"])
def events_flat(spark, sf_dir):
    flat = clickstream.flatten_events(clickstream.parse_events(derive.landed(spark, sf_dir, "events", event_lines)))
    return plain(
        flat.select(
            "event_id", "event_type", "event_time", "session_id", "user_id", "device_type", "browser", "os", "country",
            "city", "product_id", "price", "in_stock", "quantity", "search_query", "results_count", "order_id",
            "order_total", "order_items",
        )
    )


def _detail_lines() -> str:
    place = obj(quoted("state", "'S' || cast(id % 50 AS string)"), quoted("ip_address", "'10.0.0.' || cast(id % 256 AS string)"))
    thing = obj(quoted("product_name", "'Part ' || cast(user_id AS string)"), quoted("category", "'Books'"), bare("price", money("cents")))
    page = obj(quoted("url", "'/p/' || cast(user_id AS string)"), quoted("referrer", "'ads'"), bare("load_time_ms", "cast(id % 3000 AS string)"))
    ad = obj(quoted("campaign_id", "'CAMP' || cast(id % 9 AS string)"), quoted("source", "'mail'"), quoted("medium", "'cpc'"))
    agent = obj(quoted("user_agent", "'Agent/' || cast(id % 5 AS string)"), quoted("ab_test_variant", "'B'"))
    line = obj(
        quoted("event_id", "'ev-' || cast(id AS string)"), "'\"location\": ' || " + place, "'\"product\": ' || " + thing,
        "'\"device\": ' || " + obj(quoted("screen_resolution", "'800x600'")), "'\"page\": ' || " + page,
        "'\"marketing\": ' || " + ad, "'\"metadata\": ' || " + agent,
    )
    return f"SELECT CASE WHEN id % 97 = 5 THEN 'broken ' || cast(id AS string) ELSE {line} END AS value FROM ({EVENTS}) e"


DETAIL_LINES = _detail_lines().replace("{", "{{").replace("}", "}}").replace("{{events}}", "{events}")
GOOD = "CASE WHEN id % 97 <> 5 THEN {} END"


@query("events_details", duck.cte(e=derive.duck(EVENTS)) + "SELECT " + ", ".join(
    f"{GOOD.format(value)} AS {name}" for name, value in {
        "event_id": "'ev-' || cast(id AS string)", "state": "'S' || cast(id % 50 AS string)",
        "ip_address": "'10.0.0.' || cast(id % 256 AS string)", "product_name": "'Part ' || cast(user_id AS string)",
        "category": "'Books'", "screen_resolution": "'800x600'", "page_url": "'/p/' || cast(user_id AS string)",
        "referrer": "'ads'", "load_time_ms": "id % 3000", "campaign_id": "'CAMP' || cast(id % 9 AS string)",
        "marketing_source": "'mail'", "marketing_medium": "'cpc'", "user_agent": "'Agent/' || cast(id % 5 AS string)",
        "ab_test_variant": "'B'", "price_cents": "cents",
    }.items()
) + ", CASE WHEN id % 97 = 5 THEN 'broken ' || cast(id AS string) END AS unreadable FROM e", optional=["load_time_ms", "price_cents"])
def events_details(spark, sf_dir):
    flat = clickstream.flatten_events(clickstream.parse_events(derive.landed(spark, sf_dir, "details", DETAIL_LINES)))
    return flat.select(
        "event_id", "state", "ip_address", "product_name", "category", "screen_resolution", "page_url", "referrer",
        "load_time_ms", "campaign_id", "marketing_source", "marketing_medium", "user_agent", "ab_test_variant",
        (F.col("price") * 100).cast("bigint").alias("price_cents"), F.col("_corrupt_record").alias("unreadable"),
    )


@query("events_by_type", "SELECT event_type, count(*) AS events FROM events GROUP BY event_type")
def events_by_type(spark, sf_dir):
    return clickstream.events_by_type(derive.load(spark, sf_dir, "events"))


# ---- campaign logs ---------------------------------------------------------------------------

CAMPAIGN_BASE = f"""
SELECT event_id AS id, user_id, ts, event_id % 6 AS layout, event_id % 1000 AS millis,
    'CAMP' || {pad('user_id % 50', 4)} AS campaign, 'CUST' || {pad('user_id', 6)} AS customer,
    CASE event_id % 4 WHEN 0 THEN 'INFO' WHEN 1 THEN 'debug' WHEN 2 THEN 'WARN' ELSE 'ERROR' END AS level,
    CASE event_id % 5 WHEN 0 THEN 'email' WHEN 1 THEN 'sms' WHEN 2 THEN 'push_notification' WHEN 3 THEN 'social_media' ELSE 'display_ad' END AS channel,
    CASE event_type WHEN 'click' THEN 'clicked' WHEN 'view' THEN 'opened' WHEN 'signup' THEN 'sent' WHEN 'error' THEN 'bounced' ELSE 'converted' END AS action,
    {TIME} AS time_text, user_id % 7 AS wording
FROM {{events}}"""
JSON_LINE = obj(
    quoted("timestamp", "replace(time_text, ' ', 'T')"), quoted("level", "level"), quoted("campaign_id", "campaign"),
    quoted("customer_id", "customer"), quoted("channel", "channel"), quoted("action", "action"),
    quoted("message_id", "'MSG' || cast(id AS string)"), "'\"metadata\": ' || " + obj(quoted("device", "'mobile'")),
)
LOG_LINES = f"""
SELECT CASE layout
    WHEN 0 THEN {JSON_LINE}
    WHEN 1 THEN time_text || ' [' || level || '] campaign=' || campaign || ' customer=' || customer || ' channel=' || channel
        || ' action=' || action || ' status=' || CASE WHEN id % 11 = 0 THEN 'failure' ELSE 'success' END
    WHEN 2 THEN replace(time_text, ' ', 'T') || ' | LEVEL=' || level || ' | CAMPAIGN=' || campaign || ' | ACTION=' || action
        || ' | CUSTOMER=' || customer
    WHEN 3 THEN '[' || replace(substr(time_text, 1, 10), '-', '') || substr(time_text, 11, 9) || '.' || {pad('millis', 3)} || '] ' || level
        || ': Campaign ' || campaign || ' - ' || action || ' event for customer ' || customer
    WHEN 4 THEN substr(time_text, 9, 2) || '/' || substr('JanFebMarAprMayJunJulAugSepOctNovDec', cast(month(ts) * 3 - 2 AS int), 3) || '/'
        || substr(time_text, 1, 4) || ':' || substr(time_text, 12, 8) || ' ' || CASE wording
            WHEN 0 THEN 'Email campaign ' || campaign || ' sent to customer ' || customer
            WHEN 1 THEN 'Customer clicked link in campaign ' || campaign
            WHEN 2 THEN 'SMS delivered successfully via ' || channel
            WHEN 3 THEN 'Push notification bounced for user ' || customer
            WHEN 4 THEN 'Customer unsubscribed from campaign ' || campaign
            WHEN 5 THEN 'ERROR: Failed to send email - SMTP timeout'
            ELSE 'Campaign ' || campaign || ' conversion recorded' END
    ELSE 'restart of node ' || cast(id AS string) END AS value
FROM log_base"""


def log_lines(spark, sf_dir):
    base = derive.run(spark, sf_dir, CAMPAIGN_BASE)
    return spark.sql(LOG_LINES.replace("{", "{{").replace("}", "}}").replace("log_base", "{log_base}"), log_base=base)


@query("campaign_logs", duck.cte(b=derive.duck(CAMPAIGN_BASE)) + """
SELECT CASE WHEN layout < 5 THEN time_text END AS ts,
    CASE WHEN layout < 4 THEN upper(level) WHEN layout = 4 AND wording = 5 THEN 'ERROR' END AS level,
    CASE WHEN layout < 4 THEN campaign WHEN layout = 4 AND wording IN (0, 1, 4, 6) THEN campaign END AS campaign_id,
    CASE WHEN layout < 4 THEN customer WHEN layout = 4 AND wording IN (0, 3) THEN customer END AS customer_id,
    CASE WHEN layout < 2 THEN channel WHEN layout = 4 AND wording = 2 THEN channel END AS channel,
    CASE WHEN layout < 4 THEN action WHEN layout = 4 THEN
        ['sent', 'clicked', 'delivered', 'bounced', 'unsubscribed', 'failed', 'converted'][wording + 1] END AS action,
    CASE WHEN layout = 1 THEN CASE WHEN id % 11 = 0 THEN 'failure' ELSE 'success' END END AS status,
    CASE WHEN layout = 0 THEN 'MSG' || cast(id AS string) END AS message_id,
    ['json', 'key_value', 'piped', 'bracketed', 'free_text', 'unparsed'][layout + 1] AS format
FROM b""")
def campaign_logs(spark, sf_dir):
    return plain(campaigns.parse_log(derive.landed(spark, sf_dir, "log", log_lines)).drop("raw"))


PERFORMANCE = f"""
SELECT 'CAMP' || {pad('user_id', 6)} AS campaign_id, count(*) * 100 AS sent_count,
    sum(100 - event_id % 13) AS delivered_count, sum(20 + event_id % 17) AS opened_count,
    sum(event_id % 19) AS clicked_count, sum(CASE WHEN event_type = 'purchase' THEN event_id % 5 ELSE 0 END) AS converted_count,
    sum(CASE WHEN event_type = 'purchase' THEN cast(round(value * 100) AS bigint) ELSE 0 END) AS revenue_cents, count(*) * 37 AS cost_cents
FROM {{events}} GROUP BY user_id"""


def _performance(spark, sf_dir):
    rows = derive.run(spark, sf_dir, PERFORMANCE)
    dollars = {
        name: (F.col(f"{name}_cents") / 100).cast("decimal(14,2)") for name in ("revenue", "cost")
    }
    return rows.withColumns(dollars)


def _percent(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN {duck.ratio(f'(100 * cast({part} AS hugeint))', f'cast({whole} AS hugeint)')} ELSE 0.0 END"


RATES = f"""SELECT campaign_id, sent_count, {_percent('(sent_count - delivered_count)', 'sent_count')} AS bounce_rate,
        {_percent('opened_count', 'delivered_count')} AS open_rate, {_percent('clicked_count', 'opened_count')} AS click_rate,
        {_percent('converted_count', 'clicked_count')} AS conversion_rate,
        CASE WHEN revenue_cents >= cost_cents THEN 1 ELSE -1 END
            * {duck.ratio('(100 * cast(abs(revenue_cents - cost_cents) AS hugeint))', 'cast(cost_cents AS hugeint)')} AS roi
    FROM p"""


@query("campaign_metrics", duck.cte(p=derive.duck(PERFORMANCE), r=RATES) + """
SELECT campaign_id, bounce_rate, open_rate, click_rate, conversion_rate, roi FROM r""")
def campaign_metrics(spark, sf_dir):
    rates = campaigns.campaign_rates(_performance(spark, sf_dir))
    return plain(rates.select("campaign_id", "bounce_rate", "open_rate", "click_rate", "conversion_rate", "roi"))


@query("campaign_totals", duck.cte(p=derive.duck(PERFORMANCE), r=RATES) + """
SELECT count(*) AS campaigns, cast(sum(sent_count) AS bigint) AS sent, round(avg(open_rate), 6) AS avg_open_rate,
    round(avg(conversion_rate), 6) AS avg_conversion_rate FROM r""")
def campaign_totals(spark, sf_dir):
    totals = campaigns.campaign_totals(campaigns.campaign_rates(_performance(spark, sf_dir)))
    return totals.select(
        "campaigns", "sent", F.round("avg_open_rate", 6).alias("avg_open_rate"),
        F.round("avg_conversion_rate", 6).alias("avg_conversion_rate"),
    )


# ---- product catalogue -----------------------------------------------------------------------

PARTS = f"""
SELECT p_partkey AS k, 'PROD' || {pad('p_partkey', 6)} AS id, p_name AS name, p_brand AS brand, p_type AS kind, p_size AS size,
    cast(round(p_retailprice * 100) AS bigint) AS cents, 2019 + p_partkey % 6 AS y, 1 + p_partkey % 12 AS m, 1 + p_partkey % 28 AS d
FROM {{part}}"""
DAY = f"{pad('y', 4)} || '-' || {pad('m', 2)} || '-' || {pad('d', 2)}"


def tag(name: str, body: str, attributes: str = "''") -> str:
    return f"'<{name}' || {attributes} || '>' || {body} || '</{name}>'"


PRODUCTS = f"""
SELECT '<Product ' || CASE WHEN k % 20 = 0 THEN 'product_id' ELSE 'id' END || '="' || id || '" status="'
    || CASE k % 4 WHEN 0 THEN 'active' WHEN 1 THEN 'Active' WHEN 2 THEN 'DISCONTINUED' ELSE '' END || '">'
    || {tag('SKU', "'SKU-' || cast(10000 + k AS string)")}
    || {tag('Title', "name || CASE WHEN k % 5 = 0 THEN ' &amp; &lt;more&gt;' ELSE '' END")}
    || {tag('Description', "CASE WHEN k % 2 = 0 THEN '<![CDATA[A <b>' || name || '</b>]]>' ELSE 'A ' || name END")}
    || CASE WHEN k % 5 = 1 THEN {tag('Category', 'kind')} ELSE {tag('Category', tag('MainCategory', 'kind') + ' || ' + tag('SubCategory', 'brand'))} END
    || CASE WHEN k % 10 = 3 THEN '' ELSE {tag('Brand', "CASE WHEN k % 9 = 2 THEN '' ELSE brand END")} END
    || {tag('Pricing', tag('ListPrice', "CASE WHEN k % 50 = 7 THEN '' ELSE " + money('cents') + " END") + ' || '
            + tag('SalePrice', "CASE WHEN k % 100 = 9 THEN '-10.50' ELSE " + money('cents - 100') + " END"),
            "' currency=\"' || CASE k % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'usd' WHEN 2 THEN '$' ELSE 'EUR' END || '\"'")}
    || {tag('Inventory', tag('StockQuantity', "cast(size * 7 AS string)", "' warehouse=\"WH' || " + pad('1 + k % 10', 3) + " || '\"'") + ' || '
            + tag('Availability', "CASE k % 4 WHEN 0 THEN 'in_stock' WHEN 1 THEN 'In Stock' WHEN 2 THEN 'BACKORDERED' ELSE '' END"))}
    || CASE WHEN k % 3 = 0 THEN '' ELSE {tag('Attributes', tag('Attribute', 'brand', "' name=\"Color\"'") + " || CASE WHEN k % 3 = 1 THEN "
            + tag('Attribute', 'kind', "' name=\"SIZE\"'") + " ELSE '' END")} END
    || CASE WHEN k % 4 = 0 THEN '' ELSE {tag('Images', tag('Image', "'https://img/' || cast(k AS string) || '_0.jpg'", "' type=\"primary\"'")
            + ' || ' + tag('Image', "'https://img/' || cast(k AS string) || '_1.jpg'", "' type=\"alternate\"'"))} END
    || CASE WHEN k % 5 = 4 THEN '' ELSE {tag('Reviews', tag('AverageRating', "cast(1 + k % 4 AS string) || '.5'") + ' || ' + tag('ReviewCount', 'cast(k % 500 AS string)'))} END
    || {tag('Shipping', tag('Weight', "cast(size AS string) || '.25'", "' unit=\"' || CASE k % 4 WHEN 0 THEN 'kg' WHEN 1 THEN 'LB' WHEN 2 THEN 'lbs' ELSE '' END || '\"'")
            + ' || ' + tag('Dimensions', "cast(size AS string) || 'x' || cast(size + 1 AS string) || 'x' || cast(size + 2 AS string)",
                           "' unit=\"' || CASE k % 3 WHEN 0 THEN 'CM' WHEN 1 THEN 'inches' ELSE 'in' END || '\"'"))}
    || {tag('Dates', tag('Created', f"CASE k % 3 WHEN 0 THEN {DAY} WHEN 1 THEN {pad('m', 2)} || '/' || {pad('d', 2)} || '/' || {pad('y', 4)} ELSE {DAY} || 'T08:09:10' END")
            + ' || ' + tag('LastUpdated', f"{DAY} || 'T12:30:00'"))}
    || '</Product>' AS value
FROM {{parts}}"""


def product_elements(spark, sf_dir):
    return spark.sql(PRODUCTS, parts=derive.run(spark, sf_dir, PARTS))


def parsed_catalogue(spark, sf_dir):
    return catalogue.parse_products(derive.landed(spark, sf_dir, "catalogue", product_elements))


@query("catalogue_products", duck.cte(p=derive.duck(PARTS)) + f"""
SELECT id AS product_id, CASE k % 4 WHEN 0 THEN 'active' WHEN 1 THEN 'active' WHEN 2 THEN 'discontinued' END AS status,
    'SKU-' || cast(10000 + k AS string) AS sku, name || CASE WHEN k % 5 = 0 THEN ' & <more>' ELSE '' END AS title,
    CASE WHEN k % 2 = 0 THEN 'A <b>' || name || '</b>' ELSE 'A ' || name END AS description,
    kind AS main_category, CASE WHEN k % 5 <> 1 THEN brand END AS sub_category,
    CASE WHEN k % 10 <> 3 AND k % 9 <> 2 THEN brand END AS brand, CASE WHEN k % 4 = 3 THEN 'EUR' ELSE 'USD' END AS currency,
    CASE WHEN k % 50 <> 7 THEN cents / 100 END AS list_price, CASE WHEN k % 100 <> 9 THEN (cents - 100) / 100 END AS sale_price,
    size * 7 AS stock_quantity, 'WH' || {pad('1 + k % 10', 3)} AS warehouse,
    CASE k % 4 WHEN 0 THEN 'in_stock' WHEN 1 THEN 'in_stock' WHEN 2 THEN 'backordered' END AS availability,
    CASE WHEN k % 5 <> 4 THEN 1 + k % 4 + 0.5::double END AS average_rating, CASE WHEN k % 5 <> 4 THEN k % 500 END AS review_count,
    size + 0.25::double AS weight, CASE k % 4 WHEN 0 THEN 'kg' WHEN 1 THEN 'lb' WHEN 2 THEN 'lb' END AS weight_unit,
    size AS length, size + 1 AS width, size + 2 AS height, CASE WHEN k % 3 = 0 THEN 'cm' ELSE 'in' END AS dimension_unit,
    {DAY} AS created_on, {DAY} || ' 12:30:00' AS updated_at
FROM p""", optional=["height", "length", "review_count", "stock_quantity", "width"])
def catalogue_products(spark, sf_dir):
    return plain(catalogue.products(parsed_catalogue(spark, sf_dir)))


@query("catalogue_attributes", duck.cte(p=derive.duck(PARTS)) + """
SELECT id AS product_id, 0 AS position, 'color' AS name, brand AS value FROM p WHERE k % 3 <> 0
UNION ALL SELECT id, 1, 'size', kind FROM p WHERE k % 3 = 1""")
def catalogue_attributes(spark, sf_dir):
    return plain(catalogue.attributes(parsed_catalogue(spark, sf_dir)))


@query("catalogue_images", duck.cte(p=derive.duck(PARTS)) + """
SELECT id AS product_id, n AS position, CASE n WHEN 0 THEN 'primary' ELSE 'alternate' END AS type,
    'https://img/' || cast(k AS string) || '_' || cast(n AS string) || '.jpg' AS url
FROM p JOIN (SELECT 0 AS n UNION ALL SELECT 1) ON k % 4 <> 0""")
def catalogue_images(spark, sf_dir):
    return plain(catalogue.images(parsed_catalogue(spark, sf_dir)))


# ---- reviews ---------------------------------------------------------------------------------

REVIEWS = """
SELECT doc_id AS k, 'REV' || cast(CASE WHEN doc_id % 97 = 1 THEN doc_id - 1 ELSE doc_id END AS string) AS review_id,
    'PROD' || cast(doc_id % 500 AS string) AS product_id,
    CASE doc_id % 9 WHEN 0 THEN '5' WHEN 1 THEN '4.0' WHEN 2 THEN '1' WHEN 3 THEN '0' WHEN 4 THEN '6' WHEN 5 THEN '' WHEN 6 THEN NULL
        WHEN 7 THEN '3' ELSE '5' END AS rating,
    CASE doc_id % 8 WHEN 0 THEN 'True' WHEN 1 THEN 'false' WHEN 2 THEN '1' WHEN 3 THEN 'N' WHEN 4 THEN 'Yes' WHEN 5 THEN '' WHEN 6 THEN NULL
        ELSE 'sure' END AS verified_purchase,
    CASE WHEN doc_id % 10 = 0 THEN NULL ELSE cast(doc_id % 100 AS string) || '.0' END AS helpful_votes,
    CASE WHEN doc_id % 10 = 0 THEN NULL ELSE cast(doc_id % 100 + 5 AS string) END AS total_votes,
    CASE WHEN doc_id % 50 = 3 THEN 'Click here for amazing deals!!! ' ELSE '' END || text
        || CASE WHEN doc_id % 40 = 7 THEN ' <script>alert(1)</script>' WHEN doc_id % 40 = 9 THEN '; DROP TABLE reviews;--' ELSE '' END AS review_text,
    CASE doc_id % 4 WHEN 0 THEN 'Published' WHEN 1 THEN 'pending' WHEN 2 THEN '' ELSE NULL END AS review_status
FROM {documents}"""
RATING = "CASE k % 9 WHEN 0 THEN 5 WHEN 1 THEN 4 WHEN 2 THEN 1 WHEN 3 THEN 0 WHEN 4 THEN 6 WHEN 7 THEN 3 WHEN 8 THEN 5 END"
VERIFIED = "CASE k % 8 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true WHEN 3 THEN false WHEN 4 THEN true END"


def _reviews(spark, sf_dir):
    return derive.landed(spark, sf_dir, "reviews", REVIEWS)


@query("reviews_clean", duck.cte(r=derive.duck(REVIEWS)) + f"""
SELECT k, review_id, {RATING} AS rating, {VERIFIED} AS verified_purchase, CASE WHEN k % 10 <> 0 THEN k % 100 END AS helpful_votes,
    CASE WHEN k % 10 <> 0 THEN k % 100 + 5 END AS total_votes, length(review_text) AS review_length,
    CASE k % 4 WHEN 0 THEN 'published' WHEN 1 THEN 'pending' END AS review_status
FROM r""", optional=["helpful_votes", "rating", "total_votes", "verified_purchase"])
def reviews_clean(spark, sf_dir):
    return plain(reviews.clean_reviews(_reviews(spark, sf_dir)).drop("review_text", "product_id"))


@query("review_flags", duck.cte(r=derive.duck(REVIEWS), x=f"SELECT *, {RATING} AS stars FROM r") + """
SELECT k, 'RATING_OUT_OF_RANGE:rating' AS code, 'ERROR' AS severity FROM x WHERE stars NOT BETWEEN 1 AND 5
UNION ALL SELECT k, 'SUSPECTED_SPAM:review_text', 'WARNING' FROM x
    WHERE regexp_matches(review_text, '(click here|buy now|free gift|hot deal|www\\.)', 'i')
UNION ALL SELECT k, 'MARKUP_IN_TEXT:review_text', 'WARNING' FROM x
    WHERE regexp_matches(review_text, '(<\\s*script|drop\\s+table)', 'i')""")
def review_flags(spark, sf_dir):
    cleaned = reviews.clean_reviews(_reviews(spark, sf_dir))
    return quality.explode_codes(quality.apply_rules(cleaned, reviews.review_rules()), "k")


@query("repeated_reviews", duck.cte(r=derive.duck(REVIEWS)) + """
SELECT review_id, count(*) AS copies FROM r GROUP BY review_id HAVING count(*) > 1""")
def repeated_reviews(spark, sf_dir):
    return reviews.repeated_reviews(_reviews(spark, sf_dir))


@query("rating_distribution", duck.cte(r=derive.duck(REVIEWS)) + f"""
SELECT 'rating' AS field, cast({RATING} AS string) AS value, count(*) AS reviews FROM r WHERE {RATING} IS NOT NULL GROUP BY ALL
UNION ALL
SELECT 'verified_purchase', cast({VERIFIED} AS string), count(*) FROM r WHERE {VERIFIED} IS NOT NULL GROUP BY ALL""")
def rating_distribution(spark, sf_dir):
    cleaned = reviews.clean_reviews(_reviews(spark, sf_dir))
    parts = [
        reviews.distribution(cleaned, c).select(F.lit(c).alias("field"), F.col(c).cast("string").alias("value"), "reviews")
        for c in ("rating", "verified_purchase")
    ]
    return parts[0].unionByName(parts[1])


# ---- inventory -------------------------------------------------------------------------------

STOCK = f"""
SELECT l_orderkey AS k, l_linenumber AS n, l_partkey AS part, l_suppkey AS warehouse, l_extendedprice AS price,
    cast(cast(l_quantity AS int) * 20 AS string) AS current_stock, cast(l_linenumber AS string) AS reserved_stock,
    {money('cast(round(l_extendedprice * 100) AS bigint) % 20000')} AS unit_cost,
    CASE WHEN l_partkey % 50 = 1 THEN '#DIV/0!' ELSE {money('cast(round(l_extendedprice * 100) AS bigint)')} END AS total_value
FROM {{lineitem}}"""
COST = "cast(unit_cost AS decimal(12,2))"


def _stock(spark, sf_dir):
    return derive.landed(spark, sf_dir, "stock", STOCK)


@query("inventory_values", duck.cte(s=derive.duck(STOCK)) + f"""
SELECT k, n, part, price, cast(current_stock AS bigint) - cast(reserved_stock AS bigint) AS available_stock,
    cast(cast(current_stock AS bigint) * {COST} AS double) AS computed_value FROM s""")
def inventory_values(spark, sf_dir):
    valued = inventory.stock_values(_stock(spark, sf_dir))
    return plain(valued.select("k", "n", "part", "price", "available_stock", "computed_value"))


SIZES = """
SELECT p_partkey AS k, cast(p_size AS decimal(10,2)) + cast(0.25 AS decimal(10,2)) AS length,
    cast(p_size + p_partkey % 7 AS decimal(10,2)) AS width, cast(p_retailprice AS decimal(10,2)) AS height
FROM {part}"""


def _sizes(spark, sf_dir):
    return derive.run(spark, sf_dir, SIZES)


@query("volumetric_weights", duck.cte(d=derive.duck(SIZES)) + f"""
SELECT k, cast((2 * {duck.cents('length')} * {duck.cents('width')} * {duck.cents('height')} + 1660000) // 3320000 AS double) / 100
    AS volumetric_weight FROM d""")
def volumetric_weights(spark, sf_dir):
    return plain(inventory.volumetric_weight(_sizes(spark, sf_dir)).select("k", "volumetric_weight"))


@query("inventory_summary", duck.cte(s=derive.duck(STOCK)) + """
SELECT 'total_products' AS metric, cast(count(*) AS double) AS value FROM part
UNION ALL SELECT 'total_warehouses', count(*) FROM supplier
UNION ALL SELECT 'total_inventory_value', cast(sum(CASE WHEN total_value <> '#DIV/0!' THEN cast(total_value AS decimal(20,2)) ELSE 0 END) AS double)
FROM s""")
def inventory_summary(spark, sf_dir):
    warehouses = derive.load(spark, sf_dir, "supplier")
    return plain(inventory.sheet_summary(_stock(spark, sf_dir), warehouses, _sizes(spark, sf_dir)))


# Events whose numbers come as numbers, in quotes, with a sign, in arrays, and as words; some lines are no JSON.
MIXED = f"""SELECT event_id AS id, event_type, {money("cast(round(value * 100) AS bigint)")} AS amount, 1 + event_id % 9 AS count FROM {{events}}"""
MIXED_LINES = """SELECT CASE WHEN id % 31 = 5 THEN '{"event_id": "ev-' || cast(id AS string) ELSE
    '{"event_id": "ev-' || cast(id AS string) || '", "event_type": "' || event_type || '", "order": {"total_amount": ' ||
    CASE id % 6 WHEN 0 THEN amount WHEN 1 THEN '"' || amount || '"' WHEN 2 THEN '"$ ' || amount || '"' WHEN 3 THEN '[' || amount || ']'
        WHEN 4 THEN '[' || amount || ', 1]' ELSE '"free"' END ||
    ', "items_count": ' || CASE id % 4 WHEN 0 THEN cast(count AS string) WHEN 1 THEN '"' || cast(count AS string) || '"'
        WHEN 2 THEN '["' || cast(count AS string) || '"]' ELSE 'null' END || '}}' END AS value FROM e"""


@query("events_mixed", duck.cte(e=derive.duck(MIXED)) + """
SELECT CASE WHEN id % 31 <> 5 THEN 'ev-' || cast(id AS string) END AS event_id,
    CASE WHEN id % 31 <> 5 AND id % 6 < 4 THEN cast(cast(amount AS decimal(12,2)) AS varchar) END AS order_total,
    cast(CASE WHEN id % 31 <> 5 AND id % 4 < 3 THEN count END AS double) AS order_items,
    CASE WHEN id % 31 = 5 THEN '' ELSE array_to_string(list_filter([
        CASE id % 6 WHEN 0 THEN NULL WHEN 1 THEN 'order_total:STRING' WHEN 2 THEN 'order_total:STRING' WHEN 5 THEN 'order_total:STRING' ELSE 'order_total:ARRAY' END,
        CASE id % 4 WHEN 1 THEN 'order_items:STRING' WHEN 2 THEN 'order_items:ARRAY' END], lambda x: x IS NOT NULL), ',') END AS mixed_types,
    CASE WHEN id % 31 = 5 THEN NULL WHEN id % 6 = 5 THEN '"free"' WHEN id % 6 = 4 THEN '[' || rtrim(rtrim(amount, '0'), '.') || ',1]' END AS unread_total,
    id % 31 = 5 AS corrupt
FROM e""")
def events_mixed(spark, sf_dir):
    lines = derive.landed(spark, sf_dir, "mixed", lambda s, d: s.sql(
        MIXED_LINES.replace("{", "{{").replace("}", "}}").replace("FROM e", "FROM {e}"), e=derive.run(s, d, MIXED, spread=True)))
    events = clickstream.parse_mixed(lines)
    return events.select(
        "event_id", F.col("order_total").cast("string").alias("order_total"), F.col("order_items").cast("double").alias("order_items"),
        F.array_join("mixed_types", ",").alias("mixed_types"), F.col("unread")["order_total"].alias("unread_total"),
        F.col("_corrupt_record").isNotNull().alias("corrupt"),
    )
