"""Order item queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.contracts import ORDER_ITEMS as CONTRACT
from lakemill.functions import numbers, text
from lakemill.operators import filters, quality, standardize
from lakemill.operators.dedup import distinct_rows, newest_per_key
from lakemill.operators.enrich import enrich_items
from lakemill.operators.line_numbers import number_lines
from lakemill.operators.order_metrics import add_order_metrics
from lakemill.operators.references import flag_reference, orphans
from lakemill.operators.skew import hot_keys
from lakemill.plans.silver import ITEM_COLUMNS, silver_items
from workloads import derive, duck
from workloads.shape import AS_OF, Checks, plain

CHECKS = Checks()
query = CHECKS.query
BASE = derive.duck(derive.ITEMS)


def messy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.landed(spark, sf_dir, "items", derive.ITEMS)


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messy items with quality flags; the ship day is the ingestion time, its year the batch."""
    rows = messy(spark, sf_dir).select(*CONTRACT.columns, "k", "line_no", "ingested", "batch_no")
    return quality.validate(rows, CONTRACT.rules(AS_OF)).withColumns(
        {
            "_bronze_ingestion_timestamp": F.col("ingested").cast("timestamp"),
            "_bronze_ingestion_batch_id": F.concat(F.lit("batch-"), "batch_no"),
            "_bronze_source_line_number": F.col("line_no"),
        }
    )


def landed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that are not pending: the parent table of the reference checks."""
    landed = derive.load(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != "P")
    key = F.lpad(F.col("o_orderkey").cast("string"), 12, "0")
    return landed.select(F.concat(F.lit("ORD"), key).alias("order_id"))


LANDED = "SELECT DISTINCT 'ORD' || lpad(cast(o_orderkey AS string), 12, '0') AS order_id FROM orders WHERE o_orderstatus <> 'P'"
CATEGORY = """CASE WHEN lower(trim(category)) IN ('electronics', 'electronic', 'tech') THEN 'electronics'
    WHEN lower(trim(category)) IN ('clothing', 'clothes', 'apparel') THEN 'clothing'
    WHEN lower(trim(category)) IN ('home & garden', 'home', 'garden') THEN 'home_garden'
    WHEN lower(trim(category)) IN ('books', 'book') THEN 'books'
    WHEN lower(trim(category)) IN ('sports', 'sport', 'fitness') THEN 'sports'
    WHEN lower(trim(category)) IN ('toys', 'toy') THEN 'toys'
    WHEN category IS NULL THEN 'uncategorized' ELSE lower(trim(category)) END"""


@query("product_standard", duck.cte(i=BASE) + f"""
SELECT k, line_no, lower(trim(product_name)) AS product_name, {duck.initcap(CATEGORY)} AS category, {CATEGORY} AS category_plain,
    {duck.initcap('category')} AS category_title, upper(trim(sku)) AS sku
FROM i""")
def product_standard(spark, sf_dir):
    category = F.col("category")
    return messy(spark, sf_dir).select(
        "k", "line_no",
        text.folded(F.col("product_name")).alias("product_name"),
        text.category(category).alias("category"),
        text.category(category, title=False).alias("category_plain"),
        text.category_title(category).alias("category_title"),
        F.upper(F.trim("sku")).alias("sku"),
    )


QUANTITY = "greatest(coalesce(cast(try_cast(quantity AS decimal(10,0)) AS int), 1), 1)"


def _absolute(x: str, scale: int) -> str:
    return f"CASE WHEN {duck.blank(x)} THEN 0 ELSE abs(try_cast({duck.readable(x)} AS decimal(10,{scale}))) END"


@query("numeric_policies", duck.cte(i=BASE, n=f"""
    SELECT k, line_no, {QUANTITY} AS quantity, {duck.amount('unit_price')} AS unit_price, {duck.amount('line_total', 12)} AS line_total,
        {_absolute('quantity', 0)} AS quantity_abs, {_absolute('unit_price', 2)} AS price_abs, try_cast(line_total AS decimal(10,2)) AS stated
    FROM i""") + """
SELECT k, line_no, quantity, cast(unit_price AS double) AS unit_price, cast(line_total AS double) AS line_total,
    cast(CASE WHEN abs(line_total - quantity * unit_price) > 0.01 THEN quantity * unit_price ELSE line_total END AS double) AS line_total_repaired,
    cast(quantity_abs AS double) AS quantity_abs, cast(price_abs AS double) AS price_abs,
    cast(CASE WHEN price_abs * quantity_abs <> stated THEN price_abs * quantity_abs ELSE stated END AS double) AS line_total_exact
FROM n""")
def numeric_policies(spark, sf_dir):
    rows = messy(spark, sf_dir).select("k", "line_no", "quantity", "unit_price", "line_total")
    absolute = standardize.absolute_items(
        rows.withColumns({"category": F.lit(None).cast("string"), "kept": F.struct("quantity", "unit_price", "line_total")})
    )
    quantity, price, total = (
        numbers.quantity(F.col("kept.quantity")), numbers.amount(F.col("kept.unit_price")), numbers.amount(F.col("kept.line_total"), 12)
    )
    return plain(
        absolute.select(
            "k", "line_no", quantity.alias("quantity"), price.alias("unit_price"), total.alias("line_total"),
            numbers.reconcile(total, quantity * price).alias("line_total_repaired"),
            F.col("quantity").alias("quantity_abs"), F.col("unit_price").alias("price_abs"),
            F.col("line_total").alias("line_total_exact"),
        )
    )


@query("dq_items", duck.cte(i=BASE) + duck.rules("i", "k, line_no", duck.ITEM_CHECKS))
def dq_items(spark, sf_dir):
    flagged = quality.apply_rules(messy(spark, sf_dir), CONTRACT.rules(AS_OF)).withColumn("id", F.struct("k", "line_no"))
    return quality.explode_codes(flagged, "id").select("id.*", "code", "severity")


IDS = " AND ".join(f"NOT {duck.blank(c)}" for c in filters.ITEM_IDS)
VALID = f"{IDS} AND {duck.error_count(duck.ITEM_CHECKS)} = 0"


@query("valid_items", duck.cte(i=BASE) + f"""
SELECT k, line_no, item_id, {duck.error_count(duck.ITEM_CHECKS)} = 0 AS no_errors FROM i WHERE {IDS}""")
def valid_items(spark, sf_dir):
    rows = bronze(spark, sf_dir)
    filled = filters.drop_blank_ids(rows, filters.ITEM_IDS)
    accepted = filters.acceptable(filters.ITEM_IDS).alias("no_errors")
    return filled.select("k", "line_no", "item_id", accepted)


NEWEST = "row_number() OVER (PARTITION BY item_id ORDER BY ingested DESC, batch_no DESC, line_no DESC) = 1"


@query("dedup_items", duck.cte(i=BASE) + f"SELECT item_id, k, line_no FROM i QUALIFY {NEWEST}")
def dedup_items(spark, sf_dir):
    ties = [F.col("batch_no").desc(), F.col("line_no").desc()]
    return newest_per_key(messy(spark, sf_dir), "item_id", "ingested", ties).select("item_id", "k", "line_no")


@query("dedup_whole_row", duck.cte(i=BASE) + "SELECT DISTINCT product_id, product_name, category, sku FROM i")
def dedup_whole_row(spark, sf_dir):
    return distinct_rows(messy(spark, sf_dir).select("product_id", "product_name", "category", "sku"))


def _unique(spark, sf_dir) -> DataFrame:
    return messy(spark, sf_dir).select("k", "line_no", "item_id", "order_id")


@query("orphan_items", duck.cte(i=BASE, o=LANDED) + """
SELECT k, line_no, item_id FROM i WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.order_id = i.order_id)""")
def orphan_items(spark, sf_dir):
    rows = _unique(spark, sf_dir)
    hot = hot_keys(rows, "order_id")
    return orphans(rows, landed_orders(spark, sf_dir), "order_id", salt_by="line_no", hot=hot).select("k", "line_no", "item_id")


@query("order_reference_flag", duck.cte(i=BASE, o=LANDED) + """
SELECT k, line_no, o.order_id IS NOT NULL AS has_valid_order FROM i LEFT JOIN o ON o.order_id = i.order_id""")
def order_reference_flag(spark, sf_dir):
    rows = _unique(spark, sf_dir)
    hot = hot_keys(rows, "order_id")
    flagged = flag_reference(
        rows, landed_orders(spark, sf_dir), "order_id", "has_valid_order", salt_by="line_no", hot=hot
    )
    return flagged.select("k", "line_no", "has_valid_order")


TYPED = f"""SELECT k, line_no, item_id, order_id, product_id, upper(trim(sku)) AS sku_cleaned, lower(trim(product_name)) AS product_name,
        {duck.initcap(CATEGORY)} AS category, {QUANTITY} AS quantity, {duck.amount('unit_price')} AS unit_price,
        {duck.amount('line_total', 12)} AS stated FROM v"""
FIXED = """SELECT *, CASE WHEN abs(stated - quantity * unit_price) > 0.01 THEN quantity * unit_price ELSE stated END AS line_total FROM t"""
ENRICHED = f"""cast(line_total AS double) AS extended_price,
    {duck.ratio(duck.cents('line_total'), '(100 * quantity)')} AS avg_price_per_item,
    CASE WHEN line_total >= 100 THEN 'high_value' WHEN line_total >= 25 THEN 'medium_value' ELSE 'low_value' END AS item_value_category,
    CASE WHEN quantity >= 5 THEN 'bulk' WHEN quantity >= 2 THEN 'multiple' ELSE 'single' END AS quantity_category,
    CASE WHEN unit_price >= 100 THEN 'premium' WHEN unit_price >= 25 THEN 'mid_range' ELSE 'budget' END AS price_category,
    quantity >= 3 AS is_high_quantity"""
MEASURED = f"""SELECT *, count(item_id) OVER (PARTITION BY order_id) AS order_item_count,
        sum(line_total) OVER (PARTITION BY order_id) AS order_total,
        row_number() OVER (PARTITION BY order_id ORDER BY line_total DESC, item_id) AS item_rank_in_order FROM f"""
METRICS = f"""order_item_count, cast(order_total AS double) AS order_total_items_value,
    CASE WHEN order_total > 0 THEN {duck.ratio(f"(100 * {duck.cents('line_total')})", duck.cents('order_total'))} ELSE 0.0 END AS item_pct_of_order,
    item_rank_in_order, item_rank_in_order = 1 AS is_highest_value_item"""


@query("items_enriched", duck.cte(i=BASE, v="SELECT * FROM i", t=TYPED, f=FIXED) + f"SELECT k, line_no, {ENRICHED} FROM f")
def items_enriched(spark, sf_dir):
    typed = standardize.repair_line_total(standardize.standardize_items(messy(spark, sf_dir)))
    return plain(
        enrich_items(typed).select(
            "k", "line_no", "extended_price", "avg_price_per_item", "item_value_category",
            "quantity_category", "price_category", "is_high_quantity",
        )
    )


CLEAN_ITEMS = """SELECT 'ITM' || cast(l_orderkey AS string) || '-' || cast(l_linenumber AS string) || '-' || cast(l_partkey AS string)
        || '-' || cast(l_suppkey AS string) AS item_id, l_orderkey AS order_id, cast(l_extendedprice AS decimal(12,2)) AS line_total
    FROM {lineitem}"""


@query("order_metrics", duck.cte(f=derive.duck(CLEAN_ITEMS), m=MEASURED) + f"SELECT item_id, order_id, {METRICS} FROM m")
def order_metrics(spark, sf_dir):
    rows = derive.landed(spark, sf_dir, "clean_items", CLEAN_ITEMS)
    hot = hot_keys(rows, "order_id")
    return plain(add_order_metrics(rows, hot=hot).drop("line_total"))


# A third of all lines belong to one order, on which the spread plans run at any size.
HOT_ITEMS = CLEAN_ITEMS.replace("l_orderkey AS order_id", "CASE WHEN l_partkey % 3 = 0 THEN -1 ELSE l_orderkey END AS order_id")
HOT_ROWS, TASK_ROWS = 1_000, 5_000
PARENTS = "SELECT o_orderkey AS order_id FROM {orders} WHERE o_orderstatus = 'F' UNION ALL SELECT -1 AS order_id"


@query("order_metrics_hot", duck.cte(f=derive.duck(HOT_ITEMS), m=MEASURED) + f"SELECT item_id, order_id, {METRICS} FROM m")
def order_metrics_hot(spark, sf_dir):
    rows = derive.landed(spark, sf_dir, "hot_items", HOT_ITEMS)
    hot = hot_keys(rows, "order_id", min_rows=HOT_ROWS)
    return plain(add_order_metrics(rows, hot=hot, rows_per_task=TASK_ROWS).drop("line_total"))


@query("reference_flag_hot", duck.cte(f=derive.duck(HOT_ITEMS), o=derive.duck(PARENTS)) + """
SELECT item_id, f.order_id IN (SELECT order_id FROM o) AS has_valid_order FROM f""")
def reference_flag_hot(spark, sf_dir):
    rows = derive.landed(spark, sf_dir, "hot_items", HOT_ITEMS)
    hot = hot_keys(rows, "order_id", min_rows=HOT_ROWS)
    flagged = flag_reference(
        rows, derive.run(spark, sf_dir, PARENTS), "order_id", "has_valid_order", salt_by="item_id", hot=hot, rows_per_task=TASK_ROWS
    )
    return flagged.select("item_id", "has_valid_order")


@query("items_silver", duck.cte(
    i=BASE, o=LANDED, v=f"SELECT * FROM (SELECT * FROM i WHERE {VALID}) QUALIFY {NEWEST}", t=TYPED, f=FIXED, m=MEASURED,
) + f"""
SELECT item_id, m.order_id, product_id, sku_cleaned, product_name, category, quantity, cast(unit_price AS double) AS unit_price,
    cast(line_total AS double) AS line_total, {ENRICHED}, {METRICS}, o.order_id IS NOT NULL AS has_valid_order
FROM m LEFT JOIN o ON o.order_id = m.order_id""")
def items_silver(spark, sf_dir):
    rows = silver_items(bronze(spark, sf_dir), landed_orders(spark, sf_dir), batch_id="s-1")
    return plain(rows.select(*ITEM_COLUMNS))


@query("line_numbers", """
SELECT count(*) AS lines, 1 AS first_line, count(*) AS last_line, count(*) AS distinct_lines FROM lineitem""")
def line_numbers(spark, sf_dir):
    numbered = number_lines(derive.load(spark, sf_dir, "lineitem"), "line")
    per_line = numbered.groupBy("line").agg(F.count(F.lit(1)).alias("n"))
    return per_line.agg(
        F.sum("n").alias("lines"), F.min("line").alias("first_line"),
        F.max("line").alias("last_line"), F.count(F.lit(1)).alias("distinct_lines"),
    )
