"""Order queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.contracts import ORDERS as CONTRACT
from lakemill.functions import dates, numbers, sql, text
from lakemill.operators import enrich, quality, standardize
from lakemill.operators.audit import categorise, issues_from_rows
from lakemill.operators.drift import drop_technical_columns
from lakemill.operators.filters import ORDER_IDS, amount_mismatches, drop_invalid
from lakemill.operators.line_numbers import number_positions, with_files, with_positions
from lakemill.plans.bronze import bronze_rows, located_rows
from lakemill.plans.silver import ORDER_COLUMNS, silver_orders, stage_counts
from workloads import derive, duck
from workloads.shape import AS_OF, Checks, plain

CHECKS = Checks()
query = CHECKS.query
BASE = derive.duck(derive.ORDERS)


def messy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.landed(spark, sf_dir, "orders", derive.ORDERS)


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messy orders with quality flags and lineage, one batch per order year."""
    checked = quality.validate(messy(spark, sf_dir).select(*CONTRACT.columns, "k", "batch_no"), CONTRACT.rules(AS_OF))
    return checked.withColumns(
        {
            "_bronze_ingestion_timestamp": F.make_timestamp("batch_no", F.lit(12), F.lit(31), F.lit(0), F.lit(0), F.lit(0)),
            "_bronze_ingestion_batch_id": F.concat(F.lit("batch-"), "batch_no"),
            "_bronze_source_line_number": F.col("k"),
        }
    )


@query("orders_dates", duck.cte(o=BASE) + f"""
SELECT k, {duck.time_text(duck.month_first('order_date'))} AS parsed,
    {duck.time_text(duck.day_first('order_date'))} AS parsed_day_first,
    {duck.time_text(duck.month_first('created_at'))} AS created
FROM o""")
def orders_dates(spark, sf_dir):
    o = messy(spark, sf_dir)
    return plain(
        o.select(
            "k",
            dates.parse_timestamp(F.col("order_date")).alias("parsed"),
            dates.parse_timestamp(F.col("order_date"), dates.DAY_FIRST).alias("parsed_day_first"),
            dates.parse_timestamp(F.col("created_at")).alias("created"),
        )
    )


# Seconds with parts of a second, down to microseconds.
FINE = "CASE WHEN k % 5 = 0 THEN order_date || '.' || lpad(cast(k * 7919 % 1000000 AS string), 6, '0') WHEN k % 5 = 3 THEN order_date || '.' || lpad(cast(k % 1000 AS string), 3, '0') ELSE order_date END"


@query("orders_dates_fine", duck.cte(o=BASE, f=f"SELECT k, {FINE} AS t FROM o") + """
SELECT k, strftime(coalesce(try_strptime(t, '%Y-%m-%d %H:%M:%S.%f'), try_strptime(t, '%Y-%m-%dT%H:%M:%S.%g')), '%Y-%m-%d %H:%M:%S.%f') AS parsed
FROM f WHERE k % 5 IN (0, 3) AND t LIKE '____-%'""")
def orders_dates_fine(spark, sf_dir):
    """Parts of a second survive parsing, in formats that have them."""
    rows = messy(spark, sf_dir).withColumn("t", F.expr(FINE)).where("k % 5 IN (0, 3) AND t LIKE '____-%'")
    parsed = dates.parse_timestamp(F.col("t"), ["yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss.SSS"])
    return rows.select("k", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("parsed"))


@query("orders_dates_sql", duck.cte(o=BASE) + f"""
SELECT k, {duck.time_text(duck.month_first('order_date'))} AS order_date_ts FROM o""")
def orders_dates_sql(spark, sf_dir):
    parses = ", ".join(f"try_to_timestamp(order_date, :f{i})" for i in range(len(dates.MONTH_FIRST_ISO)))
    sql = f"SELECT k, coalesce({parses}) AS order_date_ts FROM {{orders}}"
    formats = {f"f{i}": f for i, f in enumerate(dates.MONTH_FIRST_ISO)}
    return plain(spark.sql(sql, args=formats, orders=messy(spark, sf_dir)))


CALENDAR = """year(d) AS order_year, month(d) AS order_month, day(d) AS order_day, quarter(d) AS order_quarter,
    dayofweek(d) + 1 AS order_day_of_week, strftime(d, '%A') AS order_day_name,
    weekofyear(d) AS order_week_of_year, hour(d) AS order_hour,
    CASE WHEN hour(d) >= 6 AND hour(d) < 12 THEN 'Morning' WHEN hour(d) >= 12 AND hour(d) < 17 THEN 'Afternoon'
        WHEN hour(d) >= 17 AND hour(d) < 21 THEN 'Evening' ELSE 'Night' END AS order_time_period,
    dayofweek(d) IN (0, 6) AS is_weekend"""


@query("orders_calendar", duck.cte(o=BASE, p=f"SELECT k, {duck.month_first('order_date')} AS d FROM o") + f"""
SELECT k, {CALENDAR}, date_diff('day', cast(d AS date), DATE '2025-01-01') AS days_since_order FROM p""", optional=["days_since_order", "is_weekend", "order_day", "order_day_of_week", "order_hour", "order_month", "order_quarter", "order_week_of_year", "order_year"])
def orders_calendar(spark, sf_dir):
    parsed = messy(spark, sf_dir).select("k", dates.parse_timestamp(F.col("order_date")).alias("order_date"))
    since = dates.days_until(AS_OF, F.col("order_date")).alias("days_since_order")
    return plain(enrich.add_calendar(parsed).select("*", since).drop("order_date"))


AMOUNTS = ["subtotal", "tax_amount", "discount_amount", "total_amount"]
CLEAN = f"SELECT k, batch_no, order_id, customer_id, {', '.join(duck.amount(c) + ' AS ' + c for c in AMOUNTS)} FROM o"
EXPECTED = "subtotal + tax_amount - discount_amount"


@query("orders_amounts", duck.cte(o=BASE, c=CLEAN) + f"""
SELECT k, cast(subtotal AS double) AS subtotal, cast(tax_amount AS double) AS tax_amount,
    cast(discount_amount AS double) AS discount_amount,
    cast(CASE WHEN abs(total_amount - ({EXPECTED})) > 0.01 THEN {EXPECTED} ELSE total_amount END AS double) AS total_amount,
    cast(CASE WHEN total_amount <> {EXPECTED} THEN {EXPECTED} ELSE total_amount END AS double) AS total_exact
FROM c""")
def orders_amounts(spark, sf_dir):
    typed = standardize.standardize_orders(messy(spark, sf_dir))
    expected = F.col("subtotal") + F.col("tax_amount") - F.col("discount_amount")
    exact = typed.withColumn("total_exact", numbers.reconcile(F.col("total_amount"), expected, "0"))
    return plain(standardize.repair_order_total(exact).select("k", *AMOUNTS, "total_exact"))


@query("amount_mismatches", duck.cte(o=BASE, c=CLEAN) + f"""
SELECT k, cast(total_amount AS double) AS total_amount FROM c WHERE total_amount <> {EXPECTED}""")
def mismatched_amounts(spark, sf_dir):
    typed = standardize.standardize_orders(messy(spark, sf_dir))
    return plain(amount_mismatches(typed).select("k", "total_amount"))


REPAIRED = f"""SELECT k, order_id, customer_id, subtotal, tax_amount, discount_amount,
    CASE WHEN abs(total_amount - ({EXPECTED})) > 0.01 THEN {EXPECTED} ELSE total_amount END AS total_amount FROM c"""


@query("orders_bands", duck.cte(o=BASE, c=CLEAN, r=REPAIRED) + f"""
SELECT k, CASE WHEN total_amount >= 500 THEN 'high_value' WHEN total_amount >= 100 THEN 'medium_value' ELSE 'low_value' END
        AS order_value_category,
    CASE WHEN subtotal > 0 THEN {duck.ratio(f"(100 * {duck.cents('discount_amount')})", duck.cents('subtotal'))} ELSE 0.0 END
        AS discount_percentage,
    discount_amount > 0 AS has_discount
FROM r""")
def orders_bands(spark, sf_dir):
    typed = standardize.repair_order_total(standardize.standardize_orders(messy(spark, sf_dir)))
    banded = enrich.add_order_values(typed, AS_OF)
    return plain(banded.select("k", "order_value_category", "discount_percentage", "has_discount"))


PAYMENT = """CASE WHEN lower(trim(payment_method)) IN ('credit_card', 'credit card', 'creditcard', 'cc') THEN 'credit_card'
    WHEN lower(trim(payment_method)) IN ('debit_card', 'debit card', 'debitcard') THEN 'debit_card'
    WHEN lower(trim(payment_method)) IN ('paypal', 'pay pal') THEN 'paypal'
    WHEN lower(trim(payment_method)) IN ('gift_card', 'gift card', 'giftcard') THEN 'gift_card'
    WHEN lower(trim(payment_method)) IN ('cod', 'cash on delivery', 'cash') THEN 'cash_on_delivery' ELSE 'other' END"""


@query("payment_standard", duck.cte(o=BASE) + f"SELECT k, {PAYMENT} AS payment_method FROM o")
def payment_standard(spark, sf_dir):
    return messy(spark, sf_dir).select("k", text.payment_method(F.col("payment_method")).alias("payment_method"))


@query("payment_standard_sql", duck.cte(o=BASE) + f"SELECT k, {PAYMENT} AS payment_method FROM o")
def payment_standard_sql(spark, sf_dir):
    """``payment_standard`` as SQL with the registered function."""
    sql.register(spark)
    return spark.sql("SELECT k, lake_payment_method(payment_method) AS payment_method FROM {orders}", orders=messy(spark, sf_dir))


@query("dq_orders", duck.cte(o=BASE) + duck.rules("o", "k", duck.ORDER_CHECKS))
def dq_orders(spark, sf_dir):
    return quality.explode_codes(quality.apply_rules(messy(spark, sf_dir), CONTRACT.rules(AS_OF)), "k")


ERRORS = duck.error_count(duck.ORDER_CHECKS)


@query("dq_batch_score", duck.cte(o=BASE, e=f"SELECT {ERRORS} AS errors FROM o") + """
SELECT count(*) AS records_total, count(*) FILTER (WHERE errors > 0) AS records_with_errors,
    cast(cast((count(*) - count(*) FILTER (WHERE errors > 0)) / count(*) * 100 AS decimal(5,2)) AS double) AS data_quality_score
FROM e""")
def dq_batch_score(spark, sf_dir):
    return plain(quality.batch_score(bronze(spark, sf_dir)))


VALID = f"""SELECT * FROM o WHERE NOT {duck.blank('order_id')} AND NOT {duck.blank('customer_id')}
    AND {duck.error_count(duck.ORDER_CHECKS)} = 0"""


@query("valid_orders", duck.cte(o=BASE, v=VALID) + "SELECT k, order_id, customer_id FROM v")
def valid_orders(spark, sf_dir):
    return drop_invalid(bronze(spark, sf_dir), ORDER_IDS).select("k", "order_id", "customer_id")


RAW = "'{' || concat_ws(',', " + ", ".join(
    f"'\"{c}\":\"' || {c} || '\"'" for c in CONTRACT.columns
) + ") || '}'"
HASH = "md5(concat_ws('|', " + ", ".join(
    f"coalesce(cast(length({c}) AS varchar) || ':' || {c}, '-')" for c in CONTRACT.columns
) + "))"


@query("bronze_orders", duck.cte(o=BASE) + f"""
SELECT order_id, {duck.completeness(list(CONTRACT.columns))} AS completeness, {duck.error_count(duck.ORDER_CHECKS)} AS errors,
    cast(to_json({duck.code_list(duck.ORDER_CHECKS, 'ERROR')}) AS varchar) AS details,
    {HASH} AS record_hash, {RAW} AS raw_record, md5('landing/orders.csv') AS file_hash, 'b-1' AS batch_id
FROM o""")
def bronze_orders(spark, sf_dir):
    located, _ = located_rows(messy(spark, sf_dir).select(*CONTRACT.columns), CONTRACT)
    rows = bronze_rows(located, CONTRACT, batch_id="b-1", source_file="landing/orders.csv", as_of=AS_OF)
    return plain(
        rows.select(
            "order_id",
            F.col("_dq_completeness_score").alias("completeness"),
            F.col("_dq_error_count").alias("errors"),
            F.col("_dq_error_details").alias("details"),
            F.col("_bronze_record_hash").alias("record_hash"),
            F.col("_bronze_raw_record").alias("raw_record"),
            F.col("_bronze_file_hash").alias("file_hash"),
            F.col("_bronze_ingestion_batch_id").alias("batch_id"),
        )
    )


SILVER_PARTS = {
    "o": BASE,
    "v": VALID,
    "c": f"""SELECT k, batch_no, order_id, customer_id, {', '.join(duck.amount(c) + ' AS ' + c for c in AMOUNTS)},
        {PAYMENT} AS payment_method, {duck.month_first('order_date')} AS d, {duck.month_first('created_at')} AS created FROM v""",
    "s": f"""SELECT *, CASE WHEN abs(total_amount - ({EXPECTED})) > 0.01 THEN {EXPECTED} ELSE total_amount END AS total FROM c
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY created DESC NULLS LAST, batch_no DESC, k DESC) = 1""",
}


@query("orders_silver", duck.cte(**SILVER_PARTS) + f"""
SELECT order_id, customer_id, {duck.time_text('d')} AS order_date, cast(subtotal AS double) AS subtotal,
    cast(tax_amount AS double) AS tax_amount, cast(discount_amount AS double) AS discount_amount,
    cast(total AS double) AS total_amount, payment_method, {duck.time_text('created')} AS created_at, {CALENDAR}
FROM s""", optional=["is_weekend", "order_day", "order_day_of_week", "order_hour", "order_month", "order_quarter", "order_week_of_year", "order_year"])
def orders_silver(spark, sf_dir):
    return plain(silver_orders(bronze(spark, sf_dir), batch_id="s-1", as_of=AS_OF).select(*ORDER_COLUMNS))


@query("stage_counts", duck.cte(
    **SILVER_PARTS,
    n="""SELECT batch_no, count(*) AS n_in FROM o GROUP BY batch_no""",
    nv="""SELECT batch_no, count(*) AS n_valid FROM v GROUP BY batch_no""",
    ns="""SELECT batch_no, count(*) AS n_out FROM s GROUP BY batch_no""",
) + """
SELECT 'batch-' || cast(n.batch_no AS string) AS _bronze_ingestion_batch_id, n_in AS records_input,
    n_in - coalesce(n_valid, 0) AS records_filtered, coalesce(n_valid, 0) - coalesce(n_out, 0) AS records_deduplicated,
    coalesce(n_out, 0) AS records_output, coalesce(n_out, 0) / n_in * 100 AS data_quality_score
FROM n LEFT JOIN nv ON nv.batch_no = n.batch_no LEFT JOIN ns ON ns.batch_no = n.batch_no""")
def counts(spark, sf_dir):
    rows = bronze(spark, sf_dir)
    return stage_counts(rows, ORDER_IDS, silver_orders(rows, batch_id="s-1", as_of=AS_OF))


def _issues(spark, sf_dir):
    rows = messy(spark, sf_dir).select(*CONTRACT.columns)
    return categorise(issues_from_rows(rows, "order_id", CONTRACT.rules(AS_OF)))


ISSUES = {
    "o": BASE,
    "i": "\nUNION ALL\n".join(
        f"""SELECT order_id AS record_identifier, split_part('{code}', ':', 1) AS error_type,
            split_part('{code}', ':', 2) AS error_field, {code.split(':')[1]} AS error_value, '{severity}' AS severity
            FROM o WHERE {condition}"""
        for code, severity, condition in duck.ORDER_CHECKS
    ),
    "g": """SELECT *, CASE WHEN error_type LIKE 'MISSING%' THEN 'MISSING' WHEN error_type LIKE 'INVALID%' THEN 'INVALID'
        WHEN error_type LIKE 'NEGATIVE%' THEN 'RANGE' ELSE 'OTHER' END AS error_category FROM i""",
}


@query("issue_log", duck.cte(**ISSUES) + """
SELECT record_identifier, error_type, error_category, error_field, error_value, severity FROM g""")
def issue_log(spark, sf_dir):
    return _issues(spark, sf_dir).drop("error_message")


@query("issues_by_category", duck.cte(**ISSUES) + """
SELECT error_category, error_type, error_field, count(*) AS issues FROM g GROUP BY ALL""")
def issues_by_category(spark, sf_dir):
    grouped = _issues(spark, sf_dir).groupBy("error_category", "error_type", "error_field")
    return grouped.agg(F.count(F.lit(1)).alias("issues"))


@query("line_order", duck.cte(o=BASE) + """
SELECT k, cast(row_number() OVER (PARTITION BY batch_no ORDER BY k) AS bigint) AS line, 'batch_no=' || cast(batch_no AS string) AS folder FROM o""")
def line_order(spark, sf_dir):
    """Each line's number and file: one landing file per year, whose lines are in the order of the keys."""
    root = derive.new_folder(spark, "lines")
    rows = messy(spark, sf_dir).select("batch_no", "k").repartition("batch_no").sortWithinPartitions("batch_no", "k")
    rows.write.partitionBy("batch_no").csv(f"{root}/landing")
    scan = spark.read.schema("k bigint, batch_no int").csv(f"{root}/landing")
    numbered = number_positions(with_positions(with_files(scan)), "line")
    return numbered.select("k", "line", F.element_at(F.split("_file", "/"), -2).alias("folder"))


@query("technical_dropped", duck.cte(o=BASE) + f"SELECT {', '.join(CONTRACT.columns)}, k, batch_no FROM o")
def technical_dropped(spark, sf_dir):
    """Bronze rows without what the layer added."""
    return drop_technical_columns(bronze(spark, sf_dir))
