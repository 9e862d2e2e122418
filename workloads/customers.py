"""Customer queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.contracts import CUSTOMERS as CONTRACT
from lakemill.operators import enrich, filters, quality, standardize
from lakemill.operators.changes import current_rows, stack_changes
from lakemill.operators.dedup import newest_per_key
from lakemill.operators.drift import conform
from lakemill.plans.silver import CUSTOMER_COLUMNS, silver_customers
from workloads import derive, duck
from workloads.shape import AS_OF, Checks, plain

CHECKS = Checks()
query = CHECKS.query
BASE = derive.duck(derive.CUSTOMERS)


def messy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.landed(spark, sf_dir, "customers", derive.CUSTOMERS)


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches: all customers, and all again with the other half of the values newer."""
    checked = quality.validate(messy(spark, sf_dir).select(*CONTRACT.columns, "k"), CONTRACT.rules(AS_OF))
    first = checked.withColumns(
        {
            "_bronze_ingestion_timestamp": F.lit(datetime(2024, 1, 2)),
            "_bronze_ingestion_batch_id": F.lit("batch-1"),
        }
    )
    second = checked.withColumns(
        {
            "phone": F.lit("555-010-2030"),
            "_bronze_ingestion_timestamp": F.when(F.col("k") % 3 == 0, F.lit(datetime(2024, 1, 1)))
            .when(F.col("k") % 3 == 1, F.lit(datetime(2024, 1, 2)))
            .otherwise(F.lit(datetime(2024, 1, 3))),
            "_bronze_ingestion_batch_id": F.lit("batch-2"),
        }
    )
    return first.unionByName(second).withColumn("_bronze_source_line_number", F.col("k"))


PHONE_DIGITS = "regexp_replace(phone, '[^0-9]', '', 'g')"
PHONE = f"""CASE WHEN length({PHONE_DIGITS}) >= 10 THEN
    '(' || substr(right({PHONE_DIGITS}, 10), 1, 3) || ') ' || substr(right({PHONE_DIGITS}, 10), 4, 3) || '-' ||
    substr(right({PHONE_DIGITS}, 10), 7, 4) END"""
REGISTERED = """coalesce(
    CASE WHEN regexp_full_match(registration_date, '\\d{4}-\\d\\d-\\d\\d') THEN try_strptime(registration_date, '%Y-%m-%d') END,
    CASE WHEN regexp_full_match(registration_date, '\\d\\d/\\d\\d/\\d{4}') THEN try_strptime(registration_date, '%m/%d/%Y') END,
    CASE WHEN regexp_full_match(registration_date, '\\d\\d-\\d\\d-\\d{4}') THEN try_strptime(registration_date, '%d-%m-%Y') END,
    CASE WHEN regexp_full_match(registration_date, '\\d{4}-\\d\\d-\\d\\dT\\d\\d:\\d\\d:\\d\\d') THEN try_strptime(registration_date, '%Y-%m-%dT%H:%M:%S') END)"""
CLEAN = f"""SELECT * REPLACE (
        CASE WHEN NOT {duck.blank('first_name')} THEN {duck.initcap('first_name')} END AS first_name,
        CASE WHEN NOT {duck.blank('last_name')} THEN {duck.initcap('last_name')} END AS last_name,
        {PHONE} AS phone,
        cast({REGISTERED} AS date) AS registration_date,
        CASE WHEN lower(trim(customer_segment)) IN ('premium', 'standard', 'basic', 'vip') THEN lower(trim(customer_segment)) ELSE 'standard' END AS customer_segment,
        CASE WHEN lower(trim(is_active)) IN ('true', '1', 'y', 'yes') THEN true WHEN lower(trim(is_active)) IN ('false', '0', 'n', 'no') THEN false END AS is_active,
        {duck.amount('lifetime_value', 12)} AS lifetime_value),
    coalesce(regexp_matches(email, {duck.EMAIL}), false) AS email_valid,
    registration_date IS NULL OR {REGISTERED} IS NOT NULL AS registration_date_parsed
FROM SOURCE"""
CLEAN_OUT = f"""first_name, last_name, email, email_valid, phone, {duck.day_text('registration_date')} AS registration_date,
    registration_date_parsed, customer_segment, is_active, cast(lifetime_value AS double) AS lifetime_value"""
ENRICHED_OUT = """CASE WHEN first_name IS NOT NULL AND last_name IS NOT NULL THEN first_name || ' ' || last_name
        ELSE coalesce(first_name, last_name) END AS full_name,
    date_diff('day', registration_date, DATE '2025-01-01') AS customer_age_days,
    CASE WHEN lifetime_value >= 5000 THEN 'platinum' WHEN lifetime_value >= 2000 THEN 'gold' WHEN lifetime_value >= 500 THEN 'silver'
        ELSE 'bronze' END AS customer_tier,
    CASE WHEN email IS NOT NULL THEN regexp_extract(email, '@(.+)$', 1) END AS email_domain,
    email_valid OR phone IS NOT NULL AS has_verified_contact"""


@query("customers_clean", duck.cte(c=BASE, s=CLEAN.replace("SOURCE", "c")) + f"SELECT k, customer_id, {CLEAN_OUT} FROM s", optional=["is_active"])
def customers_clean(spark, sf_dir):
    return plain(standardize.standardize_customers(messy(spark, sf_dir)))


@query("customers_enriched", duck.cte(c=BASE, s=CLEAN.replace("SOURCE", "c")) + f"SELECT k, {ENRICHED_OUT} FROM s", optional=["customer_age_days"])
def customers_enriched(spark, sf_dir):
    enriched = enrich.enrich_customers(standardize.standardize_customers(messy(spark, sf_dir)), AS_OF)
    return plain(enriched.select("k", "full_name", "customer_age_days", "customer_tier", "email_domain", "has_verified_contact"))


@query("dq_customers", duck.cte(c=BASE) + duck.rules("c", "k", duck.CUSTOMER_CHECKS))
def dq_customers(spark, sf_dir):
    return quality.explode_codes(quality.apply_rules(messy(spark, sf_dir), CONTRACT.rules(AS_OF)), "k")


@query("dq_completeness", duck.cte(c=BASE) + f"""
SELECT k, {duck.completeness(list(CONTRACT.columns))} AS completeness, {duck.error_count(duck.CUSTOMER_CHECKS)} > 0 AS has_errors,
    len({duck.code_list(duck.CUSTOMER_CHECKS, 'ERROR')}) AS error_count,
    len({duck.code_list(duck.CUSTOMER_CHECKS, 'WARNING')}) AS warning_count,
    cast(to_json({duck.code_list(duck.CUSTOMER_CHECKS, 'ERROR')}) AS varchar) AS error_details,
    cast(to_json({duck.code_list(duck.CUSTOMER_CHECKS, 'WARNING')}) AS varchar) AS warning_details
FROM c""")
def dq_completeness(spark, sf_dir):
    rows = messy(spark, sf_dir).withColumnRenamed("k", "_k")
    checked = quality.validate(rows, CONTRACT.rules(AS_OF))
    return plain(
        checked.select(
            F.col("_k").alias("k"),
            F.col("_dq_completeness_score").alias("completeness"),
            F.col("_dq_has_errors").alias("has_errors"),
            F.col("_dq_error_count").alias("error_count"),
            F.col("_dq_warning_count").alias("warning_count"),
            F.col("_dq_error_details").alias("error_details"),
            F.col("_dq_warning_details").alias("warning_details"),
        )
    )


@query("schema_drift", duck.cte(c=BASE) + """
SELECT customer_id, first_name, last_name, email, phone, cast(NULL AS varchar) AS registration_date, customer_segment,
    is_active, cast(NULL AS varchar) AS lifetime_value,
    '{' || concat_ws(',', '"balance":"' || lifetime_value || '"', '"effective_date":"' || registration_date || '"') || '}' AS _extra_fields
FROM c""")
def schema_drift(spark, sf_dir):
    feed = messy(spark, sf_dir).drop("k").withColumnsRenamed(
        {"registration_date": "effective_date", "lifetime_value": "balance"}
    )
    return conform(feed, CONTRACT.columns)[0]


VALID = f"NOT {duck.blank('customer_id')} AND NOT {duck.blank('email')} AND {duck.error_count(duck.CUSTOMER_CHECKS)} = 0"


@query("valid_customers", duck.cte(c=BASE) + f"SELECT k, customer_id FROM c WHERE {VALID}")
def valid_customers(spark, sf_dir):
    checked = quality.validate(messy(spark, sf_dir), CONTRACT.rules(AS_OF))
    return filters.drop_invalid(checked, filters.CUSTOMER_IDS).select("k", "customer_id")


@query("email_checks", duck.cte(c=BASE) + f"""
SELECT k, 'missing' AS finding FROM c WHERE email IS NULL
UNION ALL SELECT k, 'present' FROM c WHERE email IS NOT NULL
UNION ALL SELECT k, 'unusable' FROM c WHERE NOT coalesce(regexp_matches(email, {duck.EMAIL}), false)""")
def email_checks(spark, sf_dir):
    rows = messy(spark, sf_dir)
    found = [
        (filters.missing_email, "missing"), (filters.present_email, "present"), (filters.unusable_email, "unusable"),
    ]
    parts = [keep(rows).select("k", F.lit(name).alias("finding")) for keep, name in found]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


BATCHES = {
    "c": BASE,
    "b": """SELECT *, TIMESTAMP '2024-01-02' AS seen_at, 'batch-1' AS batch FROM c
        UNION ALL SELECT * REPLACE ('555-010-2030' AS phone), CASE k % 3 WHEN 0 THEN TIMESTAMP '2024-01-01'
            WHEN 1 THEN TIMESTAMP '2024-01-02' ELSE TIMESTAMP '2024-01-03' END, 'batch-2' FROM c""",
}


@query("dedup_customers", duck.cte(**BATCHES) + """
SELECT customer_id, k, batch FROM b
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY seen_at DESC, batch DESC, k DESC) = 1""")
def dedup_customers(spark, sf_dir):
    ties = [F.col("_bronze_ingestion_batch_id").desc(), F.col("_bronze_source_line_number").desc()]
    newest = newest_per_key(bronze(spark, sf_dir), "customer_id", "_bronze_ingestion_timestamp", ties)
    return newest.select("customer_id", "k", F.col("_bronze_ingestion_batch_id").alias("batch"))


@query("customers_silver", duck.cte(
    **BATCHES,
    v=f"""SELECT * EXCLUDE (seen_at, batch, n) FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY seen_at DESC, batch DESC, k DESC) AS n
        FROM b WHERE {VALID}) WHERE n = 1""",
    s=CLEAN.replace("SOURCE", "v"),
) + f"SELECT customer_id, {CLEAN_OUT}, {ENRICHED_OUT} FROM s", optional=["customer_age_days", "is_active"])
def customers_silver(spark, sf_dir):
    return plain(silver_customers(bronze(spark, sf_dir), batch_id="s-1", as_of=AS_OF).select(*CUSTOMER_COLUMNS))


@query("customers_dedup_first", duck.cte(
    **BATCHES,
    n="SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY seen_at DESC, batch DESC, k DESC) AS n FROM b",
) + f"SELECT customer_id, email FROM n WHERE n = 1 AND {VALID}")
def customers_dedup_first(spark, sf_dir):
    rows = silver_customers(bronze(spark, sf_dir), batch_id="s-1", as_of=AS_OF, filter_first=False)
    return rows.select("customer_id", "email")


@query("customer_changes", duck.cte(
    c=BASE,
    u="""SELECT customer_id, email, lifetime_value, k, 0 AS part FROM c
        UNION ALL SELECT customer_id, 'new' || cast(k AS string) || '@mail.org', '1.00', k, 1 FROM c WHERE customer_segment = 'vip'
        UNION ALL SELECT 'NEW' || customer_id, email, NULL, k, 2 FROM c""",
) + """
SELECT customer_id, email, lifetime_value, k FROM u
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY part DESC, k DESC) = 1""")
def customer_changes(spark, sf_dir):
    present = messy(spark, sf_dir).select("customer_id", "email", "lifetime_value", "k")
    vips = messy(spark, sf_dir).filter(F.col("customer_segment") == "vip")
    updates = vips.select(
        "customer_id", F.concat(F.lit("new"), F.col("k").cast("string"), F.lit("@mail.org")).alias("email"),
        F.lit("1.00").alias("lifetime_value"), "k",
    )
    added = present.select(F.concat(F.lit("NEW"), "customer_id").alias("customer_id"), "email", "k")
    return current_rows(stack_changes(present, updates, added), "customer_id", [F.col("k").desc()])
