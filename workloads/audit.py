"""Queries over audit logs derived from the order days."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.functions import sql
from lakemill.operators import audit
from lakemill.operators.schema_history import columns_after, schema_changes
from workloads import derive, duck
from workloads.shape import Checks, plain

CHECKS = Checks()
query = CHECKS.query
AS_OF = date(2001, 8, 1)

# One bronze batch per order day and status.
BRONZE_LOG = """
SELECT 'b-' || cast(cast(o_orderdate AS date) AS string) || '-' || o_orderstatus AS batch_id,
    CASE o_orderstatus WHEN 'F' THEN 'orders' WHEN 'O' THEN 'customers' ELSE 'order_items' END AS table_name,
    CASE WHEN count(*) > 3 THEN 'SUCCESS' ELSE 'FAILED' END AS status,
    cast(o_orderdate AS date) AS ingestion_date, count(*) AS records_total,
    sum(CASE WHEN o_totalprice < 50000 THEN 1 ELSE 0 END) AS records_with_errors,
    sum(CASE WHEN o_totalprice > 400000 THEN 1 ELSE 0 END) AS records_duplicate,
    cast(sum(CASE WHEN o_totalprice < 50000 THEN 0 ELSE 1 END) * 100 / count(*) AS decimal(5,2)) AS data_quality_score,
    cast(count(*) * 0.25 AS decimal(10,2)) AS processing_duration_seconds
FROM {orders} GROUP BY o_orderdate, o_orderstatus"""

# A run per day: a start event, and an end event on days with an even number of orders.
EVENTS = """
SELECT 'run-' || cast(cast(o_orderdate AS date) AS string) AS execution_id, 'daily' AS name,
    cast(o_orderdate AS date) AS execution_date, count(*) AS n
FROM {orders} GROUP BY o_orderdate"""


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.run(spark, sf_dir, BRONZE_LOG)


@query("quality_trend", duck.cte(b=derive.duck(BRONZE_LOG)) + f"""
SELECT {duck.day_text('ingestion_date')} AS ingestion_date, records_total, cast(records_with_errors AS bigint) AS records_with_errors,
    cast(data_quality_score AS double) AS data_quality_score, cast(processing_duration_seconds AS double) AS processing_duration_seconds
FROM b WHERE table_name = 'orders' AND ingestion_date >= DATE '2001-08-01' - INTERVAL 365 DAY""")
def quality_trend(spark, sf_dir):
    return plain(audit.quality_trend(_log(spark, sf_dir), "orders", AS_OF, 365))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = derive.run(spark, sf_dir, EVENTS)
    opened = F.col("execution_date").cast("timestamp")
    closed = F.timestamp_add("MINUTE", F.col("n").cast("int"), opened)

    def event(status: str, ended, records):
        return days.filter((F.col("n") % 2 == 0) | (F.lit(status) == "RUNNING")).select(
            "execution_id",
            F.col("name").alias("pipeline_name"),
            "execution_date",
            opened.alias("start_timestamp"),
            ended.alias("end_timestamp"),
            F.when(ended.isNotNull(), F.col("n") * 60).cast("decimal(10,2)").alias("duration_seconds"),
            F.lit(status).alias("status"),
            records.alias("records_processed"),
            F.lit("SCHEDULED").alias("triggered_by"),
            F.coalesce(ended, opened).alias("created_at"),
        )

    nothing = F.lit(None)
    return event("RUNNING", nothing.cast("timestamp"), nothing.cast("bigint")).unionByName(
        event("SUCCESS", closed, F.col("n"))
    )


STATES = """SELECT *, CASE WHEN n % 2 = 0 THEN 'SUCCESS' ELSE 'RUNNING' END AS status,
    CASE WHEN n % 2 = 0 THEN cast(n * 60 AS double) END AS duration_seconds, CASE WHEN n % 2 = 0 THEN n END AS records_processed FROM e"""


@query("latest_execution", duck.cte(e=derive.duck(EVENTS), s=STATES) + """
SELECT execution_id, status, duration_seconds, records_processed FROM s""", optional=["records_processed"])
def latest_execution(spark, sf_dir):
    latest = audit.latest_executions(_events(spark, sf_dir))
    return plain(latest.select("execution_id", "status", "duration_seconds", "records_processed"))


@query("run_performance", duck.cte(e=derive.duck(EVENTS), s=STATES) + f"""
SELECT {duck.day_text('execution_date')} AS execution_date, status, duration_seconds, records_processed, 'SCHEDULED' AS triggered_by
FROM s WHERE execution_date >= DATE '2001-08-01' - INTERVAL 1000 DAY""", optional=["records_processed"])
def run_performance(spark, sf_dir):
    latest = audit.latest_executions(_events(spark, sf_dir))
    return plain(audit.execution_performance(latest, "daily", AS_OF, 1000))


@query("batch_summary", duck.cte(b=derive.duck(BRONZE_LOG)) + """
SELECT b.batch_id, b.table_name AS bronze_table, b.status AS bronze_status, records_total,
    cast(records_with_errors AS bigint) AS records_with_errors, cast(records_duplicate AS bigint) AS records_duplicate,
    CASE WHEN status = 'SUCCESS' THEN replace(batch_id, 'b-', 's-') END AS silver_batch_id,
    CASE WHEN status = 'SUCCESS' THEN table_name END AS silver_table,
    CASE WHEN status = 'SUCCESS' THEN 'SUCCESS' END AS silver_status,
    CASE WHEN status = 'SUCCESS' THEN records_total END AS records_input,
    CASE WHEN status = 'SUCCESS' THEN cast(records_total - records_with_errors AS bigint) END AS records_output,
    CASE WHEN status = 'SUCCESS' AND table_name = 'orders' THEN replace(batch_id, 'b-', 'g-') END AS gold_batch_id,
    CASE WHEN status = 'SUCCESS' AND table_name = 'orders' THEN 'sales' END AS gold_table,
    CASE WHEN status = 'SUCCESS' AND table_name = 'orders' THEN 'SUCCESS' END AS gold_status,
    CASE WHEN status = 'SUCCESS' AND table_name = 'orders' THEN records_total END AS records_inserted
FROM b""", optional=["records_input", "records_inserted", "records_output"])
def batch_summary(spark, sf_dir):
    bronze = _log(spark, sf_dir)

    def renamed(letter: str):
        return F.replace("batch_id", F.lit("b-"), F.lit(f"{letter}-"))

    silver = bronze.filter(F.col("status") == "SUCCESS").select(
        F.col("batch_id").alias("source_batch_id"), renamed("s").alias("batch_id"), "table_name", "status",
        F.col("records_total").alias("records_input"),
        (F.col("records_total") - F.col("records_with_errors")).alias("records_output"),
    )
    gold = bronze.filter((F.col("status") == "SUCCESS") & (F.col("table_name") == "orders")).select(
        renamed("s").alias("source_batch_id"), renamed("g").alias("batch_id"), F.lit("sales").alias("table_name"),
        "status", F.col("records_total").alias("records_inserted"),
    )
    return audit.batch_summary(bronze, silver, gold)


# One batch per year; its columns depend on its number of orders.
SETS = """
SELECT 'b-' || cast(year(o_orderdate) AS string) AS batch_id, cast(make_date(year(o_orderdate), 12, 31) AS timestamp) AS detected_at, count(*) AS n
FROM {orders} GROUP BY year(o_orderdate)"""
START = ("id", "total", "paid")


def _sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n")
    names = F.array(F.lit("id"), F.when(n % 2 == 0, "total"), F.when(n % 3 != 0, "channel"), F.when(n % 5 < 3, "paid"))
    rows = derive.run(spark, sf_dir, SETS).withColumns({"table_name": F.lit("orders"), "layer": F.lit("bronze")})
    return rows.withColumn("columns", F.array_compact(names)).drop("n")


VERSIONS = {
    "t": derive.duck(SETS).replace("cast(make_date(year(o_orderdate), 12, 31) AS timestamp)", "year(o_orderdate)"),
    "s": """SELECT batch_id, list_filter(['id', CASE WHEN n % 2 = 0 THEN 'total' END, CASE WHEN n % 3 <> 0 THEN 'channel' END,
        CASE WHEN n % 5 < 3 THEN 'paid' END], lambda c: c IS NOT NULL) AS found FROM t""",
    "p": "SELECT *, coalesce(lag(found) OVER (ORDER BY batch_id), ['id', 'total', 'paid']) AS earlier FROM s",
    "d": """SELECT *, list_sort(list_filter(found, lambda c: NOT list_contains(earlier, c))) AS more,
        list_sort(list_filter(earlier, lambda c: NOT list_contains(found, c))) AS less FROM p""",
    "v": "SELECT *, '1.' || cast(sum(CASE WHEN len(more) + len(less) > 0 THEN 1 ELSE 0 END) OVER (ORDER BY batch_id) AS varchar) AS version FROM d",
}


@query("schema_history", duck.cte(**VERSIONS) + """
SELECT batch_id, version AS schema_version, 'COLUMN_ADDED' AS change_type, array_to_string(more, ',') AS columns,
    array_to_string(list_sort(found), ',') AS columns_after FROM v WHERE len(more) > 0
UNION ALL SELECT batch_id, version, 'COLUMN_REMOVED', array_to_string(less, ','), array_to_string(list_sort(found), ',') FROM v WHERE len(less) > 0""")
def schema_history(spark, sf_dir):
    """Changes of the column set by batch, with the set as replayed from the changes."""
    sets = _sets(spark, sf_dir)
    changes = schema_changes(sets, START)
    after = columns_after(changes, sets.drop("columns"), START).withColumnRenamed("columns", "after")
    joined = changes.join(after.select("batch_id", "after"), "batch_id")
    return joined.select(
        "batch_id", "schema_version", "change_type", F.array_join("columns", ",").alias("columns"),
        F.array_join("after", ",").alias("columns_after"),
    )


@query("quality_trend_sql", duck.cte(b=derive.duck(BRONZE_LOG)) + f"""
SELECT {duck.day_text('ingestion_date')} AS ingestion_date, records_total, cast(records_with_errors AS bigint) AS records_with_errors,
    cast(data_quality_score AS double) AS data_quality_score, cast(processing_duration_seconds AS double) AS processing_duration_seconds
FROM b WHERE table_name = 'orders' AND ingestion_date >= DATE '2001-08-01' - INTERVAL 365 DAY""")
def quality_trend_sql(spark, sf_dir):
    """``quality_trend`` as a SQL table function with bound parameters."""
    _log(spark, sf_dir).createOrReplaceTempView("trend_log")
    sql.register(spark, views={"bronze_batch_log": "trend_log"})
    found = spark.sql("SELECT * FROM lake_quality_trend(:name, :as_of, :days)", {"name": "orders", "as_of": AS_OF, "days": 365})
    return plain(found)


GOLD = """SELECT 'g-' || cast(year(o_orderdate) AS string) AS batch_id, 's-' || cast(year(o_orderdate) AS string) AS source_batch_id,
    count(*) AS records_inserted, sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS records_updated
FROM {orders} GROUP BY year(o_orderdate)"""


@query("gold_log", duck.cte(g=derive.duck(GOLD)) + """
SELECT batch_id, source_batch_id, 'daily_sales' AS table_name, 'FACT' AS table_type, records_inserted,
    cast(records_updated AS bigint) AS records_updated, cast(0 AS bigint) AS records_deleted, '["sum", "count"]' AS business_rules_applied,
    cast(cast(records_inserted * 0.125 AS decimal(10,2)) AS varchar) AS seconds, 'SUCCESS' AS status FROM g""")
def gold_log(spark, sf_dir):
    """One gold batch per order year, logged twice as after a failure; amounts as exact decimal texts."""
    log = audit.AuditLog(spark, derive.new_folder(spark, "gold"))
    years = derive.run(spark, sf_dir, GOLD).collect()  # one row per year
    for _ in range(2):
        log.log("gold_batch_log", [{
            "batch_id": r["batch_id"], "source_batch_id": r["source_batch_id"], "table_name": "daily_sales", "table_type": "FACT",
            "records_inserted": r["records_inserted"], "records_updated": r["records_updated"], "records_deleted": 0,
            "business_rules_applied": ["sum", "count"], "processing_duration_seconds": Decimal(r["records_inserted"]) / 8,
        } for r in years])
    return log.table("gold_batch_log").select(
        "batch_id", "source_batch_id", "table_name", "table_type", "records_inserted", "records_updated", "records_deleted",
        "business_rules_applied", F.col("processing_duration_seconds").cast("string").alias("seconds"), "status",
    )
