"""End to end: landing CSV files, bronze, silver and audit over several batches and runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.contracts import CUSTOMERS
from lakemill.contracts import ORDERS as CONTRACT
from lakemill.operators.audit import AuditLog
from lakemill.plans.bronze import ingest
from lakemill.plans.silver import SILVER, refine
from lakemill.sources import lake
from lakemill.sources.compaction import compact, silver_rows
from lakemill.streaming.incremental import refine_available
from lakemill.streaming.landing import ingest_available
from workloads import customers, derive, duck, orders
from workloads.shape import AS_OF, Checks, plain

CHECKS = Checks()
query = CHECKS.query

# In a CSV file an empty field and a missing one are the same. Orders fall into three batches by year; one column more
# comes with the last.
FEED = f"""SELECT k, status, batch_no, {', '.join(f"nullif({c}, '') AS {c}" for c in CONTRACT.columns)} FROM ({orders.BASE}) feed"""
PARTS = orders.SILVER_PARTS | {"o": FEED}
BATCH = "'b' || cast(batch_no % 3 AS string)"
SILVER_BATCH = "CASE WHEN batch_no % 3 = 2 THEN 's2' ELSE 's1' END"


def _run(spark: SparkSession, sf_dir: str, *, pack: bool = False) -> tuple[str, AuditLog]:
    """Ingest and refine b0 and b1, run both once more as after a failure, then add b2; returns the silver path and the audit.

    ``pack``: pack the silver batches before they are made again, and once more at the end.
    """
    root = derive.new_folder(spark, "lake")
    bronze, silver, audit = f"{root}/bronze", f"{root}/silver", AuditLog(spark, f"{root}/audit")
    feed = orders.messy(spark, sf_dir)
    for number in range(3):
        rows = feed.filter(F.col("batch_no") % 3 == number).select(*CONTRACT.columns)
        if number == 2:
            rows = rows.withColumn("channel", F.lit("web"))
        options = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "emptyValue": ""}
        rows.write.options(**options).csv(f"{root}/landing/{number}")

    def take(number: int) -> None:
        ingest(spark, CONTRACT, f"{root}/landing/{number}", bronze, batch_id=f"b{number}", as_of=AS_OF, audit=audit)

    for number in (0, 1, 1):
        take(number)
    for batch in ("s1", "s1"):
        refine(spark, "orders", bronze, silver, batch_id=batch, as_of=AS_OF, audit=audit)
    if pack:
        compact(spark, silver, SILVER["orders"].partition_by)
    take(1)
    refine(spark, "orders", bronze, silver, batch_id="again", as_of=AS_OF, audit=audit)
    take(2)
    refine(spark, "orders", bronze, silver, batch_id="s2", as_of=AS_OF, audit=audit)
    if pack:
        compact(spark, silver, SILVER["orders"].partition_by, target_rows=20_000)
    return silver, audit


INCREMENTAL = duck.cte(**PARTS) + f"""
SELECT order_id, customer_id, cast(total AS double) AS total_amount, payment_method, {duck.time_text('created')} AS created_at,
    {SILVER_BATCH} AS silver_batch, {BATCH} AS source_batch
FROM s"""


def _shown(rows: DataFrame) -> DataFrame:
    return plain(
        rows.select(
            "order_id", "customer_id", "total_amount", "payment_method", "created_at",
            F.col("_silver_batch_id").alias("silver_batch"), F.col("_silver_source_batch_id").alias("source_batch"),
        )
    )


@query("silver_incremental", INCREMENTAL)
def silver_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver, _ = _run(spark, sf_dir)
    return _shown(lake.read_table(spark, silver))


@query("silver_compacted", INCREMENTAL)
def silver_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same runs, with batches packed in between, one of which is made again later."""
    silver, _ = _run(spark, sf_dir, pack=True)
    return _shown(silver_rows(spark, silver))


# One path with files of three headers: as the contract says; turned round with one column more; without two columns.
MISSING = ("tax_amount", "payment_method")


@query("bronze_headers", duck.cte(o=FEED, h="SELECT *, batch_no % 3 AS g FROM o") + f"""
SELECT {', '.join(f"CASE WHEN g <> 2 THEN {c} END AS {c}" if c in MISSING else c for c in CONTRACT.columns)},
    CASE WHEN g = 1 THEN '{{"channel":"web"}}' END AS extra_fields
FROM h""")
def bronze_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = derive.new_folder(spark, "headers")
    feed = orders.messy(spark, sf_dir).withColumn("channel", F.lit("web"))
    columns = list(CONTRACT.columns)
    for number, names in enumerate((columns, [*reversed(columns), "channel"], [c for c in columns if c not in MISSING])):
        options = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "emptyValue": ""}
        rows = feed.filter(F.col("batch_no") % 3 == number).select(*names)
        rows.write.options(**options).mode("append").csv(f"{root}/landing")
    ingest(spark, CONTRACT, f"{root}/landing", f"{root}/bronze", batch_id="b1", as_of=AS_OF)
    rows = lake.read_table(spark, f"{root}/bronze", CONTRACT.bronze_schema)
    return rows.select(*columns, F.col("_extra_fields").alias("extra_fields"))


@query("audit_after_runs", duck.cte(
    **PARTS,
    n=f"""SELECT {BATCH} AS batch, batch_no % 3 AS g, count(*) AS n_in, sum(CASE WHEN {duck.error_count(duck.ORDER_CHECKS)} > 0 THEN 1 ELSE 0 END) AS bad,
        sum({duck.error_count(duck.ORDER_CHECKS)}) AS errors FROM o GROUP BY 1, 2""",
    nv=f"SELECT {BATCH} AS batch, count(*) AS n_valid FROM v GROUP BY 1",
    ns=f"SELECT {BATCH} AS batch, min({SILVER_BATCH}) AS silver, count(*) AS n_out FROM s GROUP BY 1",
) + """
SELECT n.batch, n_in AS total, cast(bad AS bigint) AS with_errors, ns.silver AS silver_batch, n_in AS read,
    n_in - n_valid AS filtered, n_out AS written, cast(errors AS bigint) AS issues,
    CASE WHEN g = 2 THEN '{"columns": ["channel"]}' END AS added_columns, 'SUCCESS' AS status
FROM n JOIN nv ON nv.batch = n.batch JOIN ns ON ns.batch = n.batch""")
def audit_after_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, audit = _run(spark, sf_dir)
    summary = audit.table("bronze_batch_log").selectExpr(
        "batch_id AS batch", "records_total AS total", "records_with_errors AS with_errors"
    )
    silver = audit.table("silver_batch_log").selectExpr(
        "source_batch_id AS batch", "batch_id AS silver_batch", "records_input AS read", "records_filtered AS filtered",
        "records_output AS written",
    )
    issues = audit.table("data_quality_issues").where("severity = 'ERROR'").groupBy(F.col("batch_id").alias("batch")).agg(
        F.count(F.lit(1)).alias("issues")
    )
    changes = audit.table("schema_history").where("change_type = 'COLUMN_ADDED'").selectExpr(
        "batch_id AS batch", "change_detail AS added_columns"
    )
    runs = audit.executions().where("bronze_batch_id IS NOT NULL").selectExpr("bronze_batch_id AS batch", "status")
    joined = summary.join(silver, "batch").join(issues, "batch").join(changes, "batch", "left").join(runs, "batch")
    return joined.select(
        "batch", "total", "with_errors", "silver_batch", "read", "filtered", "written", "issues", "added_columns", "status"
    )


# Orders of even years arrive first; then those of odd years, with finished orders of even years once more.
@query("bronze_stream", duck.cte(
    o=FEED,
    r=f"SELECT *, {orders.HASH} AS hash FROM o",
    a="""SELECT *, 0 AS turn FROM r WHERE batch_no % 2 = 0
        UNION ALL SELECT *, 1 FROM r WHERE batch_no % 2 = 1 OR status = 'F'""",
) + """
SELECT order_id, customer_id, order_date, total_amount, cast(turn AS bigint) AS turn,
    turn = 1 AND hash IN (SELECT hash FROM a WHERE turn = 0) AS is_duplicate
FROM a""")
def bronze_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files as they arrive, by a stream that is run after each arrival and once more."""
    root = derive.new_folder(spark, "stream")
    feed = orders.messy(spark, sf_dir)
    even = F.col("batch_no") % 2 == 0
    options = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "emptyValue": ""}
    for arrived in (even, ~even | (F.col("status") == "F")):
        feed.filter(arrived).select(*CONTRACT.columns).write.options(**options).mode("append").csv(f"{root}/landing")
        ingest_available(spark, CONTRACT, f"{root}/landing", f"{root}/bronze", f"{root}/checkpoint", as_of=AS_OF).awaitTermination()
    ingest_available(spark, CONTRACT, f"{root}/landing", f"{root}/bronze", f"{root}/checkpoint", as_of=AS_OF).awaitTermination()
    rows = lake.read_table(spark, f"{root}/bronze", CONTRACT.bronze_schema)
    turn = F.substring_index(lake.BATCH, "-", -1).cast("bigint")
    return rows.select("order_id", "customer_id", "order_date", "total_amount", turn.alias("turn"), F.col("_dq_is_duplicate").alias("is_duplicate"))


@query("customers_end_to_end", duck.cte(c=customers.BASE, f=f"SELECT k, {', '.join(f"nullif({c}, '') AS {c}" for c in CUSTOMERS.columns)} FROM c",
    v=f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY k % 2 DESC) AS n FROM f WHERE {customers.VALID}) WHERE n = 1""",
    s=customers.CLEAN.replace("SOURCE", "v"),
) + f"SELECT customer_id, {customers.CLEAN_OUT}, CASE WHEN k % 2 = 0 THEN 'b0' ELSE 'b1' END AS source_batch FROM s", optional=["is_active"])
def customers_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers from two landing paths to a silver table by day, as a stream over the bronze batches."""
    root = derive.new_folder(spark, "customers")
    feed = customers.messy(spark, sf_dir)
    options = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "emptyValue": ""}
    for number in range(2):
        feed.filter(F.col("k") % 2 == number).select(*CUSTOMERS.columns).write.options(**options).csv(f"{root}/landing/{number}")
        ingest(spark, CUSTOMERS, f"{root}/landing/{number}", f"{root}/bronze", batch_id=f"b{number}", as_of=AS_OF)
        refine_available(spark, "customers", f"{root}/bronze", f"{root}/silver", f"{root}/checkpoint", as_of=AS_OF).awaitTermination()
    rows = lake.read_table(spark, f"{root}/silver")
    shown = ("customer_id", "first_name", "last_name", "email", "email_valid", "phone", "registration_date", "registration_date_parsed",
             "customer_segment", "is_active", "lifetime_value")
    return plain(rows.select(*shown, F.col("_silver_source_batch_id").alias("source_batch")))
