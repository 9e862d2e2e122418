"""Queries across batches: duplicates, unseen batches, record hashes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.contracts import ORDERS as CONTRACT
from lakemill.functions import numbers
from lakemill.functions.hashing import record_hash
from lakemill.operators.dedup import newest_per_key
from lakemill.operators.duplicates import HASH, mark_duplicates, with_landing_hash
from lakemill.functions.dates import parse_timestamp
from lakemill.sources import lake
from lakemill.sources.hash_index import HashIndex
from workloads import derive, duck, orders
from workloads.shape import Checks

CHECKS = Checks()
query = CHECKS.query
BASE = orders.BASE


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order ingested by the batch of its year, and finished ones again a year later."""
    hashed = with_landing_hash(orders.messy(spark, sf_dir).select(*CONTRACT.columns, F.col("batch_no").alias("_year"),
                                                                   F.col("status").alias("_status")))
    later = hashed.filter(F.col("_status") == "F").withColumn("_year", F.col("_year") + 1)
    return hashed.unionByName(later).select(
        "_bronze_record_hash",
        F.make_timestamp("_year", F.lit(12), F.lit(31), F.lit(0), F.lit(0), F.lit(0)).alias("_bronze_ingestion_timestamp"),
        F.concat(F.lit("batch-"), "_year").alias("_bronze_ingestion_batch_id"),
    )


def _incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same orders, paid ones corrected to PayPal, pending ones delivered twice."""
    rows = orders.messy(spark, sf_dir)
    changed = rows.withColumn(
        "payment_method", F.when(F.col("status") == "O", F.lit("PayPal")).otherwise(F.col("payment_method"))
    )
    copies = F.when(F.col("status") == "P", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return changed.withColumn("_copy", F.explode(copies)).select(
        *CONTRACT.columns, F.col("k").alias("_k"), (F.col("k") * 2 + F.col("_copy")).alias("_line")
    )


@query("cross_batch_duplicates", duck.cte(
    o=BASE,
    h=f"""SELECT {orders.HASH} AS hash, batch_no AS y FROM o
        UNION ALL SELECT {orders.HASH}, batch_no + 1 FROM o WHERE status = 'F'""",
    first="SELECT hash, min(y) AS y FROM h GROUP BY hash",
    n=f"""SELECT k, k * 2 + copy AS line, {orders.HASH} AS hash FROM (
            SELECT * REPLACE (CASE WHEN status = 'O' THEN 'PayPal' ELSE payment_method END AS payment_method) FROM o) x
        JOIN (SELECT 1 AS copy UNION ALL SELECT 2) c ON c.copy = 1 OR x.status = 'P'""",
    counted="SELECT hash, count(*) AS copies FROM n GROUP BY hash",
) + """
SELECT n.k, n.line, n.hash, first.y IS NOT NULL AS is_duplicate, 'batch-' || cast(first.y AS string) AS duplicate_of,
    counted.copies > 1 AS dup_in_batch
FROM n JOIN counted ON counted.hash = n.hash LEFT JOIN first ON first.hash = n.hash""")
def cross_batch_duplicates(spark, sf_dir):
    root = derive.new_folder(spark, "duplicates")
    index = HashIndex(spark, f"{root}/hashes")
    index.rebuild(_history(spark, sf_dir))
    incoming = with_landing_hash(_incoming(spark, sf_dir))
    seen = index.first_seen(incoming.select(HASH).distinct(), f"{root}/probe")
    marked = mark_duplicates(incoming, seen, salt_by="_line", within_batch=True)
    return marked.select(
        F.col("_k").alias("k"),
        F.col("_line").alias("line"),
        F.col("_bronze_record_hash").alias("hash"),
        F.col("_dq_is_duplicate").alias("is_duplicate"),
        F.col("_dq_duplicate_of_batch").alias("duplicate_of"),
        F.col("_dq_dup_in_batch").alias("dup_in_batch"),
    )


@query("unseen_batches", duck.cte(o=BASE) + """
SELECT k, 'batch-' || cast(batch_no AS string) AS batch FROM o
WHERE batch_no NOT IN (SELECT batch_no FROM o WHERE status = 'F' AND customer_id LIKE '%00' AND order_id LIKE '%7')""")
def unseen_batches(spark, sf_dir):
    """A bronze table of one batch per year, with manifest and ledger; the rows of the batches that the ledger lacks."""
    root = derive.new_folder(spark, "unseen")
    batch = F.concat(F.lit("batch-"), "batch_no").alias(lake.BATCH)
    rows = orders.messy(spark, sf_dir).select(
        "k", "status", "customer_id", "order_id", F.make_timestamp("batch_no", *[F.lit(n) for n in (12, 31, 0, 0, 0)]).alias(lake.INGESTED_AT),
        batch,
    )
    rows.write.partitionBy(lake.BATCH).parquet(f"{root}/bronze")
    lake.make_manifest(spark, f"{root}/bronze", rows.schema)
    bronze = lake.read_table(spark, f"{root}/bronze", rows.schema)
    done = bronze.filter((F.col("status") == "F") & F.col("customer_id").endswith("00") & F.col("order_id").endswith("7"))
    notes = lake.noted_batches(spark, f"{root}/bronze")
    read = notes.join(done.select(F.col(lake.BATCH).alias("bronze_batch")).distinct(), "bronze_batch", "left_semi")
    versions = {r["bronze_batch"]: r["version"] for r in read.collect()}
    if versions:
        lake.record_batches(spark, f"{root}/silver", versions, "s1")
    ids = [r["bronze_batch"] for r in lake.pending_batches(spark, f"{root}/bronze", f"{root}/silver").collect()]
    return bronze.filter(F.col(lake.BATCH).isin(ids)).select("k", F.col(lake.BATCH).alias("batch"))


@query("record_hash", duck.cte(o=BASE, t=f"""
    SELECT k, order_id, customer_id, cast({duck.amount('subtotal')} AS decimal(10,2)) AS subtotal, payment_method FROM o""") + """
SELECT k, md5(concat_ws('|', """ + ", ".join(
    f"coalesce(cast(length(cast({c} AS varchar)) AS varchar) || ':' || cast({c} AS varchar), '-')"
    for c in ["order_id", "customer_id", "subtotal", "payment_method"]
) + ")) AS record_hash FROM t")
def hashes(spark, sf_dir):
    typed = orders.messy(spark, sf_dir).withColumn("subtotal", numbers.amount(F.col("subtotal")))
    return typed.select("k", record_hash(["order_id", "customer_id", "subtotal", "payment_method"]).alias("record_hash"))


@query("dedup_orders", duck.cte(
    o=BASE,
    b=f"""SELECT order_id, k, 1 AS part, {duck.month_first('created_at')} AS created FROM o
        UNION ALL SELECT order_id, k, 2, {duck.month_first('order_date')} FROM o""",
) + """
SELECT order_id, k, part FROM b
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY created DESC NULLS LAST, part DESC, k DESC) = 1""")
def dedup_orders(spark, sf_dir):
    rows = orders.messy(spark, sf_dir)
    first = rows.select("order_id", "k", F.lit(1).alias("part"), parse_timestamp(F.col("created_at")).alias("created"))
    second = rows.select("order_id", "k", F.lit(2).alias("part"), parse_timestamp(F.col("order_date")).alias("created"))
    ties = [F.col("part").desc(), F.col("k").desc()]
    return newest_per_key(first.unionByName(second), "order_id", "created", ties).select("order_id", "k", "part")
