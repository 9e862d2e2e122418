"""Messy feeds derived from the clean tables.

The texts are plain SQL that Spark and DuckDB both run: only integer and string
arithmetic on the keys, so both engines see the same input rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents"]


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def run(spark: SparkSession, sf_dir: str, sql: str, *, spread: bool = False) -> DataFrame:
    """``spread``: deal the rows of tables with few row groups over all cores before the SQL makes its texts."""
    used = [t for t in TABLES if "{" + t + "}" in sql]
    tables = {t: load(spark, sf_dir, t) for t in used}
    cores = spark.sparkContext.defaultParallelism
    if spread:
        tables = {t: df.repartition(cores) if df.rdd.getNumPartitions() < cores else df for t, df in tables.items()}
    return spark.sql(sql, **tables)


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder in the session's shared folder (its warehouse if none is named) that goes when the driver ends."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


#: Bytes of a method that HotSpot compiles; it interprets longer ones.
COMPILED = 8_000


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Let Spark split generated code that the JVM would only interpret: the SQL of a feed makes methods of twice that size."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(COMPILED, int(before))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def landed(
    spark: SparkSession, sf_dir: str, name: str, make: str | Callable[[SparkSession, str], DataFrame]
) -> DataFrame:
    """A derived feed, given by SQL or a function, written as the query that needs it runs.

    A feed arrives as files. Without this step the queries would spend their time in the SQL that makes the messy texts,
    which the optimizer repeats wherever a text is used.
    """
    path = new_folder(spark, f"landed/{name}")
    with compiled_methods(spark):
        rows = run(spark, sf_dir, make, spread=True) if isinstance(make, str) else make(spark, sf_dir)
        rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def duck(sql: str) -> str:
    for table in TABLES:
        sql = sql.replace("{" + table + "}", table)
    return sql


def pad(expr: str, width: int) -> str:
    return f"lpad(cast({expr} as string), {width}, '0')"


def money(cents: str) -> str:
    """Text such as ``12.05`` from a whole number of cents >= 0."""
    return f"(cast(cast(floor(({cents}) / 100) as bigint) as string) || '.' || {pad(f'({cents}) % 100', 2)})"


def clock(key: str) -> str:
    return f"{pad(f'{key} * 7 % 24', 2)} || ':' || {pad(f'{key} * 11 % 60', 2)} || ':' || {pad(f'{key} * 13 % 60', 2)}"


def ymd(d: str, sep: str = "-") -> str:
    return f"{pad(f'year({d})', 4)} || '{sep}' || {pad(f'month({d})', 2)} || '{sep}' || {pad(f'day({d})', 2)}"


def mdy(d: str) -> str:
    return f"{pad(f'month({d})', 2)} || '/' || {pad(f'day({d})', 2)} || '/' || {pad(f'year({d})', 4)}"


def dmy(d: str) -> str:
    return f"{pad(f'day({d})', 2)} || '-' || {pad(f'month({d})', 2)} || '-' || {pad(f'year({d})', 4)}"


def messy_time(pick: str) -> str:
    """The layouts of the order feed: ISO, month first, day first, with T; some unreadable."""
    return f"""CASE WHEN {pick} % 71 = 9 THEN 'soon'
        WHEN {pick} % 79 = 11 THEN NULL
        WHEN {pick} % 5 = 0 THEN {ymd('d')} || ' ' || {clock('k')}
        WHEN {pick} % 5 = 1 THEN {mdy('d')} || ' ' || substr({clock('k')}, 1, 5)
        WHEN {pick} % 5 = 2 THEN {dmy('d')} || ' ' || {clock('k')}
        WHEN {pick} % 5 = 3 THEN {ymd('d')} || 'T' || {clock('k')}
        ELSE {mdy('d')} || ' ' || {clock('k')} END"""


ORDERS = f"""
SELECT
    k, status, batch_no,
    CASE WHEN k % 89 = 3 THEN '   ' WHEN k % 97 = 5 THEN NULL ELSE 'ORD' || {pad('k', 12)} END AS order_id,
    CASE WHEN k % 83 = 7 THEN '' ELSE 'CUST' || {pad('cust', 10)} END AS customer_id,
    {messy_time('k')} AS order_date,
    {money('cents')} AS subtotal,
    CASE WHEN k % 73 = 4 THEN 'n/a' ELSE {money('cents % 10000')} END AS tax_amount,
    CASE WHEN k % 10 < 3 THEN {money('cents % 5000')} ELSE '0' END AS discount_amount,
    CASE WHEN k % 100 = 1 THEN '-' || {money('cents')}
        WHEN k % 61 = 2 THEN 'abc'
        WHEN k % 67 = 3 THEN ''
        WHEN k % 10 = 9 THEN {money('cents + 500')}
        ELSE {money('cents + cents % 10000 - CASE WHEN k % 10 < 3 THEN cents % 5000 ELSE 0 END')} END AS total_amount,
    CASE k % 15 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'CREDIT_CARD'
        WHEN 3 THEN 'debit_card' WHEN 4 THEN 'paypal' WHEN 5 THEN 'PayPal' WHEN 6 THEN ' CC '
        WHEN 7 THEN 'gift_card' WHEN 8 THEN 'cod' WHEN 9 THEN 'Cash on Delivery' WHEN 10 THEN ''
        WHEN 11 THEN 'Pay Pal' WHEN 12 THEN 'bitcoin' WHEN 13 THEN 'GiftCard' ELSE NULL END AS payment_method,
    {messy_time('(k + 1)')} AS created_at
FROM (
    SELECT o_orderkey AS k, o_custkey AS cust, o_orderdate AS d, o_orderstatus AS status,
        year(o_orderdate) AS batch_no, cast(round(o_totalprice * 100) AS bigint) AS cents
    FROM {{orders}}
) base"""

CUSTOMERS = f"""
SELECT
    k,
    CASE WHEN k % 101 = 4 THEN '  ' ELSE 'CUST' || {pad('k', 10)} END AS customer_id,
    CASE k % 8 WHEN 0 THEN 'anna' WHEN 1 THEN 'BERT' WHEN 2 THEN 'Testina' WHEN 3 THEN 'examplesample'
        WHEN 4 THEN '' WHEN 5 THEN NULL WHEN 6 THEN 'cLEO' ELSE '  ' END AS first_name,
    CASE k % 7 WHEN 0 THEN 'MILLER' WHEN 1 THEN 'o''neil' WHEN 2 THEN NULL WHEN 3 THEN 'Lastname'
        WHEN 4 THEN 'smith' WHEN 5 THEN '' ELSE 'jean-luc' END AS last_name,
    CASE WHEN k % 10 = 0 THEN NULL WHEN k % 17 = 2 THEN 'a@b' WHEN k % 19 = 3 THEN '  ' WHEN k % 23 = 4 THEN ''
        ELSE 'User.' || cast(k AS string) || '@Mail' || cast(k % 7 AS string) || '.org' END AS email,
    CASE k % 6 WHEN 0 THEN NULL WHEN 1 THEN '12' WHEN 2 THEN '+1 (' || {pad('k % 1000', 3)} || ') 555-' || {pad('k % 10000', 4)}
        WHEN 3 THEN '001-555-' || {pad('k % 1000', 3)} || '-' || {pad('k % 10000', 4)} || 'x12'
        WHEN 4 THEN '555.' || {pad('k % 1000', 3)} || '.' || {pad('k % 10000', 4)} ELSE '' END AS phone,
    CASE WHEN k % 31 = 1 THEN '2031-01-15' WHEN k % 29 = 2 THEN '13/45/2024' WHEN k % 37 = 3 THEN NULL
        WHEN k % 5 = 0 THEN {pad('y', 4)} || '-' || {pad('m', 2)} || '-' || {pad('dd', 2)}
        WHEN k % 5 = 1 THEN {pad('m', 2)} || '/' || {pad('dd', 2)} || '/' || {pad('y', 4)}
        WHEN k % 5 = 2 THEN {pad('dd', 2)} || '-' || {pad('m', 2)} || '-' || {pad('y', 4)}
        WHEN k % 5 = 3 THEN {pad('y', 4)} || '-' || {pad('m', 2)} || '-' || {pad('dd', 2)} || 'T10:20:30'
        ELSE cast(y AS string) || '-' || cast(m AS string) || '-' || cast(dd AS string) END AS registration_date,
    CASE k % 9 WHEN 0 THEN 'Premium' WHEN 1 THEN 'BASIC' WHEN 2 THEN 'vip' WHEN 3 THEN 'standard' WHEN 4 THEN 'gold'
        WHEN 5 THEN '' WHEN 6 THEN NULL WHEN 7 THEN ' VIP ' ELSE 'Standard' END AS customer_segment,
    CASE k % 11 WHEN 0 THEN 'true' WHEN 1 THEN 'False' WHEN 2 THEN 'Y' WHEN 3 THEN 'n' WHEN 4 THEN '1' WHEN 5 THEN '0'
        WHEN 6 THEN ' yes ' WHEN 7 THEN 'No' WHEN 8 THEN 'maybe' WHEN 9 THEN NULL ELSE '' END AS is_active,
    CASE WHEN k % 41 = 1 THEN '1_000' WHEN k % 43 = 2 THEN 'nan' WHEN k % 47 = 3 THEN '' WHEN k % 53 = 4 THEN NULL
        WHEN cents < 0 THEN '-' || {money('0 - cents')} ELSE {money('cents')} END AS lifetime_value
FROM (
    SELECT c_custkey AS k, cast(round(c_acctbal * 100) AS bigint) AS cents,
        2018 + c_custkey % 7 AS y, 1 + c_custkey % 12 AS m, 1 + c_custkey % 28 AS dd
    FROM {{customer}}
) base"""

ITEMS = f"""
SELECT
    k, line_no, ingested, batch_no,
    CASE WHEN (k + line_no) % 103 = 1 THEN '  ' WHEN (k + line_no) % 107 = 2 THEN NULL
        ELSE 'ITM' || {pad('k', 12)} || '-' || cast(n AS string) END AS item_id,
    CASE WHEN part % 109 = 3 THEN '' ELSE 'ORD' || {pad('k', 12)} END AS order_id,
    CASE WHEN part % 113 = 4 THEN NULL ELSE 'PROD' || {pad('part', 10)} END AS product_id,
    CASE part % 4 WHEN 0 THEN 'Part_' || cast(part AS string) WHEN 1 THEN upper('part_' || cast(part AS string))
        WHEN 2 THEN ' part_' || cast(part AS string) || ' ' ELSE NULL END AS product_name,
    CASE part % 14 WHEN 0 THEN 'Electronics' WHEN 1 THEN 'electronics' WHEN 2 THEN 'ELECTRONICS' WHEN 3 THEN 'Clothing'
        WHEN 4 THEN 'Home & Garden' WHEN 5 THEN 'Books' WHEN 6 THEN 'Sports' WHEN 7 THEN 'Toys' WHEN 8 THEN ''
        WHEN 9 THEN NULL WHEN 10 THEN ' apparel ' WHEN 11 THEN 'tech' WHEN 12 THEN 'Garden' ELSE 'MUSIC' END AS category,
    CASE WHEN line_no % 127 = 5 THEN 'many' WHEN line_no % 131 = 6 THEN '-' || cast(qty AS string)
        WHEN line_no % 137 = 7 THEN '' WHEN line_no % 139 = 8 THEN cast(qty AS string) || '.0' WHEN line_no % 149 = 9 THEN '0'
        ELSE cast(qty AS string) END AS quantity,
    CASE WHEN line_no % 151 = 1 THEN '1_000' WHEN line_no % 157 = 2 THEN '-' || {money('unit_cents')}
        WHEN line_no % 163 = 3 THEN NULL ELSE {money('unit_cents')} END AS unit_price,
    CASE WHEN line_no % 167 = 1 THEN 'nan' WHEN line_no % 173 = 2 THEN '-' || {money('cents')}
        WHEN line_no % 7 = 3 THEN {money('unit_cents * qty')} ELSE {money('cents')} END AS line_total,
    CASE WHEN part % 20 = 7 THEN NULL ELSE ' sku-' || cast(10000 + part AS string) || ' ' END AS sku
FROM (
    SELECT l_orderkey AS k, l_linenumber AS n, l_partkey AS part, l_shipdate AS ingested, year(l_shipdate) AS batch_no,
        l_partkey * 100000 + l_suppkey AS line_no, cast(l_quantity AS int) AS qty,
        cast(round(l_extendedprice * 100) AS bigint) AS cents,
        cast(floor(round(l_extendedprice * 100) / l_quantity) AS bigint) AS unit_cents
    FROM {{lineitem}}
) base"""
