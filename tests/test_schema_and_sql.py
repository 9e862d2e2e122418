"""Schema versions, SQL functions, the landing stream, mixed JSON numbers and issues from rules."""

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from lakemill.contracts import ORDERS
from lakemill.functions import sql, text
from lakemill.operators.audit import AuditLog, issues_from_bronze, issues_from_rows
from lakemill.operators.quality import validate
from lakemill.operators.schema_history import columns_after, schema_changes
from lakemill.plans.bronze import ingest
from lakemill.sources import lake
from lakemill.sources.clickstream import parse_mixed
from lakemill.streaming.landing import ingest_available
from tests.test_layers import ORDER_ROWS, write_csv

AS_OF = date(2025, 1, 1)


def test_versions_follow_the_column_set(spark):
    day = [datetime(2024, 1, d) for d in range(1, 6)]
    sets = [("b1", ["x", "y"]), ("b2", ["y", "z"]), ("b3", ["z", "y"]), ("b4", ["x", "y"]), ("b5", [])]
    rows = [("t", "bronze", name, at, columns) for (name, columns), at in zip(sets, day, strict=True)]
    df = spark.createDataFrame(rows, "table_name string, layer string, batch_id string, detected_at timestamp, columns array<string>")
    changes = schema_changes(df, ["x", "y"])
    got = sorted((r["batch_id"], r["schema_version"], r["change_type"], tuple(r["columns"])) for r in changes.collect())
    assert got == [
        ("b2", "1.1", "COLUMN_ADDED", ("z",)), ("b2", "1.1", "COLUMN_REMOVED", ("x",)),
        ("b4", "1.2", "COLUMN_ADDED", ("x",)), ("b4", "1.2", "COLUMN_REMOVED", ("z",)), ("b5", "1.3", "COLUMN_REMOVED", ("x", "y"))]
    assert changes.select("schema_id").distinct().count() == 5
    after = {r["batch_id"]: r["columns"] for r in columns_after(changes, df.drop("columns"), ["x", "y"]).collect()}
    assert after == {name: sorted(columns) for name, columns in sets}


def test_logged_versions_and_repeated_batches(spark, tmp_path):
    audit = AuditLog(spark, str(tmp_path / "audit"))
    log = lambda batch, columns, hour: audit.log_schema_changes(
        "t", "bronze", columns, start=["x", "y"], batch_id=batch, at=datetime(2024, 1, 1, hour))
    assert [log("b1", ["x", "y"], 1), log("b2", ["x", "y", "z"], 2), log("b3", ["x", "y", "z"], 3)] == ["1.0", "1.1", "1.1"]
    assert log("b2", ["x", "y", "z"], 4) == "1.1"  # run again: the same change under the same id
    assert log("b4", ["y"], 5) == "1.2"
    rows = audit.table("schema_history").dropDuplicates(["schema_id"]).orderBy("schema_version", "change_type").collect()
    assert [(r["batch_id"], r["schema_version"], r["change_detail"]) for r in rows] == [
        ("b2", "1.1", '{"columns": ["z"]}'), ("b4", "1.2", '{"columns": ["x", "z"]}')]


def test_sql_functions_equal_the_column_functions(spark):
    values = [None, "", "  ", " CC ", "Pay Pal", "bitcoin", "Home & Garden", "tech", "VIP", "yes", "0", "a@b.org", "a@b", "+1 (555) 010-2030 x9",
              "12", "o'neil \\ x"]
    df = spark.createDataFrame([(v,) for v in values], "value string")
    names = sql.register(spark, prefix="t_")
    assert "t_payment_method" in names and "t_quality_trend" not in names
    twins = {
        "payment_method": text.payment_method, "product_category": text.category, "customer_segment": text.segment,
        "yes_no": text.yes_no, "is_blank": text.is_blank, "email_valid": text.email_valid, "us_phone": text.us_phone,
    }
    assert set(twins) == set(sql.SCALARS)
    for name, column in twins.items():
        both = spark.sql(f"SELECT value, t_{name}(value) AS one FROM {{df}}", df=df).withColumn("other", column(F.col("value")))
        assert both.where("NOT one <=> other").collect() == [], name


def test_landing_stream_ingests_each_file_once(spark, tmp_path):
    """Equal to ingest over the same groups of files; a run with nothing new adds nothing."""
    landing, bronze, checkpoint = tmp_path / "landing", str(tmp_path / "bronze"), str(tmp_path / "checkpoint")

    def stream():
        ingest_available(spark, ORDERS, str(landing), bronze, checkpoint, as_of=AS_OF).awaitTermination()

    write_csv(landing / "a b.csv", ORDERS.columns, ORDER_ROWS[:3])
    stream()
    write_csv(landing / "c.csv", [*reversed(ORDERS.columns)], [tuple(reversed(r)) for r in ORDER_ROWS[2:5]])
    write_csv(landing / "d.csv", ORDERS.columns, ORDER_ROWS[5:])
    stream()
    stream()
    write_csv(tmp_path / "one" / "a.csv", ORDERS.columns, ORDER_ROWS[:3])
    write_csv(tmp_path / "two" / "c.csv", ORDERS.columns, ORDER_ROWS[2:])
    for number, name in enumerate(("one", "two")):
        ingest(spark, ORDERS, str(tmp_path / name), str(tmp_path / "batch"), batch_id=f"b{number}", as_of=AS_OF)
    keep = [*ORDERS.columns, "_dq_is_duplicate", "_dq_error_details", "_bronze_record_hash"]

    def rows(path):
        return sorted(map(str, lake.read_table(spark, path, ORDERS.bronze_schema).select(keep).collect()))

    assert rows(bronze) == rows(str(tmp_path / "batch")) and len(rows(bronze)) == 8
    assert lake.noted_batches(spark, bronze).count() == 2


def test_mixed_numbers_keep_their_value(spark):
    lines = ['{"event_id": "1", "order": {"total_amount": 1234.5, "items_count": 2}}',
             '{"event_id": "2", "order": {"total_amount": "$1,234.50", "items_count": "2"}}',
             '{"event_id": "3", "order": {"total_amount": [7], "items_count": ["3"]}}',
             '{"event_id": "4", "order": {"total_amount": [7, 8], "items_count": {"n": 1}}}',
             '{"event_id": "5", "order": {"total_amount": "", "items_count": true}}',
             '{"event_id": "6", "order": null}', '{"event_id": "7"', "", None, "[1]"]
    rows = parse_mixed(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    got = {r["event_id"]: r for r in rows if r["event_id"]}
    assert [got[k]["order_total"] for k in "123456"] == [Decimal("1234.50"), Decimal("1234.50"), Decimal("7.00"), None, None, None]
    assert [got[k]["order_items"] for k in "1236"] == [2, 2, 3, None] and got["4"]["order_items"] is None
    assert got["1"]["mixed_types"] == [] and got["2"]["mixed_types"] == ["order_total:STRING", "order_items:STRING"]
    assert got["4"]["unread"] == {"order_total": "[7,8]", "order_items": '{"n":1}'}
    assert got["5"]["unread"]["order_total"] == '""' and got["6"]["mixed_types"] == []
    assert sorted(str(r["_corrupt_record"]) for r in rows if not r["event_id"]) == sorted(['{"event_id": "7"', "", "None", "None"])


def test_issues_from_rows_equal_those_of_the_stored_details(spark):
    rows = spark.createDataFrame([tuple(v or None for v in r) for r in ORDER_ROWS], ", ".join(f"{c} string" for c in ORDERS.columns))
    stored = validate(rows, ORDERS.rules(AS_OF)).withColumn("_bronze_raw_record", F.to_json(F.struct(*ORDERS.columns)))
    direct = issues_from_rows(rows, "order_id", ORDERS.rules(AS_OF))
    assert sorted(map(str, direct.collect())) == sorted(map(str, issues_from_bronze(stored, "order_id").collect()))
    assert direct.count() == 3 and "from_json" not in direct._jdf.queryExecution().toString()
