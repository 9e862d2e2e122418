"""Landing files to bronze to silver, with audit, repeated runs and the stream."""

import csv
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakemill.contracts import CUSTOMERS, ORDER_ITEMS, ORDERS
from lakemill.operators.audit import SCHEMAS, AuditLog
from lakemill.plans.bronze import ingest
from lakemill.plans.silver import refine
from lakemill.sources import lake
from lakemill.sources.compaction import compact, silver_rows
from lakemill.sources.landing import drift_by_header, read_landing
from lakemill.streaming.incremental import refine_available

AS_OF = date(2025, 1, 1)


def write_csv(path, columns, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(columns)
        writer.writerows(rows)
    return str(path)


ORDER_ROWS = [
    # id, customer, date, subtotal, tax, discount, total, payment, created
    ("O1", "C1", "2024-03-01 10:00:00", "100.00", "8.00", "0", "108.00", "PayPal", "2024-03-01 10:00:00"),
    ("O1", "C1", "2024-03-01 10:00:00", "100.00", "8.00", "0", "108.00", "cc", "2024-03-02 10:00:00"),
    ("O2", "C2", "03/05/2024 18:30", "50.00", "4.00", "10", "99.00", "", "03/05/2024 18:30"),
    ("O3", "C2", "2024-03-09T07:00:00", "600", "0", "0", "600", "cod", "2024-03-09T07:00:00"),
    ("O4", "", "2024-03-01 10:00:00", "1", "1", "1", "1", "cc", "2024-03-01 10:00:00"),
    ("O5", "C3", "2024-03-01 10:00:00", "abc", "1", "1", "1", "cc", "2024-03-01 10:00:00"),
    ("O6", "C3", "2024-03-01 10:00:00", "1", "1", "1", "-1", "cc", "2024-03-01 10:00:00"),
]
ITEM_ROWS = [
    ("I1", "O1", "P1", "Lamp", "home", "2", "3.50", "7.00", "sku-1"),
    ("I2", "O1", "P2", "BOOK", "Book", "1", "1.25", "9.99", "sku-2"),
    ("I3", "O9", "P1", "lamp", "", "1", "2.00", "2.00", None),
    ("I4", "O3", "P1", "lamp", None, "-1", "2.00", "-2.00", "s"),
    ("I5", "O3", None, "lamp", None, "1", "2.00", "2.00", "s"),
    ("I6", "O3", "P3", "free", "toys", "1", "0", "0", "s"),
]


@pytest.fixture
def paths(tmp_path):
    return {name: str(tmp_path / name) for name in
            ("bronze_orders", "silver_orders", "bronze_items", "silver_items", "audit", "checkpoint")}


def test_orders_end_to_end(spark, tmp_path, paths):
    source = write_csv(tmp_path / "in" / "orders.csv", ORDERS.columns, ORDER_ROWS)
    audit = AuditLog(spark, paths["audit"])
    stats = ingest(spark, ORDERS, source, paths["bronze_orders"], batch_id="b1", as_of=AS_OF, audit=audit)
    assert (stats.records_total, stats.records_with_errors, stats.records_duplicate) == (7, 3, 0)
    assert not stats.schema_changes["has_changes"]
    assert not (tmp_path / "bronze_orders_staging" / "b1").exists()

    bronze = lake.read_table(spark, paths["bronze_orders"], ORDERS.bronze_schema)
    lines = bronze.orderBy("_bronze_source_line_number").collect()
    assert [r["_bronze_source_line_number"] for r in lines] == list(range(1, 8))
    assert lines[0]["_bronze_raw_record"].startswith('{"order_id":"O1","customer_id":"C1"')
    assert lines[4]["_dq_error_details"] == '["MISSING_REQUIRED_FIELD:customer_id"]'
    assert lines[0]["_dq_completeness_score"] == Decimal("100.00")

    first = refine(spark, "orders", paths["bronze_orders"], paths["silver_orders"], batch_id="s1", as_of=AS_OF, audit=audit)
    assert (first.records_input, first.records_filtered, first.records_deduplicated, first.records_output) == (7, 3, 1, 3)
    rows = {r["order_id"]: r for r in lake.read_table(spark, paths["silver_orders"]).collect()}
    assert rows["O1"]["payment_method"] == "credit_card"
    assert rows["O2"]["total_amount"] == Decimal("44.00")
    assert rows["O2"]["order_date"] == datetime(2024, 3, 5, 18, 30)
    assert (rows["O2"]["order_time_period"], rows["O3"]["is_weekend"]) == ("Evening", True)
    assert rows["O1"]["_silver_source_batch_id"] == "b1"

    again = refine(spark, "orders", paths["bronze_orders"], paths["silver_orders"], batch_id="s2", as_of=AS_OF)
    assert (again.records_input, again.records_output, again.batches) == (0, 0, ())

    repeated = refine(
        spark, "orders", paths["bronze_orders"], paths["silver_orders"], batch_id="s1", as_of=AS_OF, bronze_batch_id="b1"
    )
    assert repeated.records_output == 3
    assert lake.read_table(spark, paths["silver_orders"]).count() == 3

    # Second batch: one known record, one new; ingesting it twice stores it once.
    later = write_csv(tmp_path / "in2" / "orders.csv", ORDERS.columns, [ORDER_ROWS[0], ("O7", *ORDER_ROWS[3][1:])])
    for min_hot_rows in (1_000_000, 1):
        stats = ingest(
            spark, ORDERS, later, paths["bronze_orders"], batch_id="b2", as_of=AS_OF, min_hot_rows=min_hot_rows
        )
        assert (stats.records_total, stats.records_duplicate) == (2, 1)
    stored = lake.read_table(spark, paths["bronze_orders"], ORDERS.bronze_schema)
    assert stored.count() == 9
    duplicate = stored.filter("_dq_is_duplicate").first()
    assert (duplicate["order_id"], duplicate["_dq_duplicate_of_batch"]) == ("O1", "b1")
    second = refine(spark, "orders", paths["bronze_orders"], paths["silver_orders"], batch_id="s2", as_of=AS_OF)
    assert (second.batches, second.records_output) == (("b2",), 2)

    # Audit of the first batch.
    assert audit.table("data_quality_issues").count() == 3
    row = audit.batch_summary("b1").first()
    assert (row["records_total"], row["silver_batch_id"], row["records_output"], row["gold_batch_id"]) == (7, "s1", 3, None)
    trend = audit.quality_trend("orders", date.today()).collect()
    assert [r["records_with_errors"] for r in trend] == [3]
    categories = {r["error_type"]: r["error_category"] for r in audit.table("data_quality_issues").collect()}
    assert categories == {"MISSING_REQUIRED_FIELD": "MISSING", "INVALID_NUMERIC": "INVALID", "NEGATIVE_AMOUNT": "RANGE"}


def test_one_run_over_two_batches_logs_each(spark, tmp_path, paths):
    for batch, rows in [("b1", ORDER_ROWS), ("b2", [("O7", *ORDER_ROWS[3][1:]), ORDER_ROWS[4]])]:
        source = write_csv(tmp_path / batch / "orders.csv", ORDERS.columns, rows)
        ingest(spark, ORDERS, source, paths["bronze_orders"], batch_id=batch, as_of=AS_OF)
    audit = AuditLog(spark, paths["audit"])
    stats = refine(
        spark, "orders", paths["bronze_orders"], paths["silver_orders"], batch_id="s1", as_of=AS_OF, audit=audit
    )
    assert (stats.batches, stats.records_input, stats.records_output) == (("b1", "b2"), 9, 4)
    logged = {r["source_batch_id"]: r for r in audit.table("silver_batch_log").collect()}
    assert [(logged[b]["records_input"], logged[b]["records_filtered"], logged[b]["records_output"]) for b in ("b1", "b2")] == [
        (7, 3, 3), (2, 1, 1)]


def test_same_rows_same_hash_on_another_day(spark, tmp_path, paths):
    source = write_csv(tmp_path / "in" / "orders.csv", ORDERS.columns, ORDER_ROWS)
    ingest(spark, ORDERS, source, paths["bronze_orders"], batch_id="b1", as_of=AS_OF)
    hashes = []
    for day, target in [(date(2025, 1, 1), "one"), (date(2025, 6, 1), "two")]:
        path = str(tmp_path / target)
        refine(spark, "orders", paths["bronze_orders"], path, batch_id=target, as_of=day, bronze_batch_id="b1")
        hashes.append(sorted(r[0] for r in lake.read_table(spark, path).select("_silver_record_hash").collect()))
    assert hashes[0] == hashes[1] and len(set(hashes[0])) == 3


def test_items_end_to_end(spark, tmp_path, paths):
    orders = write_csv(tmp_path / "in" / "orders.csv", ORDERS.columns, ORDER_ROWS)
    items = write_csv(tmp_path / "in" / "items.csv", ORDER_ITEMS.columns, ITEM_ROWS)
    ingest(spark, ORDERS, orders, paths["bronze_orders"], batch_id="b1", as_of=AS_OF)
    refine(spark, "orders", paths["bronze_orders"], paths["silver_orders"], batch_id="s1", as_of=AS_OF)
    ingest(spark, ORDER_ITEMS, items, paths["bronze_items"], batch_id="b1", as_of=AS_OF)
    results = []
    for name, min_hot_rows in [("plain", 1_000_000), ("spread", 1)]:
        path = str(tmp_path / name)
        stats = refine(
            spark, "order_items", paths["bronze_items"], path, batch_id=name, as_of=AS_OF,
            orders_path=paths["silver_orders"], min_hot_rows=min_hot_rows,
        )
        assert (stats.records_filtered, stats.records_output) == (2, 4)
        rows = lake.read_table(spark, path).drop("_silver_batch_id", "_silver_processing_timestamp")
        results.append(sorted(map(str, rows.select(*sorted(rows.columns)).collect())))
    assert results[0] == results[1]
    rows = {r["item_id"]: r for r in lake.read_table(spark, str(tmp_path / "plain")).collect()}
    assert (rows["I1"]["item_pct_of_order"], rows["I2"]["item_pct_of_order"]) == (Decimal("84.85"), Decimal("15.15"))
    assert (rows["I2"]["line_total"], rows["I2"]["item_rank_in_order"]) == (Decimal("1.25"), 2)
    assert [rows[k]["has_valid_order"] for k in ("I1", "I3", "I6")] == [True, False, True]
    assert rows["I6"]["item_pct_of_order"] == Decimal("0.00")


def test_customers_with_drift(spark, tmp_path, paths):
    columns = ["customer_id", "first_name", "last_name", "email", "phone", "effective_date", "customer_segment",
               "is_active", "lifetime_value"]
    source = write_csv(tmp_path / "in" / "c.csv", columns, [
        ("C1", "ANNA", "lee", "anna@mail.org", "555 123 4567 8", "2024-01-01", "VIP", "Y", "6000"),
        ("C2", "bo", "", "", "", "01/02/2024", "", "0", "-5"),
    ])
    audit = AuditLog(spark, paths["audit"])
    stats = ingest(spark, CUSTOMERS, source, str(tmp_path / "bronze"), batch_id="b1", as_of=AS_OF, audit=audit)
    assert stats.schema_changes["new_columns"] == ["effective_date"]
    assert stats.schema_changes["missing_columns"] == ["registration_date"]
    changes = {r["change_type"]: r["change_detail"] for r in audit.table("schema_history").collect()}
    assert changes == {"COLUMN_ADDED": '{"columns": ["effective_date"]}', "COLUMN_REMOVED": '{"columns": ["registration_date"]}'}
    bronze = lake.read_table(spark, str(tmp_path / "bronze"), CUSTOMERS.bronze_schema).orderBy("customer_id").collect()
    assert [r["_extra_fields"] for r in bronze] == ['{"effective_date":"2024-01-01"}', '{"effective_date":"01/02/2024"}']
    refine(spark, "customers", str(tmp_path / "bronze"), str(tmp_path / "silver"), batch_id="s1", as_of=AS_OF)
    row = lake.read_table(spark, str(tmp_path / "silver")).first()
    assert (row["full_name"], row["customer_tier"], row["email_domain"], row["phone"]) == (
        "Anna Lee", "platinum", "mail.org", "(551) 234-5678")


def test_empty_batch(spark, tmp_path, paths):
    first = write_csv(tmp_path / "in" / "orders.csv", ORDERS.columns, ORDER_ROWS)
    empty = write_csv(tmp_path / "none" / "orders.csv", ORDERS.columns, [])
    ingest(spark, ORDERS, first, paths["bronze_orders"], batch_id="b1", as_of=AS_OF)
    stats = ingest(spark, ORDERS, empty, paths["bronze_orders"], batch_id="b2", as_of=AS_OF)
    assert (stats.records_total, stats.records_duplicate, stats.data_quality_score) == (0, 0, 0.0)
    done = refine(
        spark, "orders", paths["bronze_orders"], paths["silver_orders"], batch_id="s", as_of=AS_OF, bronze_batch_id="b2"
    )
    assert (done.records_input, done.records_output, done.data_quality_score) == (0, 0, 0.0)


def test_headers_differ_in_one_path(spark, tmp_path):
    """Files with other columns, in another order, without rows or without any line: nothing is shifted."""
    write_csv(tmp_path / "in" / "a.csv", ["x", "y"], [("1", "2")] * 3)
    write_csv(tmp_path / "in" / "b c.csv", ["y", "x"], [("2", "1")])
    write_csv(tmp_path / "in" / "c.csv", ["x", "z, with comma"], [("1", "5")])
    write_csv(tmp_path / "in" / "d.csv", ["x", "y"], [])
    (tmp_path / "in" / "e.csv").write_text("")
    rows, found = read_landing(spark, str(tmp_path / "in"), files=True)
    got = sorted((r["_file"].rsplit("/", 1)[1], r["x"], r["y"], r["z, with comma"]) for r in rows.collect())
    assert got == [("a.csv", "1", "2", None)] * 3 + [("b%20c.csv", "1", "2", None), ("c.csv", "1", None, "5")]
    assert sorted((h.columns, len(h.files)) for h in found) == [(("x", "y"), 2), (("x", "z, with comma"), 1), (("y", "x"), 1)]
    drift = drift_by_header(found, ["x", "y"])
    assert sorted((d["new_columns"], d["missing_columns"], d["reordered"], d["files"]) for d in drift) == [
        ([], [], True, 1), (["z, with comma"], ["y"], False, 1)]


def test_ingest_of_files_with_different_headers(spark, tmp_path, paths):
    columns = list(ORDERS.columns)
    write_csv(tmp_path / "in" / "a.csv", columns, ORDER_ROWS[:3])
    write_csv(tmp_path / "in" / "b.csv", [*reversed(columns), "channel"], [(*reversed(r), "web") for r in ORDER_ROWS[3:5]])
    write_csv(tmp_path / "in" / "c.csv", columns[:-1], [r[:-1] for r in ORDER_ROWS[5:]])
    stats = ingest(spark, ORDERS, str(tmp_path / "in"), paths["bronze_orders"], batch_id="b1", as_of=AS_OF)
    assert stats.schema_changes["new_columns"] == ["channel"] and stats.schema_changes["missing_columns"] == []
    assert len(stats.schema_changes["headers"]) == 2
    rows = lake.read_table(spark, paths["bronze_orders"], ORDERS.bronze_schema).collect()
    got = {r["order_id"] + (r["payment_method"] or ""): r for r in rows}
    for number, row in enumerate(ORDER_ROWS):
        found = got[row[0] + row[7]]
        want = dict(zip(columns, (v or None for v in row), strict=True)) | ({"created_at": None} if number > 4 else {})
        assert {c: found[c] for c in columns} == want
        assert found["_extra_fields"] == ('{"channel":"web"}' if number in (3, 4) else None)
        assert found["_bronze_source_file"].endswith(f"{'aaabbcc'[number]}.csv")


def test_stream_equals_batch(spark, tmp_path, paths):
    source = write_csv(tmp_path / "in" / "orders.csv", ORDERS.columns, ORDER_ROWS)
    ingest(spark, ORDERS, source, paths["bronze_orders"], batch_id="b1", as_of=AS_OF)

    def stream():
        refine_available(
            spark, "orders", paths["bronze_orders"], paths["silver_orders"], paths["checkpoint"], as_of=AS_OF
        ).awaitTermination()
        return lake.read_table(spark, paths["silver_orders"])

    streamed = stream()
    refine(spark, "orders", paths["bronze_orders"], str(tmp_path / "batch"), batch_id="s", as_of=AS_OF)
    batch = lake.read_table(spark, str(tmp_path / "batch"))
    keep = [c for c in batch.columns if not c.startswith("_silver") or c == "_silver_record_hash"]
    assert sorted(map(str, streamed.select(keep).collect())) == sorted(map(str, batch.select(keep).collect()))
    assert stream().count() == 3
    later = write_csv(tmp_path / "in2" / "orders.csv", ORDERS.columns, [("O8", *ORDER_ROWS[3][1:])])
    ingest(spark, ORDERS, later, paths["bronze_orders"], batch_id="b2", as_of=AS_OF)
    assert stream().count() == 4


def ingest_rows(spark, tmp_path, paths, batch, rows, **options):
    source = write_csv(tmp_path / f"in-{batch}" / "orders.csv", ORDERS.columns, rows)
    return ingest(spark, ORDERS, source, paths["bronze_orders"], batch_id=batch, as_of=AS_OF, **options)


def refine_orders(spark, paths, batch, **options):
    return refine(spark, "orders", paths["bronze_orders"], paths["silver_orders"], batch_id=batch, as_of=AS_OF, **options)


def test_superseded_and_invalid_batches_are_read_once(spark, tmp_path, paths):
    """A batch that leaves no silver row behind isn't taken as new by the next run."""
    ingest_rows(spark, tmp_path, paths, "b1", [ORDER_ROWS[0]])
    ingest_rows(spark, tmp_path, paths, "b2", [ORDER_ROWS[1]])
    ingest_rows(spark, tmp_path, paths, "b3", [ORDER_ROWS[4]])
    first = refine_orders(spark, paths, "s1")
    assert (first.batches, first.records_output) == (("b1", "b2", "b3"), 1)
    assert refine_orders(spark, paths, "s2").batches == ()
    rows = lake.read_table(spark, paths["silver_orders"]).collect()
    assert [(r["payment_method"], r["_silver_batch_id"]) for r in rows] == [("credit_card", "s1")]


def test_reingested_batch_replaces_its_silver_rows(spark, tmp_path, paths):
    """The silver batch that holds it is made again, also where its rows move to another month."""
    ingest_rows(spark, tmp_path, paths, "b1", [ORDER_ROWS[0]])
    ingest_rows(spark, tmp_path, paths, "b2", [ORDER_ROWS[3]])
    refine_orders(spark, paths, "s1")
    moved = ("O1", "C1", "2024-05-01 10:00:00", *ORDER_ROWS[0][3:])
    ingest_rows(spark, tmp_path, paths, "b1", [moved])
    again = refine_orders(spark, paths, "s2")
    assert again.batches == ("b1", "b2")
    rows = lake.read_table(spark, paths["silver_orders"]).collect()
    assert sorted((r["order_id"], r["order_month"], r["_silver_batch_id"]) for r in rows) == [("O1", 5, "s1"), ("O3", 3, "s1")]


def test_stream_after_reingest(spark, tmp_path, paths):
    for _ in range(2):
        ingest_rows(spark, tmp_path, paths, "b1", [ORDER_ROWS[0]])
        refine_available(
            spark, "orders", paths["bronze_orders"], paths["silver_orders"], paths["checkpoint"], as_of=AS_OF
        ).awaitTermination()
        assert lake.read_table(spark, paths["silver_orders"]).count() == 1


def test_repeated_run_doesnt_double_the_audit(spark, tmp_path, paths):
    audit = AuditLog(spark, paths["audit"])
    for _ in range(2):
        ingest_rows(spark, tmp_path, paths, "b1", [ORDER_ROWS[0], ORDER_ROWS[4], ORDER_ROWS[6]], audit=audit)
        refine_orders(spark, paths, "s1", bronze_batch_id="b1", audit=audit)
    counts = [audit.table(t).count() for t in ("bronze_batch_log", "silver_batch_log", "data_quality_issues")]
    assert counts == [1, 1, 2] and audit.batch_summary("b1").count() == 1
    runs = {r["execution_id"]: (r["status"], r["records_processed"]) for r in audit.executions().collect()}
    assert runs == {"bronze-orders-b1": ("SUCCESS", 3), "silver-orders-s1": ("SUCCESS", 3)}
    with pytest.raises(Exception):
        ingest(spark, ORDERS, str(tmp_path / "nowhere"), paths["bronze_orders"], batch_id="b9", as_of=AS_OF, audit=audit)
    assert audit.executions().filter("execution_id = 'bronze-orders-b9'").first()["status"] == "FAILED"


def test_folder_as_source_keeps_files_and_their_lines(spark, tmp_path, paths):
    for name, rows in (("a.csv", ORDER_ROWS[:4]), ("b.csv", ORDER_ROWS[4:])):
        write_csv(tmp_path / "in" / name, ORDERS.columns, rows)
    ingest(spark, ORDERS, str(tmp_path / "in"), paths["bronze_orders"], batch_id="b1", as_of=AS_OF)
    rows = lake.read_table(spark, paths["bronze_orders"], ORDERS.bronze_schema).collect()
    found = sorted((r["_bronze_source_file"].rsplit("/", 1)[1], r["_bronze_source_line_number"], r["order_id"]) for r in rows)
    want = [("a.csv", n, r[0]) for n, r in enumerate(ORDER_ROWS[:4], 1)] + [("b.csv", n, r[0]) for n, r in enumerate(ORDER_ROWS[4:], 1)]
    assert found == want and len({r["_bronze_file_hash"] for r in rows}) == 2


def test_table_exists(spark, tmp_path):
    assert not lake.table_exists(spark, str(tmp_path / "none"))
    spark.range(1).write.parquet(str(tmp_path / "some"))
    assert lake.table_exists(spark, str(tmp_path / "some"))


def test_audit_runs(spark, tmp_path):
    audit = AuditLog(spark, str(tmp_path / "audit"))
    assert audit.create() == list(SCHEMAS) and audit.create() == []
    audit.start_execution("e1", "daily", at=datetime(2025, 1, 1, 10))
    audit.start_execution("e2", "daily", at=datetime(2025, 1, 2, 10))
    audit.complete_execution("e1", bronze_batch_id="b1", records_processed=5, at=datetime(2025, 1, 1, 10, 0, 45))
    states = {r["execution_id"]: r for r in audit.executions().collect()}
    assert (states["e1"]["status"], states["e1"]["duration_seconds"]) == ("SUCCESS", Decimal("45.00"))
    assert states["e2"]["status"] == "RUNNING"
    performance = audit.execution_performance("daily", date(2025, 1, 10)).collect()
    assert [r["execution_date"] for r in performance] == [date(2025, 1, 2), date(2025, 1, 1)]
    assert audit.execution_performance("daily", date(2025, 3, 1)).isEmpty()
    with pytest.raises(KeyError):
        audit.complete_execution("e9")
    for inserted in (7, 1):  # the second replaces the first
        audit.log("gold_batch_log", [{
            "batch_id": "g1", "source_batch_id": "s1", "table_name": "daily_sales", "table_type": "FACT",
            "records_inserted": inserted, "records_updated": 2, "records_deleted": 0, "business_rules_applied": ["sum"],
            "processing_duration_seconds": 1.234,
        }])
    assert audit.table("gold_batch_log").count() == 1
    with pytest.raises(KeyError, match="no column"):
        audit.log("gold_batch_log", [{"nonsense": 1}])
    with pytest.raises(ValueError), audit.run("e3", "daily", bronze_batch_id="b3"):
        raise ValueError("broken feed")
    failed = audit.executions().filter("execution_id = 'e3'").first()
    assert (failed["status"], failed["error_message"], failed["bronze_batch_id"]) == ("FAILED", "broken feed", "b3")
    gold = audit.table("gold_batch_log").first()
    assert (gold["processing_duration_seconds"], gold["business_rules_applied"]) == (Decimal("1.23"), '["sum"]')


def test_audit_tables_in_sql(spark, tmp_path):
    audit = AuditLog(spark, str(tmp_path / "audit"))
    audit.create()
    audit.register()
    try:
        audit.start_execution("e1", "daily")
        spark.catalog.refreshTable("metadata_pipeline_execution")
        assert spark.sql("SELECT status FROM metadata_pipeline_execution").first()[0] == "RUNNING"
    finally:
        for table in SCHEMAS:
            spark.sql(f"DROP TABLE IF EXISTS metadata_{table}")


def test_issue_ids_repeat_for_the_same_issue(spark, tmp_path):
    audit = AuditLog(spark, str(tmp_path / "audit"))
    audit.create()
    issues = spark.createDataFrame(
        [("r1", "MISSING_X", "x", "MISSING_X:x", None, "ERROR"), ("r2", "STRANGE", "y", "STRANGE:y", "v", "WARNING")],
        "record_identifier string, error_type string, error_field string, error_message string, error_value string, severity string",
    )
    assert audit.log_issues("b", "bronze", "t", issues) == 2
    audit.log_issues("b", "bronze", "t", issues)
    assert audit.table("data_quality_issues").select(F.count_distinct("issue_id")).first()[0] == 2


def jobs(spark, action):
    """Number of Spark jobs that an action runs."""
    spark.sparkContext.setJobGroup("counted", "counted")
    try:
        result = action()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    seen = len(tracker.getJobIdsForGroup("counted"))
    spark.sparkContext.setJobGroup("done", "done")
    return result, seen


def test_jobs_per_run(spark, tmp_path, paths):
    """Runs don't evaluate their source again and again; an idle run only looks at manifest and ledger."""
    audit = AuditLog(spark, paths["audit"])
    ingest_rows(spark, tmp_path, paths, "b1", ORDER_ROWS, audit=audit)
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    _, total = jobs(spark, lambda: ingest_rows(spark, tmp_path, paths, "b2", ORDER_ROWS[:2], audit=audit))
    took = total - before
    _, total_refine = jobs(spark, lambda: refine_orders(spark, paths, "s1", audit=audit))
    _, total_idle = jobs(spark, lambda: refine_orders(spark, paths, "s2"))
    assert (took, total_refine - total, total_idle - total_refine) <= (30, 14, 6)
    print("jobs", took, total_refine - total, total_idle - total_refine)


def test_pending_batches_read_no_bronze_rows(spark, tmp_path, paths):
    ingest_rows(spark, tmp_path, paths, "b1", ORDER_ROWS[:2])
    pending = lake.pending_batches(spark, paths["bronze_orders"], paths["silver_orders"])
    assert pending.inputFiles() and all("/bronze_orders_manifest/" in f for f in pending.inputFiles())
    assert [(r["bronze_batch"], r["records"]) for r in pending.collect()] == [("b1", 2)]


def test_batch_without_manifest_note_is_not_refined(spark, tmp_path, paths):
    """A batch whose run stopped before its end has no note; run again, it has one."""
    ingest_rows(spark, tmp_path, paths, "b1", ORDER_ROWS[:2])
    ingest_rows(spark, tmp_path, paths, "b2", ORDER_ROWS[3:4])
    note = [p for p in (tmp_path / "bronze_orders_manifest").glob("*.parquet")]
    newest = max(note, key=lambda p: p.stat().st_mtime_ns)
    kept = spark.read.parquet(*[str(p) for p in note if p != newest]).collect()
    assert [r["bronze_batch"] for r in kept] == ["b1"]
    other = str(tmp_path / "bronze_orders_manifest_old")
    spark.createDataFrame(kept, lake.MANIFEST).write.parquet(other)
    (tmp_path / "bronze_orders_manifest").rename(tmp_path / "gone")
    (tmp_path / "bronze_orders_manifest_old").rename(tmp_path / "bronze_orders_manifest")
    assert refine_orders(spark, paths, "s1").batches == ("b1",)
    ingest_rows(spark, tmp_path, paths, "b2", ORDER_ROWS[3:4])
    assert refine_orders(spark, paths, "s2").batches == ("b2",)


def test_tables_from_before_manifest_and_index(spark, tmp_path, paths):
    """Both are made from the bronze table when they are missing."""
    ingest_rows(spark, tmp_path, paths, "b1", ORDER_ROWS[:3])
    for name in ("bronze_orders_manifest", "bronze_orders_hashes"):
        (tmp_path / name).rename(tmp_path / f"gone_{name}")
    stats = ingest_rows(spark, tmp_path, paths, "b2", ORDER_ROWS[2:4])
    assert (stats.records_total, stats.records_duplicate) == (2, 1)
    assert refine_orders(spark, paths, "s1").batches == ("b1", "b2")


def test_compaction_keeps_rows_and_lets_batches_be_made_again(spark, tmp_path, paths):
    def rows():
        found = silver_rows(spark, paths["silver_orders"])
        return sorted((r["order_id"], r["order_month"], r["payment_method"], r["_silver_batch_id"]) for r in found.collect())

    def files():
        return sum(1 for name in ("silver_orders", "silver_orders_packed") for p in (tmp_path / name).rglob("*.parquet"))

    months = [("O%d" % k, "C1", f"2024-{k:02d}-01 10:00:00", *ORDER_ROWS[0][3:]) for k in range(1, 11)]
    for batch, silver, part in (("b1", "s1", months[:6]), ("b2", "s2", months[4:])):
        ingest_rows(spark, tmp_path, paths, batch, part)
        refine_orders(spark, paths, silver)
    before, many = rows(), files()
    packed = compact(spark, paths["silver_orders"], ("order_year", "order_month"))
    assert (packed.batches, packed.rows, packed.files) == (("s1", "s2"), 12, 1) and many >= 12
    assert rows() == before and files() == 1
    assert compact(spark, paths["silver_orders"], ("order_year", "order_month")).batches == ()
    schema = "order_id string, order_month int"
    assert silver_rows(spark, paths["silver_orders"], schema).where("order_month = 10").collect()[0][0] == "O10"
    ingest_rows(spark, tmp_path, paths, "b1", [(*months[0][:7], "cod", months[0][8])])
    assert refine_orders(spark, paths, "s3").batches == ("b1",)
    assert rows() == sorted([("O1", 1, "cash_on_delivery", "s1"), *(r for r in before if r[3] == "s2")])
    assert compact(spark, paths["silver_orders"], ("order_year", "order_month"), keep_open=["s1"]).batches == ()
    assert compact(spark, paths["silver_orders"], ("order_year", "order_month"), target_rows=1).batches == ("s1",)
    assert rows() == sorted([("O1", 1, "cash_on_delivery", "s1"), *(r for r in before if r[3] == "s2")])
