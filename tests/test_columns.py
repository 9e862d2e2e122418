"""Column functions, rules and small operators on edge values."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakemill.contracts import CUSTOMERS, ORDER_ITEMS, ORDERS
from lakemill.functions import dates, numbers, text
from lakemill.functions.hashing import record_hash
from lakemill.functions.rules import WARNING, rule
from lakemill.operators import quality, standardize
from lakemill.operators.changes import current_rows, stack_changes
from lakemill.operators.dedup import newest_per_key
from lakemill.operators.drift import conform, detect_drift, drop_technical_columns
from lakemill.operators.enrich import enrich_items
from lakemill.operators.filters import CUSTOMER_IDS, drop_invalid

AS_OF = date(2025, 1, 1)


def values(spark, texts, function):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(function(F.col("t"))).collect()]


def test_blank(spark):
    assert values(spark, [None, "", "  ", "\t", " a"], text.is_blank) == [True, True, True, True, False]


def test_names(spark):
    assert values(spark, ["jEAN-luc o'neil", " ", None], text.name_case) == ["Jean-luc O'neil", None, None]


def test_phone(spark):
    assert values(spark, ["+1 (555) 123-4567", "555.123.4567", "12", None], text.us_phone) == [
        "(555) 123-4567", "(555) 123-4567", None, None]


def test_yes_no(spark):
    assert values(spark, [" Y ", "TRUE", "0", "maybe", "", None], text.yes_no) == [True, True, False, None, None, None]


def test_segment_and_payment(spark):
    assert values(spark, [" VIP", "gold", None], text.segment) == ["vip", "standard", "standard"]
    assert values(spark, ["CC", " Cash on Delivery", "", None], text.payment_method) == [
        "credit_card", "cash_on_delivery", "other", "other"]


def test_category(spark):
    got = values(spark, ["Home & Garden", " TECH ", None, "", "music"], text.category)
    assert got == ["Home_garden", "Electronics", "Uncategorized", "", "Music"]


def test_email(spark):
    assert values(spark, ["a@b", "a@b.co", "", None], text.email_valid) == [False, True, False, False]
    assert values(spark, ["a@b.co", "x", None], text.email_domain) == ["b.co", "", None]


def test_dates_depend_on_format_order(spark):
    texts = ["01/02/2024 10:30", "25-12-2023 01:02:03", "2024-02-03T04:05:06.123456", "2024-02-03T04:05:06.123", "soon", "", None]
    month_first = values(spark, texts, dates.parse_timestamp)
    assert month_first[0] == datetime(2024, 1, 2, 10, 30)
    assert month_first[1] == datetime(2023, 12, 25, 1, 2, 3)
    assert month_first[2] == datetime(2024, 2, 3, 4, 5, 6, 123456)
    assert month_first[3] == datetime(2024, 2, 3, 4, 5, 6, 123000)
    assert month_first[4:] == [None, None, None]
    day_first = values(spark, texts, lambda c: dates.parse_timestamp(c, dates.DAY_FIRST))
    assert day_first[0] == datetime(2024, 2, 1, 10, 30)
    assert day_first[2] is None


def test_shapes_accept_what_the_formats_read(spark):
    at = datetime(2024, 1, 2, 3, 4, 5, 123456)
    known = {*dates.DAY_FIRST, *dates.MONTH_FIRST_ISO, *dates.EVENT_TIMES, *dates.REGISTRATION_DATES, *dates.LENIENT_DATES}
    for fmt in known:
        written = spark.range(1).select(F.date_format(F.lit(at), fmt.replace("[.SSSSSS][.SSS]", "")).alias("t"))
        parsed = written.select(dates.parse_timestamp(F.col("t"), [fmt])).first()[0]
        assert parsed is not None and parsed.date() == at.date(), fmt
    assert dates.shape("dd/MMM/yyyy") is None
    assert dates.shape("yyyy-MM-dd'T'HH[.SSS]") == r"^\d{4}\-\d{2}\-\d{2}T\d{2}(?:\.\d{3})?$"


def test_lenient_dates(spark):
    got = values(spark, ["2024-2-5", "13/02/2024", "2/13/2024", "05-02-2024"],
                 lambda c: dates.parse_date(c, dates.LENIENT_DATES))
    assert got == [date(2024, 2, 5), None, date(2024, 2, 13), date(2024, 2, 5)]


def test_numbers(spark):
    texts = ["3.0", "-2", "abc", "", None, "1_000", "nan", " 7 "]
    assert values(spark, texts, numbers.quantity) == [3, 1, 1, 1, 1, 1, 1, 7]
    assert values(spark, texts, lambda c: numbers.quantity(c, negative="abs")) == [
        Decimal(3), Decimal(2), None, Decimal(0), Decimal(0), None, None, Decimal(7)]
    assert values(spark, ["-1.5", "2.345", "x"], numbers.amount) == [Decimal("0.00"), Decimal("2.35"), Decimal("0.00")]
    with pytest.raises(ValueError):
        numbers.amount(F.lit(1), negative="keep")


def test_line_totals(spark):
    df = spark.createDataFrame(
        [("a", "2", "3.50", "7.00"), ("b", "1", "1.25", "9.99"), ("c", "-3", "2.00", "-6.0"), ("d", "1", "5.00", "5.01")],
        "item_id string, quantity string, unit_price string, line_total string",
    ).withColumns({"product_name": F.lit("X "), "category": F.lit("book"), "sku": F.lit(" s-1 ")})
    rows = {r["item_id"]: r for r in enrich_items(standardize.repair_line_total(standardize.standardize_items(df))).collect()}
    assert [(rows[k]["quantity"], rows[k]["line_total"]) for k in "abcd"] == [
        (2, Decimal("7.00")), (1, Decimal("1.25")), (1, Decimal("2.00")), (1, Decimal("5.01"))]
    assert rows["a"]["avg_price_per_item"] == Decimal("3.50")
    assert (rows["a"]["product_name"], rows["a"]["category"], rows["a"]["sku_cleaned"]) == ("x", "Books", "S-1")


def codes(spark, contract, **row):
    blank = {c: None for c in contract.columns}
    df = spark.createDataFrame([tuple({**blank, **row}.values())], contract.landing_schema)
    got = quality.apply_rules(df, contract.rules(AS_OF)).first()
    return got["_dq_errors"], got["_dq_warnings"]


def test_customer_rules(spark):
    errors, warnings = codes(
        spark, CUSTOMERS, customer_id="\t", email="a@b", phone="12", registration_date="2031-01-01",
        lifetime_value="1_000", customer_segment="Gold", is_active="perhaps", first_name="Testsample", last_name="Li",
    )
    assert errors == ["MISSING_REQUIRED_FIELD:customer_id", "INVALID_EMAIL_FORMAT:email",
                      "INVALID_NUMERIC:lifetime_value", "INVALID_BOOLEAN:is_active"]
    assert warnings == ["UNUSUAL_PHONE_FORMAT:phone", "FUTURE_REGISTRATION_DATE:registration_date",
                        "UNKNOWN_SEGMENT:Gold", "POTENTIAL_TEST_DATA:first_name", "POTENTIAL_TEST_DATA:first_name"]


def test_clean_customer_has_no_codes(spark):
    assert codes(spark, CUSTOMERS, customer_id="1", email="a@b.org", lifetime_value="0") == ([], [])


def test_order_and_item_rules(spark):
    errors, _ = codes(spark, ORDERS, order_id="1", customer_id=" ", order_date="x", created_at="x", total_amount="-1", tax_amount="nan")
    assert errors == ["MISSING_REQUIRED_FIELD:customer_id", "NEGATIVE_AMOUNT:total_amount", "INVALID_NUMERIC:tax_amount"]
    errors, _ = codes(spark, ORDER_ITEMS, item_id="1", order_id="1", product_id="", quantity="-1", unit_price="abc")
    assert errors == ["MISSING_REQUIRED_FIELD:product_id", "NEGATIVE_VALUE:quantity", "INVALID_NUMERIC:unit_price"]


def test_custom_rule(spark):
    df = spark.range(2).withColumn("n", F.col("id").cast("string"))
    got = quality.validate(df, [rule("ODD:n", F.col("n") == "1", WARNING)]).orderBy("id").collect()
    assert [r["_dq_warning_details"] for r in got] == ["[]", '["ODD:n"]']
    assert [r["_dq_error_count"] for r in got] == [0, 0]


def test_empty_batch_scores_zero(spark):
    empty = quality.validate(spark.createDataFrame([], ORDERS.landing_schema), ORDERS.rules(AS_OF))
    assert quality.batch_score(empty).first().asDict() == {
        "records_total": 0, "records_with_errors": 0, "data_quality_score": Decimal("0.00")}


def test_drift(spark):
    df = spark.createDataFrame([("1", "x", None)], "a string, extra string, more string")
    conformed, changes = conform(df, ["a", "b"])
    assert (changes["new_columns"], changes["missing_columns"], changes["has_changes"]) == (["extra", "more"], ["b"], True)
    assert conformed.first().asDict() == {"a": "1", "b": None, "_extra_fields": '{"extra":"x"}'}
    dotted = spark.createDataFrame([("1", "x")], "a string, `unit.price (USD)` string")
    assert conform(dotted, ["a"])[0].first()["_extra_fields"] == '{"unit.price (USD)":"x"}'
    only_missing, _ = conform(df.select("a"), ["a", "b"])
    assert only_missing.first()["_extra_fields"] is None
    assert not detect_drift(df, df.columns)["has_changes"]
    assert drop_technical_columns(conformed).columns == ["a", "b"]


def test_hashes(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a|", ""), ("a", "|")], "x string, y string")
    assert df.select(record_hash(["x", "y"]).alias("h")).distinct().count() == 4
    borders = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("NULL", "x"), (None, "x")], "x string, y string")
    assert borders.select(record_hash(["x", "y"]).alias("h")).distinct().count() == 4


def test_newest_per_key_breaks_ties(spark):
    df = spark.createDataFrame([("k", 1, "b"), ("k", 1, "a"), ("k", None, "c"), (None, 5, "d")], "k string, at int, v string")
    got = newest_per_key(df, "k", "at", ["v"]).collect()
    assert sorted(r["v"] for r in got) == ["a", "d"]


def test_changes(spark):
    old = spark.createDataFrame([("1", "a", "x"), ("2", "b", "y")], "id string, email string, phone string")
    update = spark.createDataFrame([("1", "c")], "id string, email string")
    new = spark.createDataFrame([("3", "d")], "id string, email string")
    got = {r["id"]: (r["email"], r["phone"]) for r in current_rows(stack_changes(old, update, new), "id").collect()}
    assert got == {"1": ("c", None), "2": ("b", "y"), "3": ("d", None)}


def test_error_rows_do_not_pass(spark):
    rows = [("1", "a@b.org", 0), ("1", "a@b.org", 1), (" ", "a@b.org", 0), ("2", None, 0)]
    df = spark.createDataFrame(rows, "customer_id string, email string, _dq_error_count int")
    assert drop_invalid(df, CUSTOMER_IDS).count() == 1
