"""The other feeds, read from files."""

import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakemill.operators import quality
from lakemill.sources import campaigns, catalogue, clickstream, inventory, reviews
from workloads import derive


def test_clickstream(spark, tmp_path):
    events = [
        {"event_id": "1", "event_type": "product_view", "timestamp": "2024-10-01T01:02:03", "device": {"type": "Mobile", "browser": None},
         "product": {"product_id": "P1", "price": 9.5, "in_stock": 1}},
        {"event_id": "2", "event_type": "product_view", "timestamp": "2024-10-01 01:02:03", "device_type": "TABLET", "browser": "Chrome",
         "product": {"product_id": "P2", "in_stock": False}, "location": {"country": "US"}},
        {"event_id": "3", "event_type": "add_to_cart", "timestamp": "?", "cart_action": {"product_id": "P3", "quantity": 2, "price": 1.0},
         "marketing": {"campaign_id": "C"}, "metadata": {"ab_test_variant": "A"}},
        {"event_id": "4"},
    ]
    path = tmp_path / "events.jsonl"
    path.write_text("\n".join(map(json.dumps, events)) + "\n")
    raw = clickstream.read_events(spark, str(path))
    rows = {r["event_id"]: r for r in clickstream.flatten_events(raw).collect()}
    assert (rows["1"]["device_type"], rows["1"]["in_stock"], rows["1"]["event_time"]) == ("mobile", True, datetime(2024, 10, 1, 1, 2, 3))
    assert (rows["2"]["device_type"], rows["2"]["browser"], rows["2"]["in_stock"], rows["2"]["country"]) == ("tablet", "chrome", False, "US")
    assert (rows["3"]["product_id"], rows["3"]["price"], rows["3"]["event_time"], rows["3"]["campaign_id"]) == ("P3", 1.0, None, "C")
    counts = [(r["event_type"], r["events"]) for r in clickstream.events_by_type(raw).collect()]
    assert counts == [("product_view", 2), ("add_to_cart", 1), ("unknown", 1)]


def test_campaign_log(spark, tmp_path):
    lines = [
        json.dumps({"timestamp": "2024-10-01T01:02:03.000004", "level": "info", "campaign_id": "CAMP0001", "customer_id": "CUST1",
                    "channel": "sms", "action": "sent", "message_id": "M", "metadata": {"os": "iOS"}}),
        "2024-10-01 01:02:03 [WARN] campaign=CAMP0002 customer=CUST000002 channel=email action=opened status=failure",
        "2024-10-01T01:02:03.123456 | LEVEL=debug | CAMPAIGN=CAMP0003 | ACTION=clicked | CUSTOMER=CUST000003",
        "[20241001 01:02:03.456] ERROR: Campaign CAMP0004 - bounced event for customer CUST000004",
        "01/Oct/2024:01:02:03 Email campaign CAMP0005 sent to customer CUST000005",
        "01/Oct/2024:01:02:03 ERROR: Failed to send email - SMTP timeout",
        "campaign=CAMP0006 a=1 a=2",
        "{not json}",
    ]
    path = tmp_path / "campaigns.log"
    path.write_text("\n".join(lines) + "\n")
    got = campaigns.parse_log(campaigns.read_log(spark, str(path)))
    rows = {r["raw"]: r for r in got.collect()}
    assert [rows[x]["format"] for x in lines] == ["json", "key_value", "piped", "bracketed", "free_text", "free_text", "unparsed", "json"]
    assert [rows[x]["campaign_id"] for x in lines] == ["CAMP0001", "CAMP0002", "CAMP0003", "CAMP0004", "CAMP0005", None, None, None]
    assert [rows[x]["action"] for x in lines[:6]] == ["sent", "opened", "clicked", "bounced", "sent", "failed"]
    assert [rows[x]["level"] for x in lines[:6]] == ["INFO", "WARN", "DEBUG", "ERROR", None, "ERROR"]
    assert [rows[x]["ts"].microsecond for x in lines[:5]] == [4, 0, 123456, 456000, 0]
    assert rows[lines[1]]["status"] == "failure" and rows[lines[0]]["message_id"] == "M"


def test_campaign_rates_without_denominator(spark):
    df = spark.createDataFrame(
        [("a", 0, 0, 0, 0, 0, Decimal("1.00"), Decimal("0.00")), ("b", 200, 150, 30, 3, 1, Decimal("5.00"), Decimal("4.00"))],
        "campaign_id string, sent_count int, delivered_count int, opened_count int, clicked_count int, converted_count int, "
        "revenue decimal(10,2), cost decimal(10,2)",
    )
    rows = {r["campaign_id"]: r for r in campaigns.campaign_rates(df).collect()}
    assert [rows["a"][c] for c in ("bounce_rate", "open_rate", "click_rate", "conversion_rate", "roi")] == [0, 0, 0, 0, None]
    assert [float(rows["b"][c]) for c in ("bounce_rate", "open_rate", "click_rate", "conversion_rate", "roi")] == [25, 20, 10, 33.33, 25]


CATALOGUE = """<?xml version="1.0"?>
<ProductCatalog version="2.1" xmlns="http://example.org/products">
  <Product id="P1" status="Active">
    <SKU>SKU-1</SKU><Title>A &amp; B</Title><Description>&lt;![CDATA[x]]&gt;</Description>
    <Category><MainCategory>Books</MainCategory><SubCategory>Fiction</SubCategory></Category><Brand/>
    <Pricing currency="US$"><ListPrice></ListPrice><SalePrice>-10.50</SalePrice></Pricing>
    <Inventory><StockQuantity warehouse="WH001">12</StockQuantity><Availability>In Stock</Availability></Inventory>
    <Attributes><Attribute name="COLOR">red</Attribute><Attribute name="size">L</Attribute></Attributes>
    <Images><Image type="primary">u0</Image></Images>
    <Shipping><Weight unit="lbs">1.50</Weight><Dimensions unit="inches">1x2x3</Dimensions></Shipping>
    <Dates><Created>02/03/2024</Created><LastUpdated>2024-02-04T05:06:07.000008</LastUpdated></Dates>
  </Product>
  <Product product_id="P2" status="">
    <Category>Sports</Category>
    <Pricing currency="eur"><ListPrice>5.00</ListPrice><SalePrice>4</SalePrice></Pricing>
  </Product>
</ProductCatalog>
"""


def test_catalogue(spark, tmp_path):
    path = tmp_path / "catalogue.xml"
    path.write_text(CATALOGUE)
    raw = catalogue.read_catalogue(spark, str(path))
    rows = {r["product_id"]: r for r in catalogue.products(raw).collect()}
    one, two = rows["P1"], rows["P2"]
    assert (one["status"], one["title"], one["main_category"], one["sub_category"], one["brand"]) == ("active", "A & B", "Books", "Fiction", None)
    assert (one["currency"], one["list_price"], one["sale_price"], one["stock_quantity"], one["warehouse"]) == ("USD", None, None, 12, "WH001")
    assert (one["availability"], one["weight"], one["weight_unit"], one["dimension_unit"]) == ("in_stock", Decimal("1.50"), "lb", "in")
    assert (one["length"], one["width"], one["height"], one["created_on"]) == (1, 2, 3, date(2024, 2, 3))
    assert one["updated_at"] == datetime(2024, 2, 4, 5, 6, 7, 8)
    assert (two["status"], two["main_category"], two["sub_category"], two["currency"], two["sale_price"]) == (
        None, "Sports", None, "EUR", Decimal("4.00"))
    attributes = [tuple(r) for r in catalogue.attributes(raw).orderBy("position").collect()]
    assert attributes == [("P1", 0, "color", "red"), ("P1", 1, "size", "L")]
    assert [tuple(r) for r in catalogue.images(raw).collect()] == [("P1", 0, "primary", "u0")]


def test_reviews(spark, tmp_path):
    rows = [
        ("R1", "P1", "5", "Yes", "3", "4", "BUY NOW!!! nice", "Published"),
        ("R1", "P1", "9", "0", None, None, "<script>x", ""),
        ("R2", None, "", "dunno", "1.0", "x", None, None),
    ]
    df = spark.createDataFrame(rows, "review_id string, product_id string, rating string, verified_purchase string, "
                                     "helpful_votes string, total_votes string, review_text string, review_status string")
    clean = reviews.clean_reviews(df)
    got = clean.collect()
    assert [r["rating"] for r in got] == [5, 9, None]
    assert [r["verified_purchase"] for r in got] == [True, False, None]
    assert [r["helpful_votes"] for r in got] == [3, None, 1]
    assert [r["review_length"] for r in got] == [15, 9, 0]
    assert [r["review_status"] for r in got] == ["published", None, None]
    flags = quality.apply_rules(clean, reviews.review_rules()).collect()
    assert [r["_dq_errors"] for r in flags] == [[], ["RATING_OUT_OF_RANGE:rating"], ["MISSING_REQUIRED_FIELD:product_id"]]
    assert [r["_dq_warnings"] for r in flags] == [["SUSPECTED_SPAM:review_text"], ["MARKUP_IN_TEXT:review_text"], []]
    assert [tuple(r) for r in reviews.repeated_reviews(clean).collect()] == [("R1", 2)]
    assert [tuple(r) for r in reviews.distribution(clean, "rating").collect()] == [(5, 1), (9, 1)]
    for fmt in ("parquet", "csv"):
        path = str(tmp_path / fmt)
        reviews.write_reviews(clean, path, fmt)
        assert spark.read.option("header", True).format(fmt).load(path).count() == 3


def test_inventory(spark):
    stock = spark.createDataFrame(
        [("10", "3", "2.50", "25.00"), ("4", "x", "1.00", "#DIV/0!"), (None, "1", "1", None)],
        "current_stock string, reserved_stock string, unit_cost string, total_value string",
    )
    got = inventory.stock_values(stock).collect()
    assert [r["available_stock"] for r in got] == [7, None, None]
    assert [r["computed_value"] for r in got] == [Decimal("25.00"), Decimal("4.00"), None]
    assert inventory.stated_value(stock).first()[0] == Decimal("25.00")
    sizes = spark.createDataFrame([(Decimal("10.00"), Decimal("4.15"), Decimal("4.00"))], "length decimal(10,2), width decimal(10,2), height decimal(10,2)")
    assert inventory.volumetric_weight(sizes).first()["volumetric_weight"] == Decimal("1.00")
    summary = {r["metric"]: r["value"] for r in inventory.sheet_summary(stock, sizes, sizes).collect()}
    assert summary == {"total_products": 1, "total_warehouses": 1, "total_inventory_value": 25}


def test_line_numbers_over_many_files(spark, tmp_path):
    from lakemill.operators.line_numbers import number_lines

    spark.range(0, 1000, 1, 13).selectExpr("cast(id as string) v").write.csv(str(tmp_path / "in"), header=True)
    scan = spark.read.option("header", True).csv(str(tmp_path / "in"))
    lines = sorted(r["n"] for r in number_lines(scan, "n").collect())
    assert lines == list(range(1, 1001))
    assert number_lines(scan, "n").select(F.count_distinct("v")).first()[0] == 1000


def test_sheet_below_titles(spark, tmp_path):
    """Titles and an empty row above the header, headers with units, error texts and text numbers."""
    sheet = tmp_path / "stock.csv"
    sheet.write_text(
        "Warehouse report,,,,,\n,,,,,\nProduct ID,Current Stock,Reserved Stock,Unit Cost,Length (in),Width (in)\n"
        "P1,10,3,2.50,10,2\n,,,,,\nP2,#N/A,1,4.00,x,2\n"
    )
    rows = inventory.read_sheet(spark, str(sheet), ["Product ID", "Current Stock"])
    assert rows.columns == ["product_id", "current_stock", "reserved_stock", "unit_cost", "length", "width"]
    valued = inventory.stock_values(inventory.volumetric_weight(rows.withColumn("height", F.lit("83"))))
    got = {r["product_id"]: (r["available_stock"], r["computed_value"], r["volumetric_weight"]) for r in valued.collect()}
    assert got == {"P1": (7, Decimal("25.00"), Decimal("10.00")), "P2": (None, None, None)}
    with pytest.raises(ValueError):
        inventory.read_sheet(spark, str(sheet), ["Nothing"])


def test_feeds_are_made_in_methods_that_the_jvm_compiles(spark):
    """The limit on generated methods holds while a feed is written, and no longer, also if that fails."""
    name, seen = "spark.sql.codegen.hugeMethodLimit", []
    before = spark.conf.get(name)

    def make(session, sf_dir):
        seen.append(session.conf.get(name))
        return session.range(3)

    assert derive.landed(spark, "", "few", make).count() == 3
    assert seen == ["8000"] and spark.conf.get(name) == before
    with pytest.raises(ZeroDivisionError):
        derive.landed(spark, "", "none", lambda session, sf_dir: 1 / 0)
    assert spark.conf.get(name) == before
