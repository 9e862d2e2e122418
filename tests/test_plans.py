"""Shape of the physical plans."""

import re

from pyspark.sql import functions as F

from lakemill.contracts import ORDERS
from lakemill.operators.dedup import newest_per_key
from lakemill.operators.order_metrics import add_order_metrics
from lakemill.operators.references import flag_reference
from lakemill.plans.silver import silver_customers
from tests.conftest import SF
from workloads import customers, items, orders
from workloads.shape import AS_OF


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return len(re.findall(r"Exchange hashpartitioning", text))


def clean_items(spark):
    return spark.read.parquet(f"{SF}/lineitem.parquet").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("line_total"),
    )


def test_order_metrics_need_one_shuffle_and_one_sort(spark):
    text = plan(add_order_metrics(clean_items(spark)))
    assert exchanges(text) == 1
    assert len(re.findall(r"Sort \[", text)) == 1


def test_reference_and_metrics_shuffle_items_and_parents_once(spark):
    """Beside those two shuffles only bitmaps of the key filter move, and the filter is broadcast to the parents' scan."""
    parents = spark.read.parquet(f"{SF}/orders.parquet").select(F.col("o_orderkey").alias("order_id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        flagged = flag_reference(clean_items(spark), parents, "order_id", "known", salt_by="item_id")
        text = plan(add_order_metrics(flagged))
        assert exchanges(text) == 3 and len(re.findall(r"Exchange hashpartitioning\(bucket", text)) == 1
        assert len(re.findall("BroadcastExchange", text)) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def shuffled_rows(df):
    """Rows that went through exchanges by ``order_id`` as a query ran."""
    df.write.format("noop").mode("overwrite").save()
    node, found = df._jdf.queryExecution().executedPlan(), []
    df.collect()
    waiting = [node]
    while waiting:
        node = waiting.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            waiting.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            waiting.append(node.plan())
            continue
        if name == "ShuffleExchangeExec" and "hashpartitioning(order_id" in node.outputPartitioning().toString():
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]
    return found


def test_parents_that_no_row_refers_to_are_not_shuffled(spark):
    parents = spark.range(200_000).select(F.col("id").cast("string").alias("order_id"))
    items = spark.range(100).select(F.col("id").alias("item_id"), (F.col("id") * 7).cast("string").alias("order_id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        flagged = flag_reference(items, parents, "order_id", "known", salt_by="item_id")
        moved = shuffled_rows(flagged)
        assert flagged.where("known").count() == 100 and 200 <= sum(moved) < 5_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_dedup_limits_groups_before_the_shuffle(spark):
    text = plan(newest_per_key(clean_items(spark), "item_id", "line_total"))
    assert text.index("row_number(), 1, Final") < text.index("Exchange hashpartitioning") < text.index("row_number(), 1, Partial")


def test_no_python_and_no_single_partition(spark):
    frames = [
        orders.orders_silver(spark, SF), customers.customers_silver(spark, SF), items.items_silver(spark, SF),
        orders.dq_orders(spark, SF),
    ]
    for frame in frames:
        assert not re.search(r"Python|SinglePartition|CartesianProduct", plan(frame))


def test_silver_prunes_columns_and_pushes_filters(spark, tmp_path):
    path = str(tmp_path / "bronze")
    customers.bronze(spark, SF).write.parquet(path)
    text = silver_customers(spark.read.parquet(path), batch_id="b", as_of=AS_OF).select("customer_id", "customer_tier")
    text = text._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "IsNotNull(customer_id)" in text
    read = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert "lifetime_value" in read and "phone" not in read and "_dq_error_details" not in read


def test_contract_fields_are_the_silver_inputs():
    assert set(ORDERS.required) <= set(ORDERS.columns)
