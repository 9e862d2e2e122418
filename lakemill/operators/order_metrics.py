"""Order-level measures on every order item."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakemill.functions.numbers import percentage
from lakemill.operators.skew import ROWS_PER_TASK, HotKeys, is_hot, ranked_by_range, stored_once


def add_order_metrics(
    items: DataFrame, *, hot: HotKeys | None = None, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Count, value, share and rank of each item within its order.

    Ordinary orders need one shuffle for all five columns. Orders named in ``hot`` do not
    fit one task: their sums are pre-aggregated and their ranks come from a range sort.
    The items are then checkpointed first, so that what they are made of runs once.
    """
    order_id, total = F.col("order_id"), F.col("line_total")
    ranking = [total.desc(), F.col("item_id")]
    ordinary = items
    if hot:
        items = stored_once(items)
        ordinary = items.filter(~is_hot(order_id, hot))
    per_order = Window.partitionBy("order_id")
    # Ranked first: the sums then reuse that sort as well as the shuffle.
    rank = F.row_number().over(per_order.orderBy(*ranking)).cast("bigint")
    ranked = ordinary.withColumn("item_rank_in_order", rank)
    measured = ranked.withColumns(
        {
            "order_item_count": F.count("item_id").over(per_order),
            "order_total_items_value": F.sum("line_total").over(per_order),
        }
    )
    if hot:
        large = items.filter(is_hot(order_id, hot))
        placed = ranked_by_range(
            large, "order_id", ranking, "item_rank_in_order", rows=sum(hot.values()), rows_per_task=rows_per_task
        )
        sums = placed.groupBy(order_id.alias("_sum_key")).agg(
            F.count("item_id").alias("order_item_count"),
            F.sum("line_total").alias("order_total_items_value"),
        )
        # At most one row per hot order.
        summed = placed.join(F.broadcast(sums), order_id.eqNullSafe(F.col("_sum_key")))
        measured = measured.unionByName(summed.drop("_sum_key"))
    return measured.withColumns(
        {
            "item_pct_of_order": percentage(total, F.col("order_total_items_value")),
            "is_highest_value_item": F.col("item_rank_in_order") == 1,
        }
    )
