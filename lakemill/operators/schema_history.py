"""Versions of a feed's column set: found by comparing each batch with the one before, and replayed for any batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ADDED, REMOVED = "COLUMN_ADDED", "COLUMN_REMOVED"
OWNER = ("table_name", "layer")


def schema_changes(sets: DataFrame, start: Sequence[str], *, first_version: int = 0) -> DataFrame:
    """One row per kind of change of each batch that changed the column set.

    ``sets``: table_name, layer, batch_id, detected_at and columns (array) of the batches; ``start``: the column set before
    the first of them, which has ``first_version``. Batches follow each other by moment and id. Each batch that changes the
    set makes a new version; each row has an id of its own, the same when the batch is logged again.
    """
    order = Window.partitionBy(*OWNER).orderBy("detected_at", "batch_id")
    before = F.coalesce(F.lag("columns").over(order), F.array(*[F.lit(c).cast("string") for c in start]))
    compared = sets.withColumn("_before", before).withColumns({
        "_added": F.array_sort(F.array_except("columns", "_before")),
        "_removed": F.array_sort(F.array_except("_before", "columns")),
    })
    changed = (F.size("_added") + F.size("_removed")) > 0
    so_far = F.sum(changed.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    numbered = compared.withColumn("schema_version", F.concat(F.lit("1."), (so_far + first_version).cast("string")))
    kinds = F.explode(F.array(_change(ADDED, "_added"), _change(REMOVED, "_removed")))
    rows = numbered.where(changed).select(*OWNER, "batch_id", "detected_at", "schema_version", kinds.alias("c"))
    rows = rows.where(F.size("c.columns") > 0).select(*OWNER, "batch_id", "detected_at", "schema_version", "c.*")
    return rows.withColumn("schema_id", F.xxhash64(*OWNER, "batch_id", "change_type"))


def _change(kind: str, columns: str) -> Column:
    return F.struct(F.lit(kind).alias("change_type"), F.col(columns).alias("columns"))


def columns_after(changes: DataFrame, batches: DataFrame, start: Sequence[str]) -> DataFrame:
    """The column set that each batch found: ``batches`` (table_name, layer, batch_id, detected_at) with ``columns``.

    Replays the changes up to a batch; their number, not that of rows, sets the work.
    """
    at = F.struct("detected_at", "batch_id").alias("_at")
    steps = changes.select(*OWNER, F.struct("detected_at", "batch_id").alias("_changed"), "change_type", F.col("columns").alias("_columns"))
    joined = batches.select("*", at).join(steps, list(OWNER), "left")
    step = F.when(F.col("_changed") <= F.col("_at"), F.struct("_changed", "change_type", "_columns"))
    listed = joined.groupBy(*OWNER, "batch_id", "detected_at").agg(F.array_sort(F.collect_list(step)).alias("_steps"))
    replayed = F.aggregate(
        "_steps", F.array(*[F.lit(c).cast("string") for c in start]),
        lambda found, s: F.when(s["change_type"] == ADDED, F.array_union(found, s["_columns"])).otherwise(F.array_except(found, s["_columns"])),
    )
    return listed.select(*OWNER, "batch_id", "detected_at", F.array_sort(replayed).alias("columns"))
