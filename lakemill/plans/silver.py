"""Bronze rows -> silver tables.

Each ``silver_*`` function is a pure plan; ``refine`` reads the unseen batches, runs one
of them and adds the result. Invalid rows are dropped before rows are deduplicated, so
that a bad newest row does not hide a good older one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from lakemill.contracts import CUSTOMERS, ORDER_ITEMS, ORDERS, FeedContract
from lakemill.functions.dates import MONTH_FIRST_ISO
from lakemill.operators.audit import AuditLog
from lakemill.operators.dedup import newest_per_key
from lakemill.operators.enrich import enrich_customers, enrich_items, enrich_orders
from lakemill.operators.filters import CUSTOMER_IDS, ITEM_IDS, ORDER_IDS, acceptable, drop_invalid
from lakemill.operators.lineage import add_silver_lineage
from lakemill.operators.order_metrics import add_order_metrics
from lakemill.operators.references import flag_reference
from lakemill.operators.skew import MIN_HOT_ROWS, HotKeys, hot_keys
from lakemill.operators.standardize import (
    repair_line_total,
    repair_order_total,
    standardize_customers,
    standardize_items,
    standardize_orders,
)
from lakemill.sources import lake
from lakemill.sources.compaction import silver_rows, unpack

INGESTED_AT = "_bronze_ingestion_timestamp"
LINE = "_bronze_source_line_number"
SOURCE_FILE = "_bronze_source_file"
PROCESSED_AT = "_silver_processing_timestamp"
#: Bronze batches of one run whose rows are counted as it goes.
MOST_OBSERVED = 50

# The columns of the silver tables, in order.
LINEAGE_COLUMNS = [
    "_silver_processing_timestamp", "_silver_processing_date", "_silver_batch_id",
    "_silver_source_batch_id", "_silver_record_hash", lake.BATCH, INGESTED_AT,
]
CUSTOMER_COLUMNS = [
    "customer_id", "first_name", "last_name", "full_name", "email", "email_valid",
    "email_domain", "phone", "has_verified_contact", "registration_date",
    "registration_date_parsed", "customer_age_days", "customer_segment",
    "lifetime_value", "customer_tier", "is_active",
]
ORDER_COLUMNS = [
    "order_id", "customer_id", "order_date", "subtotal", "tax_amount",
    "discount_amount", "total_amount", "payment_method", "created_at", "order_year",
    "order_month", "order_day", "order_quarter", "order_day_of_week",
    "order_day_name", "order_week_of_year", "order_hour", "order_time_period",
    "is_weekend",
]
ITEM_COLUMNS = [
    "item_id", "order_id", "product_id", "sku_cleaned", "product_name", "category",
    "quantity", "unit_price", "line_total", "extended_price", "avg_price_per_item",
    "item_value_category", "quantity_category", "price_category",
    "is_high_quantity", "order_item_count", "order_total_items_value",
    "item_pct_of_order", "item_rank_in_order", "is_highest_value_item",
    "has_valid_order",
]
# Business columns that do not move with the day of the run.
CUSTOMER_HASH = [c for c in CUSTOMER_COLUMNS if c != "customer_age_days"]
ITEM_HASH = ["item_id", "order_id", "product_id", "sku_cleaned", "product_name", "category",
             "quantity", "unit_price", "line_total"]


def _ties(rows: DataFrame) -> list:
    """Among rows of one time the later batch, then the later file and line win."""
    names = [lake.BATCH, SOURCE_FILE, LINE]
    return [F.col(c).desc() for c in names if c in rows.columns]


def _newest_valid(bronze: DataFrame, ids: Sequence[str], key: str, filter_first: bool) -> DataFrame:
    if filter_first:
        return newest_per_key(drop_invalid(bronze, ids), key, INGESTED_AT, _ties(bronze))
    return drop_invalid(newest_per_key(bronze, key, INGESTED_AT, _ties(bronze)), ids)


def silver_customers(
    bronze: DataFrame,
    *,
    batch_id: str,
    as_of: date,
    processed_at: datetime | None = None,
    filter_first: bool = True,
) -> DataFrame:
    """``filter_first=False`` drops a customer whose newest row is invalid."""
    newest = _newest_valid(bronze, CUSTOMER_IDS, "customer_id", filter_first)
    enriched = enrich_customers(standardize_customers(newest), as_of)
    stamped = add_silver_lineage(
        enriched, batch_id=batch_id, hash_columns=CUSTOMER_HASH, processed_at=processed_at
    )
    return stamped.select(*CUSTOMER_COLUMNS, *LINEAGE_COLUMNS)


def silver_orders(
    bronze: DataFrame,
    *,
    batch_id: str,
    as_of: date,
    processed_at: datetime | None = None,
    date_formats: Sequence[str] = tuple(MONTH_FIRST_ISO),
) -> DataFrame:
    valid = drop_invalid(bronze, ORDER_IDS)
    typed = repair_order_total(standardize_orders(valid, date_formats))
    newest = newest_per_key(typed, "order_id", "created_at", [F.col(INGESTED_AT).desc(), *_ties(typed)])
    stamped = add_silver_lineage(
        enrich_orders(newest, as_of), batch_id=batch_id, hash_columns=ORDER_COLUMNS, processed_at=processed_at
    )
    return stamped.select(*ORDER_COLUMNS, *LINEAGE_COLUMNS)


def silver_items(
    bronze: DataFrame,
    orders: DataFrame | None,
    *,
    batch_id: str,
    as_of: date | None = None,
    processed_at: datetime | None = None,
    hot: HotKeys | None = None,
    counted: DataFrame | None = None,
    rows: int | None = None,
    min_hot_rows: int = MIN_HOT_ROWS,
    filter_first: bool = True,
) -> DataFrame:
    """``orders``: silver orders, or null for an unknown reference. ``hot``: see ``hot_keys``. ``counted``: the
    bronze rows in a cheaper form, to look at their keys; ``rows``: their number, if it is known: below ``min_hot_rows`` no
    order can be hot, else one job looks for hot ones.

    ``filter_first=False`` drops an item whose newest row is invalid.
    """
    keys = bronze if counted is None else counted
    if hot is None and rows is not None and rows < min_hot_rows:
        hot = {}
    if hot is None:  # counted before the filter, so that one column is read
        found = hot_keys(keys, "order_id", min_rows=min_hot_rows)
        hot = {key: number for key, number in found.items() if key and key.strip()}
    newest = _newest_valid(bronze, ITEM_IDS, "item_id", filter_first)
    typed = enrich_items(repair_line_total(standardize_items(newest)))
    flagged = flag_reference(typed, orders, "order_id", "has_valid_order", salt_by="item_id", hot=hot, keys=keys, rows=rows)
    measured = add_order_metrics(flagged, hot=hot)
    stamped = add_silver_lineage(
        measured, batch_id=batch_id, hash_columns=ITEM_HASH, processed_at=processed_at
    )
    return stamped.select(*ITEM_COLUMNS, *LINEAGE_COLUMNS)


@dataclass(frozen=True)
class SilverTable:
    contract: FeedContract
    ids: tuple[str, ...]
    partition_by: tuple[str, ...]
    gather: bool  # the rows of one batch belong to many partitions
    steps: list[str]


# Keys, partition columns and steps of the silver tables.
SILVER = {
    "customers": SilverTable(
        CUSTOMERS, CUSTOMER_IDS, ("_silver_processing_date",), False,
        ["filter", "deduplicate", "standardize", "enrich"],
    ),
    "orders": SilverTable(
        ORDERS, ORDER_IDS, ("order_year", "order_month"), True,
        ["filter", "standardize", "repair_total", "deduplicate", "enrich"],
    ),
    "order_items": SilverTable(
        ORDER_ITEMS, ITEM_IDS, ("_silver_processing_date",), False,
        ["filter", "deduplicate", "standardize", "repair_total", "enrich", "check_reference", "order_metrics"],
    ),
}


@dataclass(frozen=True)
class SilverStats:
    batches: tuple[str, ...]
    records_input: int
    records_filtered: int
    records_deduplicated: int
    records_output: int
    data_quality_score: float
    duration_seconds: float
    records_per_second: float


def stage_counts(bronze: DataFrame, ids: Sequence[str], output: DataFrame) -> DataFrame:
    """Per bronze batch: rows read, filtered, deduplicated and written, and the share kept."""
    read = bronze.select(lake.BATCH, F.lit(True).alias("read"), acceptable(ids).alias("valid"))
    written = output.select(lake.BATCH, F.lit(False).alias("read"), F.lit(True).alias("valid"))
    total, filtered, out = F.col("records_input"), F.col("records_filtered"), F.col("records_output")
    return (
        read.unionByName(written)
        .groupBy(lake.BATCH)
        .agg(
            F.count_if("read").alias("records_input"),
            F.count_if(~F.col("valid")).alias("records_filtered"),
            F.count_if(~F.col("read")).alias("records_output"),
        )
        .select(
            lake.BATCH, total, filtered, (total - filtered - out).alias("records_deduplicated"), out,
            F.when(total > 0, out / total * 100).otherwise(F.lit(0.0)).alias("data_quality_score"),
        )
    )


def refine(
    spark: SparkSession,
    table: str,
    bronze_path: str,
    silver_path: str,
    *,
    batch_id: str,
    as_of: date,
    bronze_batch_id: str | None = None,
    processed_at: datetime | None = None,
    orders_path: str | None = None,
    min_hot_rows: int = MIN_HOT_ROWS,
    audit: AuditLog | None = None,
) -> SilverStats:
    """Add the silver rows of one bronze batch, or of all batches that the ledger doesn't hold in their present state.

    With an audit the run is logged from start to end, also if it fails.
    """
    options = {
        "batch_id": batch_id, "as_of": as_of, "bronze_batch_id": bronze_batch_id, "processed_at": processed_at,
        "orders_path": orders_path, "min_hot_rows": min_hot_rows, "audit": audit,
    }
    if audit is None:
        return _refine(spark, table, bronze_path, silver_path, **options)
    with audit.run(f"silver-{table}-{batch_id}", f"refine_{table}", silver_batch_id=batch_id) as outcome:
        stats = _refine(spark, table, bronze_path, silver_path, **options)
        outcome["records_processed"] = stats.records_input
    return stats


def _refine(
    spark: SparkSession, table: str, bronze_path: str, silver_path: str, *,
    batch_id: str, as_of: date, bronze_batch_id: str | None, processed_at: datetime | None,
    orders_path: str | None, min_hot_rows: int, audit: AuditLog | None,
) -> SilverStats:
    bronze = lake.read_table(spark, bronze_path, SILVER[table].contract.bronze_schema)
    stats = SilverStats((), 0, 0, 0, 0, 0.0, 0.0, 0.0)
    for silver_batch, (batches, repeated) in _work(spark, bronze_path, silver_path, batch_id, bronze_batch_id).items():
        rows = bronze.filter(F.col(lake.BATCH).isin(sorted(batches)))  # as literals they prune the partitions of others
        more = refine_rows(
            spark, table, rows, sorted(batches), silver_path,
            batch_id=silver_batch, as_of=as_of, processed_at=processed_at, records=sum(b["records"] for b in batches.values()),
            repeated=repeated, orders_path=orders_path, min_hot_rows=min_hot_rows, audit=audit,
        )
        lake.record_batches(spark, silver_path, {b: row["version"] for b, row in batches.items()}, silver_batch)
        stats = _added(stats, more)
    return stats


def _work(
    spark: SparkSession, bronze_path: str, silver_path: str, batch_id: str, bronze_batch_id: str | None
) -> dict[str, tuple[dict[str, Row], bool]]:
    """Silver batches to make, each with its bronze batches and whether it was made before.

    New bronze batches go into ``batch_id``. A bronze batch that was ingested again is refined again together with all
    others of the silver batch that holds it, which is then replaced. One row per pending batch reaches the driver.
    """
    pending = lake.pending_batches(spark, bronze_path, silver_path)
    if pending is None:
        raise ValueError(f"{bronze_path} has no manifest: make it with lake.make_manifest")
    done = lake.recorded_batches(spark, silver_path)
    notes = lake.noted_batches(spark, bronze_path)
    if bronze_batch_id is not None:
        row = notes.where(F.col("bronze_batch") == bronze_batch_id).first()
        found = {bronze_batch_id: row or {"version": None, "records": 0}}
        return {batch_id: (found, done is not None and not done.where(F.col("silver_batch") == batch_id).isEmpty())}
    work: dict[str, dict[str, Row]] = {}
    for row in pending.collect():
        work.setdefault(row["silver_batch"] or batch_id, {})[row["bronze_batch"]] = row
    repeated = set()
    if done is not None and work:
        others = done.where(F.col("silver_batch").isin(list(work))).select("bronze_batch", "silver_batch")
        for row in others.join(notes, "bronze_batch").collect():
            repeated.add(row["silver_batch"])
            work[row["silver_batch"]].setdefault(row["bronze_batch"], row)
    return {batch: (found, batch in repeated) for batch, found in work.items()}


def _added(one: SilverStats, other: SilverStats) -> SilverStats:
    read, written = one.records_input + other.records_input, one.records_output + other.records_output
    seconds = one.duration_seconds + other.duration_seconds
    return SilverStats(
        batches=one.batches + other.batches,
        records_input=read,
        records_filtered=one.records_filtered + other.records_filtered,
        records_deduplicated=one.records_deduplicated + other.records_deduplicated,
        records_output=written,
        data_quality_score=written / read * 100 if read else 0.0,
        duration_seconds=seconds,
        records_per_second=written / seconds if seconds > 0 else 0.0,
    )


def _counted(
    spark: SparkSession, observed: Observation, told: Observation, bronze: DataFrame, batches: Sequence[str],
    ids: Sequence[str], records: int | None, silver_path: str, batch_id: str,
) -> dict[str, dict]:
    """Counts per bronze batch as the run told them. Tasks that read twice would count twice: if the rows read are not
    those of the manifest, or there are too many batches, the counts are taken from the stored tables."""
    read, written = lake.told(observed), lake.told(told)
    if len(batches) > MOST_OBSERVED or read is None or written is None or read["rows"] != records:
        output = silver_rows(spark, silver_path, f"{lake.SILVER_BATCH} string, {lake.BATCH} string")
        output = output.filter(F.col(lake.SILVER_BATCH) == batch_id)
        return {row[lake.BATCH]: row.asDict() for row in stage_counts(bronze, ids, output).collect()}
    counts = {}
    for k, batch in enumerate(batches):
        rows, filtered, out = read[f"r{k}"], read[f"f{k}"], written[f"b{k}"]
        if rows:
            counts[batch] = {
                "records_input": rows, "records_filtered": filtered, "records_deduplicated": rows - filtered - out,
                "records_output": out, "data_quality_score": out / rows * 100,
            }
    return counts


def refine_rows(
    spark: SparkSession,
    table: str,
    bronze: DataFrame,
    batches: Sequence[str],
    silver_path: str,
    *,
    batch_id: str,
    as_of: date,
    processed_at: datetime | None = None,
    records: int | None = None,
    repeated: bool = True,
    orders_path: str | None = None,
    min_hot_rows: int = MIN_HOT_ROWS,
    audit: AuditLog | None = None,
) -> SilverStats:
    """Add the silver rows of the given bronze rows; the same batch id again replaces them.

    ``records``: number of the bronze rows, if it is known; ``repeated``: whether the batch may have been made before.
    """
    spec = SILVER[table]
    started = datetime.now()
    if not batches:
        return SilverStats((), 0, 0, 0, 0, 0.0, 0.0, 0.0)
    if processed_at is None and repeated:  # a repeated batch keeps its day, and so its partitions
        stored = silver_rows(spark, silver_path, f"{lake.SILVER_BATCH} string, {PROCESSED_AT} timestamp")
        if stored is not None:
            earlier = stored.filter(F.col(lake.SILVER_BATCH) == batch_id)
            processed_at = earlier.agg(F.min(PROCESSED_AT)).first()[0]
    common = {"batch_id": batch_id, "as_of": as_of, "processed_at": processed_at}
    observed = Observation()
    read = [F.count(F.lit(1)).alias("rows")]
    for k, batch in enumerate(batches[:MOST_OBSERVED]):
        mine = F.col(lake.BATCH) == batch
        read += [F.count_if(mine).alias(f"r{k}"), F.count_if(mine & ~acceptable(spec.ids)).alias(f"f{k}")]
    rows = bronze.observe(observed, *read)
    plans: dict[str, Callable[[], DataFrame]] = {
        "customers": lambda: silver_customers(rows, **common),
        "orders": lambda: silver_orders(rows, **common),
        "order_items": lambda: silver_items(
            rows,
            silver_rows(spark, orders_path, "order_id string") if orders_path else None,
            counted=bronze,
            rows=records,
            min_hot_rows=min_hot_rows,
            **common,
        ),
    }
    told = Observation()
    written = [F.count_if(F.col(lake.BATCH) == b).alias(f"b{k}") for k, b in enumerate(batches[:MOST_OBSERVED])]
    lake.write_silver_batch(
        plans[table](), silver_path, spec.partition_by, batch_id=batch_id, gather=spec.gather, told=told, metrics=written
    )
    if repeated:
        unpack(spark, silver_path, batch_id)
    counts = _counted(spark, observed, told, bronze, batches, spec.ids, records, silver_path, batch_id)
    seconds = (datetime.now() - started).total_seconds()

    def total(name: str) -> int:
        return sum(row[name] for row in counts.values())

    read, written = total("records_input"), total("records_output")
    stats = SilverStats(
        batches=tuple(batches),
        records_input=read,
        records_filtered=total("records_filtered"),
        records_deduplicated=total("records_deduplicated"),
        records_output=written,
        data_quality_score=written / read * 100 if read else 0.0,
        duration_seconds=seconds,
        records_per_second=written / seconds if seconds > 0 else 0.0,
    )
    if audit is not None:
        audit.log("silver_batch_log", [
            {
                "batch_id": batch_id, "source_batch_id": source, "table_name": table,
                **{c: row[c] for c in ("records_input", "records_output", "records_filtered", "records_deduplicated")},
                "records_standardized": row["records_output"], "transformation_rules_applied": spec.steps,
                "processing_duration_seconds": seconds, "data_quality_score": row["data_quality_score"],
            }
            for source, row in sorted(counts.items())
        ])
    return stats
