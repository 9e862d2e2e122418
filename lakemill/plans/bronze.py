"""Landing file -> bronze table."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakemill.contracts import FeedContract
from lakemill.operators.audit import AuditLog, issues_from_rows
from lakemill.operators.drift import conform
from lakemill.operators.duplicates import HASH, mark_duplicates, with_landing_hash
from lakemill.operators.line_numbers import number_positions, with_positions
from lakemill.operators.lineage import add_bronze_lineage
from lakemill.operators.quality import validate
from lakemill.operators.skew import MIN_HOT_ROWS
from lakemill.sources import lake
from lakemill.sources.hash_index import HashIndex
from lakemill.sources.landing import drift_by_header, read_landing

LINE = "_bronze_source_line_number"


@dataclass(frozen=True)
class BronzeStats:
    records_total: int
    records_with_errors: int
    records_duplicate: int
    data_quality_score: float
    duration_seconds: float
    records_per_second: float
    schema_changes: dict


def located_rows(scan: DataFrame, contract: FeedContract) -> tuple[DataFrame, dict]:
    """The landing rows under the contract's columns, with content hash and scan position, and the schema changes found.
    The file of a row is kept if the scan tells it."""
    conformed, changes = conform(scan, contract.columns, [c for c in ("_file", "_block") if c in scan.columns])
    return with_positions(with_landing_hash(conformed)), changes


def bronze_rows(
    located: DataFrame,
    contract: FeedContract,
    *,
    batch_id: str,
    source_file: str,
    as_of: date,
    ingested_at: datetime | None = None,
    history: DataFrame | None = None,
    rows: int | None = None,
    min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """The rows of one bronze batch. ``source_file`` is their source where the rows don't know their own file.

    ``history``, ``rows``: see ``mark_duplicates``.
    """
    numbered = number_positions(located, LINE)
    marked = mark_duplicates(numbered, history, salt_by=LINE, counted=located, rows=rows, min_hot_rows=min_hot_rows)
    checked = validate(marked, contract.rules(as_of))
    stamped = add_bronze_lineage(
        checked,
        batch_id=batch_id,
        source_file=source_file,
        ingested_at=ingested_at,
        schema_version=contract.version,
    )
    return stamped.select(*contract.bronze_schema.names)


def counted(rows: DataFrame) -> tuple[DataFrame, Observation]:
    """The rows of a batch as they are written, and the statistics that the write then tells."""
    told = Observation()
    return rows.observe(
        told,
        F.count(F.lit(1)).alias("records_total"),
        F.count_if("_dq_has_errors").alias("records_with_errors"),
        F.count_if("_dq_is_duplicate").alias("records_duplicate"),
    ), told


def ingest(
    spark: SparkSession,
    contract: FeedContract,
    source: str | list[str],
    bronze_path: str,
    *,
    batch_id: str,
    as_of: date,
    ingested_at: datetime | None = None,
    min_hot_rows: int = MIN_HOT_ROWS,
    audit: AuditLog | None = None,
) -> BronzeStats:
    """Ingest one landing path, or some files, as one batch. Running it again replaces the batch.

    The landing files are read once, into a staging table next to the bronze table; line numbers and duplicates then
    need several passes over few columns of that. Whether content came before is asked of the hash index beside the
    table, not of its rows. The counts are told by the task that writes a row, so tasks that run again don't distort
    them. The batch is noted in the manifest at last: a batch that failed on its way isn't refined. With an audit the run
    is logged from start to end, also if it fails.
    """
    options = {"batch_id": batch_id, "as_of": as_of, "ingested_at": ingested_at, "min_hot_rows": min_hot_rows}
    if audit is None:
        return _ingest(spark, contract, source, bronze_path, **options)
    with audit.run(f"bronze-{contract.name}-{batch_id}", f"ingest_{contract.name}", bronze_batch_id=batch_id) as outcome:
        stats = _ingest(spark, contract, source, bronze_path, audit=audit, **options)
        _log(audit, contract, source, batch_id, stats)
        outcome["records_processed"] = stats.records_total
    return stats


def _ingest(
    spark: SparkSession, contract: FeedContract, source: str | list[str], bronze_path: str, *,
    batch_id: str, as_of: date, ingested_at: datetime | None, min_hot_rows: int, audit: AuditLog | None = None,
) -> BronzeStats:
    started = datetime.now()
    history = lake.existing_table(spark, bronze_path, contract.bronze_schema)
    index = HashIndex(spark, f"{bronze_path.rstrip('/')}_hashes")
    earlier = None
    if history is not None:
        if lake.noted_batches(spark, bronze_path) is None:  # a table from before there were manifests
            lake.make_manifest(spark, bronze_path, contract.bronze_schema)
        notes = lake.noted_batches(spark, bronze_path).where(F.col("bronze_batch") == batch_id)
        earlier = notes.first()
        if not index.exists():
            index.rebuild(history)
    if ingested_at is None:  # a repeated batch keeps its day, and so its partition
        ingested_at = earlier["ingested_at"] if earlier else started
    scan, found = read_landing(spark, source, files=True)
    located, changes = located_rows(scan, contract)
    changes = changes | {"headers": drift_by_header(found, contract.columns)}
    staging = f"{bronze_path.rstrip('/')}_staging/{batch_id}"
    told = Observation()
    landed = lake.staged(located.observe(told, F.count(F.lit(1)).alias("rows")), f"{staging}/rows")
    seen = index.first_seen(landed.select(HASH).distinct(), f"{staging}/hashes", before=(ingested_at, batch_id))
    rows, counts = counted(bronze_rows(
        landed,
        contract,
        batch_id=batch_id,
        source_file=str(source),
        as_of=as_of,
        ingested_at=ingested_at,
        history=seen,
        rows=(lake.told(told) or {"rows": 0})["rows"],
        min_hot_rows=min_hot_rows,
    ))
    lake.write_bronze_batch(rows, bronze_path)
    if audit is not None:  # from the staged rows, which are still there
        issues = issues_from_rows(landed.select(*contract.columns), contract.key, contract.rules(as_of))
        audit.log_issues(batch_id, "bronze", contract.name, issues)
    lake.drop_folder(spark, staging)
    table = lake.read_table(spark, bronze_path, contract.bronze_schema)
    stored = lake.one_batch(table, batch_id)
    first = stored.where(~F.col("_dq_is_duplicate")).select(HASH).distinct()
    first = first.select(HASH, F.lit(ingested_at).cast("timestamp").alias("first_at"), F.lit(batch_id).alias("first_batch"))
    if earlier is None:
        index.add(first, batch_id)
    else:
        index.replace(first, batch_id, table.filter(F.col(lake.BATCH) != batch_id))
    counts = lake.told(counts) or dict.fromkeys(("records_total", "records_with_errors", "records_duplicate"), 0)
    total, bad = counts["records_total"], counts["records_with_errors"]
    lake.note_batch(spark, bronze_path, batch_id, ingested_at, total)
    seconds = (datetime.now() - started).total_seconds()
    stats = BronzeStats(
        **counts,
        data_quality_score=(total - bad) / total * 100 if total else 0.0,
        duration_seconds=seconds,
        records_per_second=total / seconds if seconds > 0 else 0.0,
        schema_changes=changes,
    )
    return stats


def _log(
    audit: AuditLog, contract: FeedContract, source: str | list[str], batch_id: str, stats: BronzeStats
) -> None:
    changes = stats.schema_changes
    audit.log("bronze_batch_log", [{
        "batch_id": batch_id, "table_name": contract.name, "source_file_path": source if isinstance(source, str) else ",".join(source),
        **{c: getattr(stats, c) for c in ("records_total", "records_with_errors", "records_duplicate", "data_quality_score")},
        "processing_duration_seconds": stats.duration_seconds, "schema_version": contract.version,
        "schema_changes_detected": bool(changes.get("has_changes")), "schema_changes_detail": changes, "write_mode": "append",
    }])
    columns = [c for c in contract.columns if c not in changes["missing_columns"]] + changes["new_columns"]
    audit.log_schema_changes(contract.name, "bronze", columns, start=contract.columns, batch_id=batch_id)
