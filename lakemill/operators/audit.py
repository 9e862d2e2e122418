"""Audit log: batches, quality issues, schema changes and runs, with queries over them."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import date, datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType

from lakemill.functions.rules import Rule
from lakemill.operators.dedup import newest_per_key
from lakemill.operators.drift import source_columns
from lakemill.operators.quality import apply_rules
from lakemill.sources import lake

# Schemas of the audit tables.
SCHEMAS = {
    "bronze_batch_log": """
        batch_id string not null, table_name string not null, layer string not null,
        source_file_path string, ingestion_timestamp timestamp not null,
        ingestion_date date not null, records_total bigint not null,
        records_with_errors bigint not null, records_duplicate bigint not null,
        data_quality_score decimal(5,2), processing_duration_seconds decimal(10,2) not null,
        schema_version string, schema_changes_detected boolean not null,
        schema_changes_detail string, file_size_mb decimal(12,2), write_mode string,
        status string not null, error_message string, pipeline_version string,
        executed_by string, created_at timestamp not null""",
    "silver_batch_log": """
        batch_id string not null, source_batch_id string, table_name string not null,
        layer string not null, processing_timestamp timestamp not null,
        processing_date date not null, records_input bigint not null,
        records_output bigint not null, records_filtered bigint not null,
        records_deduplicated bigint not null, records_standardized bigint not null,
        transformation_rules_applied string, processing_duration_seconds decimal(10,2) not null,
        data_quality_score decimal(5,2), status string not null, error_message string,
        pipeline_version string, executed_by string, created_at timestamp not null""",
    "gold_batch_log": """
        batch_id string not null, source_batch_id string, table_name string not null,
        table_type string not null, layer string not null,
        processing_timestamp timestamp not null, processing_date date not null,
        records_inserted bigint not null, records_updated bigint not null,
        records_deleted bigint not null, scd_type2_updates bigint, aggregation_level string,
        business_rules_applied string, processing_duration_seconds decimal(10,2) not null,
        status string not null, error_message string, pipeline_version string,
        executed_by string, created_at timestamp not null""",
    "data_quality_issues": """
        issue_id bigint not null, batch_id string not null, layer string not null,
        table_name string not null, record_identifier string, error_type string not null,
        error_category string not null, error_field string not null, error_message string,
        error_value string, severity string not null, detected_at timestamp not null,
        created_at timestamp not null""",
    "schema_history": """
        schema_id bigint not null, table_name string not null, layer string not null,
        schema_version string not null, change_type string not null, change_detail string,
        detected_at timestamp not null, batch_id string, created_at timestamp not null""",
    "pipeline_execution": """
        execution_id string not null, pipeline_name string not null,
        execution_date date not null, start_timestamp timestamp not null,
        end_timestamp timestamp, duration_seconds decimal(10,2), bronze_batch_id string,
        silver_batch_id string, gold_batch_id string, status string not null,
        records_processed bigint, error_message string, triggered_by string,
        created_at timestamp not null""",
}


def audit_schema(table: str) -> StructType:
    return StructType.fromDDL(SCHEMAS[table])


def issues_from_bronze(bronze: DataFrame, key: str) -> DataFrame:
    """One row per rule violation stored in the JSON details of bronze rows."""
    errors = F.from_json("_dq_error_details", "array<string>")
    codes = F.concat(errors, F.from_json("_dq_warning_details", "array<string>"))
    found = bronze.filter((F.col("_dq_error_count") > 0) | (F.col("_dq_warning_count") > 0)).select(
        F.col(key).alias("record_identifier"),
        F.from_json("_bronze_raw_record", "map<string,string>").alias("_values"),
        F.col("_dq_error_count").alias("_errors"),
        F.posexplode(codes).alias("_pos", "code"),
    )
    split_at = F.instr("code", ":")
    field = F.substr(F.col("code"), split_at + 1)
    return found.select(
        "record_identifier",
        F.substring_index("code", ":", 1).alias("error_type"),
        field.alias("error_field"),
        F.col("code").alias("error_message"),
        F.col("_values")[field].alias("error_value"),
        F.when(F.col("_pos") < F.col("_errors"), "ERROR").otherwise("WARNING").alias("severity"),
    )


def issues_from_rows(rows: DataFrame, key: str, rules: Sequence[Rule]) -> DataFrame:
    """One row per violated rule of the rows as they landed, straight from the rules: no JSON is written or parsed."""
    checked = apply_rules(rows, rules)
    fields = source_columns(rows)
    values = F.create_map(*[x for c in fields for x in (F.lit(c), F.col(c).cast("string"))])
    found = checked.where((F.size("_dq_errors") > 0) | (F.size("_dq_warnings") > 0)).select(
        F.col(key).alias("record_identifier"), values.alias("_values"), F.size("_dq_errors").alias("_errors"),
        F.posexplode(F.concat("_dq_errors", "_dq_warnings")).alias("_pos", "code"),
    )
    field = F.substr(F.col("code"), F.instr("code", ":") + 1)
    return found.select(
        "record_identifier",
        F.substring_index("code", ":", 1).alias("error_type"),
        field.alias("error_field"),
        F.col("code").alias("error_message"),
        F.col("_values")[field].alias("error_value"),
        F.when(F.col("_pos") < F.col("_errors"), "ERROR").otherwise("WARNING").alias("severity"),
    )


def categorise(issues: DataFrame) -> DataFrame:
    """Add ``error_category`` from the start of the error type."""
    kind = F.col("error_type")
    return issues.withColumn(
        "error_category",
        F.when(kind.startswith("MISSING"), "MISSING")
        .when(kind.startswith("INVALID"), "INVALID")
        .when(kind.startswith("NEGATIVE"), "RANGE")
        .otherwise("OTHER"),
    )


def issue_rows(issues: DataFrame, batch_id: str, layer: str, table: str, at: datetime | None = None) -> DataFrame:
    """Rows for ``data_quality_issues``. The id is a hash of batch, table, record and code, so
    logging a batch again gives the same ids."""
    moment = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    stamped = categorise(issues).withColumns(
        {
            "batch_id": F.lit(batch_id),
            "layer": F.lit(layer),
            "table_name": F.lit(table),
            "issue_id": F.xxhash64(
                F.lit(batch_id), F.lit(table), "record_identifier", "error_message", "error_type", "error_field"
            ),
            "detected_at": moment,
            "created_at": moment,
        }
    )
    return stamped.select(*audit_schema("data_quality_issues").names)


def quality_trend(bronze_log: DataFrame, table: str, as_of: date, days: int = 7) -> DataFrame:
    recent = (F.col("table_name") == table) & (F.col("ingestion_date") >= F.lit(as_of - timedelta(days=days)))
    return (
        bronze_log.filter(recent)
        .select(
            "ingestion_date", "records_total", "records_with_errors",
            "data_quality_score", "processing_duration_seconds",
        )
        .orderBy(F.desc("ingestion_date"))
    )


def latest_executions(events: DataFrame) -> DataFrame:
    """Present state of every run: its last event; a finished state wins a tie."""
    return newest_per_key(
        events, "execution_id", "created_at", [F.col("end_timestamp").desc_nulls_last(), F.col("status")]
    )


def execution_performance(executions: DataFrame, name: str, as_of: date, days: int = 30) -> DataFrame:
    recent = (F.col("pipeline_name") == name) & (F.col("execution_date") >= F.lit(as_of - timedelta(days=days)))
    return (
        executions.filter(recent)
        .select("execution_date", "status", "duration_seconds", "records_processed", "triggered_by")
        .orderBy(F.desc("execution_date"))
    )


def batch_summary(bronze_log: DataFrame, silver_log: DataFrame, gold_log: DataFrame) -> DataFrame:
    """Bronze batches with the silver batches made from them and the gold batches made from those."""
    bronze = bronze_log.select(
        "batch_id", F.col("table_name").alias("bronze_table"), F.col("status").alias("bronze_status"),
        "records_total", "records_with_errors", "records_duplicate",
    )
    silver = silver_log.select(
        F.col("source_batch_id").alias("batch_id"), F.col("batch_id").alias("silver_batch_id"),
        F.col("table_name").alias("silver_table"), F.col("status").alias("silver_status"),
        "records_input", "records_output",
    )
    gold = gold_log.select(
        F.col("source_batch_id").alias("silver_batch_id"), F.col("batch_id").alias("gold_batch_id"),
        F.col("table_name").alias("gold_table"), F.col("status").alias("gold_status"), "records_inserted",
    )
    return bronze.join(silver, "batch_id", "left").join(gold, "silver_batch_id", "left")


def _money(value: float | Decimal | None, scale: int) -> Decimal | None:
    if value is None:
        return None
    return Decimal(str(value)).quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP)


# Logs whose rows belong to a batch of a table: logging it again replaces them.
PER_BATCH = ("bronze_batch_log", "silver_batch_log", "gold_batch_log", "data_quality_issues")
OWNER = ("batch_id", "table_name")


class AuditLog:
    """The six audit tables under one folder.

    Rows on a batch replace what an earlier run of the same batch logged; rows on runs and schema changes are appended.
    """

    def __init__(self, spark: SparkSession, root: str, *, executed_by: str = "spark", version: str = "1.0"):
        self.spark, self.root = spark, root.rstrip("/")
        self.executed_by, self.version = executed_by, version

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def create(self) -> list[str]:
        """Create the tables that do not exist yet; returns their names."""
        created = [t for t in SCHEMAS if not lake.table_exists(self.spark, self.path(t))]
        for table in created:
            self._write(table, self.spark.createDataFrame([], audit_schema(table)))
        return created

    def register(self) -> None:
        """Make the tables visible to SQL as ``metadata_<table>``."""
        for table in SCHEMAS:
            by = f"PARTITIONED BY ({', '.join(OWNER)})" if table in PER_BATCH else ""
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS metadata_{table} ({SCHEMAS[table]}) USING parquet {by} "
                f"LOCATION '{self.path(table)}'"
            )
            if by:
                self.spark.sql(f"MSCK REPAIR TABLE metadata_{table}")

    def table(self, name: str) -> DataFrame:
        """The rows of an audit table; none if nothing was logged to it."""
        schema = audit_schema(name)
        found = lake.existing_table(self.spark, self.path(name), schema)
        return self.spark.createDataFrame([], schema) if found is None else found.select(*schema.names)

    def _write(self, table: str, rows: DataFrame) -> None:
        writer = rows.write
        if table in PER_BATCH:
            writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*OWNER).parquet(self.path(table))
        else:
            writer.mode("append").parquet(self.path(table))

    def log(self, table: str, rows: Sequence[dict], at: datetime | None = None) -> None:
        """Write rows, all in one job. What a row leaves out is filled: times and days of the log with ``at``, layer,
        status, version and user; lists and dictionaries are written as JSON, amounts rounded to the column's scale."""
        if not rows:
            return
        at, schema = at or datetime.now(), audit_schema(table)
        usual = {"layer": table.split("_")[0], "status": "SUCCESS", "pipeline_version": self.version, "executed_by": self.executed_by}
        for field in schema.fields:
            if field.name in ("end_timestamp", "start_timestamp") or field.name in usual:
                continue
            if field.dataType.typeName() == "timestamp":
                usual[field.name] = at
            elif field.dataType.typeName() == "date":
                usual[field.name] = at.date()
            elif field.dataType.typeName() == "boolean":
                usual[field.name] = False

        def shown(value, field):
            if isinstance(field.dataType, DecimalType):
                return _money(value, field.dataType.scale)
            return json.dumps(value) if isinstance(value, (dict, list)) else value

        for row in rows:
            if unknown := set(row) - set(schema.names):
                raise KeyError(f"{table} has no column {sorted(unknown)}")
        values = [tuple(shown((usual | row).get(f.name), f) for f in schema.fields) for row in rows]
        self._write(table, lake.small_table(self.spark, values, schema))

    def log_issues(self, batch_id: str, layer: str, table: str, issues: DataFrame, at: datetime | None = None) -> int:
        """Write the issue rows of a batch and table in place of earlier ones; returns how many were written."""
        log = "data_quality_issues"
        own = "/".join(f"{c}={lake.folder_name(self.spark, v)}" for c, v in zip(OWNER, (batch_id, table), strict=True))
        lake.drop_folder(self.spark, f"{self.path(log)}/{own}")
        told = Observation()
        self._write(log, issue_rows(issues, batch_id, layer, table, at).observe(told, F.count(F.lit(1)).alias("rows")))
        return (lake.told(told) or {"rows": 0})["rows"]

    def log_schema_changes(
        self, table_name: str, layer: str, columns: Sequence[str], *, start: Sequence[str], batch_id: str,
        at: datetime | None = None,
    ) -> str:
        """Compare a batch's columns with the last stored set and log what changed, one row per kind; returns the version.

        ``start``: the set of version 1.0, before any change. The rows of one table, one per change, reach the driver. A
        batch that is logged again is compared with the set before it, and its rows have the same ids.
        """
        at, own = at or datetime.now(), (F.col("table_name") == table_name) & (F.col("layer") == layer)
        found, version = list(start), 0
        history = self.table("schema_history").where(own).dropDuplicates(["schema_id"])
        for row in sorted(history.collect(), key=lambda r: (r["detected_at"], r["schema_id"])):
            if row["batch_id"] == batch_id:  # as it was before this batch
                break
            names = json.loads(row["change_detail"])["columns"]
            found = [*found, *names] if row["change_type"] == "COLUMN_ADDED" else [c for c in found if c not in names]
            version = int(row["schema_version"].rsplit(".", 1)[1])
        changes = {"COLUMN_ADDED": sorted(set(columns) - set(found)), "COLUMN_REMOVED": sorted(set(found) - set(columns))}
        version = f"1.{version + any(changes.values())}"
        self.log("schema_history", [
            {"schema_id": int(hashlib.md5(f"{table_name}|{layer}|{batch_id}|{kind}".encode()).hexdigest()[:15], 16),
             "table_name": table_name, "layer": layer, "batch_id": batch_id,
             "schema_version": version, "change_type": kind, "change_detail": {"columns": names}}
            for kind, names in changes.items() if names
        ], at)
        return version

    @contextmanager
    def run(self, execution_id: str, pipeline_name: str, **batches: str) -> Iterator[dict]:
        """Log start and end of a run; a run that raises ends as FAILED with the error's text.

        The dictionary it gives takes ``records_processed``.
        """
        started = self._start(execution_id, pipeline_name)
        outcome: dict = {}
        try:
            yield outcome
        except Exception as error:
            self._complete(started, status="FAILED", error_message=str(error)[:1000], **batches)
            raise
        self._complete(started, **batches, **outcome)

    def _start(
        self, execution_id: str, pipeline_name: str, *, triggered_by: str = "MANUAL", at: datetime | None = None
    ) -> dict:
        at = at or datetime.now()
        row = {"execution_id": execution_id, "pipeline_name": pipeline_name, "start_timestamp": at, "triggered_by": triggered_by}
        self.log("pipeline_execution", [row | {"status": "RUNNING"}], at)
        return row | {"execution_date": at.date()}

    def start_execution(
        self, execution_id: str, pipeline_name: str, *, triggered_by: str = "MANUAL", at: datetime | None = None
    ) -> str:
        return self._start(execution_id, pipeline_name, triggered_by=triggered_by, at=at)["execution_id"]

    def complete_execution(
        self, execution_id: str, *, bronze_batch_id: str | None = None, silver_batch_id: str | None = None,
        gold_batch_id: str | None = None, records_processed: int | None = None, status: str = "SUCCESS",
        error_message: str | None = None, at: datetime | None = None,
    ) -> None:
        """Append the final state of a run that was started."""
        at = at or datetime.now()
        started = self.table("pipeline_execution").filter(
            (F.col("execution_id") == execution_id) & (F.col("status") == "RUNNING")
        ).orderBy(F.desc("start_timestamp")).first()
        if started is None:
            raise KeyError(f"execution was never started: {execution_id}")
        self._complete(
            started.asDict(), at=at, status=status, error_message=error_message, records_processed=records_processed,
            bronze_batch_id=bronze_batch_id, silver_batch_id=silver_batch_id, gold_batch_id=gold_batch_id,
        )

    def _complete(self, started: dict, *, at: datetime | None = None, status: str = "SUCCESS", **values) -> None:
        at = at or datetime.now()
        seconds = (at - started["start_timestamp"]).total_seconds()
        row = started | values | {"end_timestamp": at, "duration_seconds": seconds, "status": status, "created_at": at}
        self.log("pipeline_execution", [row], at)

    def executions(self) -> DataFrame:
        return latest_executions(self.table("pipeline_execution"))

    def quality_trend(self, table: str, as_of: date, days: int = 7) -> DataFrame:
        return quality_trend(self.table("bronze_batch_log"), table, as_of, days)

    def execution_performance(self, name: str, as_of: date, days: int = 30) -> DataFrame:
        return execution_performance(self.executions(), name, as_of, days)

    def batch_summary(self, batch_id: str) -> DataFrame:
        bronze = self.table("bronze_batch_log").filter(F.col("batch_id") == batch_id)
        return batch_summary(bronze, self.table("silver_batch_log"), self.table("gold_batch_log"))
