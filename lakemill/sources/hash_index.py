"""A stored index of record hashes: which batch brought a content first.

``entries`` holds a row per hash with the batch that brought it first, in a folder per batch and hash prefix, each file
sorted by hash. ``filters`` holds Bloom filters of them, one per batch, folded into one from time to time. A new batch is
tested against the filter, which tells nearly all new hashes, and only what passes is looked up in the entries. So neither
the bronze table nor the index is shuffled for a batch with few repeats, however large the history is.

Each batch adds the hashes that no earlier batch has. A batch that is stored again replaces its own entries; where hashes
went from it that later batches have too, those are named from the bronze table (``readopt``).
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakemill.operators import blooms
from lakemill.sources import lake

HASH = "_bronze_record_hash"
STAMP = "_bronze_ingestion_timestamp"
ENTRIES = f"{HASH} string, first_at timestamp, first_batch string, segment string, prefix string"
FILTERS = "bucket bigint, bits binary, hashes bigint, segment string"
#: Bitmaps of a new index (32 MB of filter at most, 24 million hashes); batches whose filters are folded together.
BUCKETS, FOLD = 8_192, 8
#: Hashes that may pass the filter for the lookup to be broadcast (about 100 bytes each).
MOST_BROADCAST = 500_000


class HashIndex:
    """The index under one folder. ``buckets`` must stay the same for a folder."""

    def __init__(self, spark: SparkSession, path: str, *, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def entries(self) -> DataFrame | None:
        return lake.existing_table(self.spark, f"{self.path}/entries", ENTRIES)

    def filters(self) -> DataFrame | None:
        return lake.existing_table(self.spark, f"{self.path}/filters-{self.buckets}", FILTERS)

    def exists(self) -> bool:
        return self.filters() is not None

    def add(self, firsts: DataFrame, batch_id: str) -> None:
        """Store (hash, first_at, first_batch), one row per hash, as what a batch adds; earlier entries of it go."""
        lake.drop_folder(self.spark, f"{self.path}/entries/segment={lake.folder_name(self.spark, batch_id)}")
        self._append(firsts)
        added = lake.read_table(self.spark, f"{self.path}/entries", ENTRIES).where(F.col("segment") == batch_id)
        self._write_filter(blooms.build(added, HASH, self.buckets), batch_id)

    def _append(self, firsts: DataFrame) -> None:
        """Add entries to the folders of their batches, each file sorted by hash."""
        segment, prefix = F.col("first_batch").alias("segment"), F.substring(HASH, 1, 1).alias("prefix")
        rows = firsts.select(HASH, "first_at", "first_batch", segment, prefix).hint("rebalance", "segment", "prefix")
        rows = rows.sortWithinPartitions("segment", "prefix", HASH)
        rows.write.mode("append").partitionBy("segment", "prefix").parquet(f"{self.path}/entries")

    def _write_filter(self, bloom: DataFrame, name: str) -> None:
        folder = f"{self.path}/filters-{self.buckets}/segment={lake.folder_name(self.spark, name)}"
        rows = bloom.select("bucket", "bits", F.bitmap_count("bits").alias("hashes"))
        rows.coalesce(8).write.mode("overwrite").parquet(folder)

    def fold(self) -> None:
        """Unite the filters of many batches. A crash in between leaves bits twice, which changes nothing."""
        filters = self.filters()
        segments = sorted(r[0] for r in filters.select("segment").distinct().collect()) if filters is not None else []
        if len(segments) < FOLD:
            return
        name = f"_folded-{uuid.uuid4().hex}"
        root = f"{self.path}/filters-{self.buckets}"
        self._write_filter(blooms.united(filters), name)
        for segment in segments:
            lake.drop_folder(self.spark, f"{root}/segment={lake.folder_name(self.spark, segment)}")

    def first_seen(self, own: DataFrame, staging: str, *, before: tuple[datetime, str] | None = None) -> DataFrame | None:
        """The earliest batch of each of these hashes that an earlier batch has: hash, ``_dq_duplicate_of_batch``.

        Null if no hash has one. What passes the filter is written to ``staging``, which tells its size: up to
        MOST_BROADCAST rows are broadcast, more are shuffled together with the entries. ``before``: moment and name of
        the asking batch, whose own and later entries don't count.
        """
        entries, filters = self.entries(), self.filters()
        if entries is None or filters is None:
            return None
        small = self.buckets <= blooms.MOST_BUCKETS
        maybe = blooms.passing(own.select(HASH), HASH, blooms.united(filters), self.buckets, broadcast=small)
        told = Observation()
        maybe = maybe.withColumn("prefix", F.substring(HASH, 1, 1)).observe(told, F.count(F.lit(1)).alias("rows"))
        maybe = lake.staged(maybe, staging)
        passed = (lake.told(told) or {"rows": 0})["rows"]
        if passed == 0:
            return None
        if before is not None:
            at, batch = F.lit(before[0]).cast("timestamp"), F.lit(before[1])
            entries = entries.where((F.col("first_at") < at) | (F.col("first_at") == at) & (F.col("first_batch") < batch))
        side = F.broadcast(maybe) if passed <= MOST_BROADCAST else maybe
        found = entries.join(side, ["prefix", HASH], "left_semi")
        earliest = F.min(F.struct("first_at", "first_batch")).getField("first_batch")
        return found.groupBy(HASH).agg(earliest.alias("_dq_duplicate_of_batch"))

    def rebuild(self, bronze: DataFrame) -> None:
        """Make the index of a bronze table that has none: one pass over its hashes."""
        self._name(bronze)

    def _name(self, rows: DataFrame) -> None:
        """Add entries for the hashes of bronze rows, each under the batch that has it first."""
        firsts = rows.groupBy(HASH).agg(F.min(F.struct(STAMP, lake.BATCH)).alias("f"))
        firsts = firsts.select(HASH, F.col(f"f.{STAMP}").alias("first_at"), F.col(f"f.{lake.BATCH}").alias("first_batch"))
        name = uuid.uuid4().hex
        firsts = lake.staged(firsts, f"{self.path}/named-{name}")
        self._append(firsts)
        self._write_filter(blooms.build(firsts, HASH, self.buckets), f"_named-{name}")
        lake.drop_folder(self.spark, f"{self.path}/named-{name}")

    def replace(self, batch: DataFrame, batch_id: str, others: DataFrame) -> None:
        """Store a batch again: ``batch`` has (hash, first_at, first_batch) of what no earlier batch has.

        Hashes that were its own and went are named anew by the other batches, from the bronze rows ``others``.
        """
        old = self.entries().where(F.col("segment") == batch_id).select(HASH)
        staging = f"{self.path}/lost-{uuid.uuid4().hex}"
        lost = lake.staged(old.join(batch, HASH, "left_anti"), staging)
        self.add(batch, batch_id)
        if not lost.isEmpty():
            self._name(others.join(lost, HASH, "left_semi"))
        lake.drop_folder(self.spark, staging)
