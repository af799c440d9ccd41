"""Silver events kept up to date run by run instead of being rebuilt.

The events lie in hash buckets of their id, as partitions of a versioned table. Every row keeps the place that made it
win (batch before stream, then offset or position), so a run reads and rewrites only the buckets that its new rows
fall into, whatever comes late or again. The result is that of a full rebuild over everything seen so far.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.operators.dedup import keep_first
from lakemart.plans import silver
from lakemart.sources.versions import VersionedTable

BUCKET = "_bucket"


class EventBuckets:
    """The current event of every id.

    ``buckets`` is fixed when the table is made: some megabytes of events each make small rewrites, and few enough
    buckets keep the files large.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 64):
        self.table = VersionedTable(spark, folder)
        self.buckets = buckets

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(BUCKET, F.pmod(F.xxhash64("event_id"), F.lit(self.buckets)).cast("int"))

    def merge(self, rows: DataFrame, order: Sequence[str]) -> int:
        """Take in raw events with their order columns; returns the number of buckets that were rewritten.

        Of rows that share an event id, seen now or earlier, the first in ``order`` is the current one (nulls last;
        null ids are one event). A row that ties with the current one changes nothing.
        """
        fresh = keep_first(self._bucketed(rows), ("event_id",), order)
        snapshot = self.table.snapshot()
        if snapshot is None:
            self.table.replace_partitions(fresh.withColumn("_seen", F.lit(0)), BUCKET)
            return len(self.table.snapshot().folders)
        touched = [row[0] for row in fresh.select(BUCKET).distinct().collect()]  # at most ``buckets`` numbers
        if not touched:
            return 0
        current = self.table.read(snapshot.version).where(F.col(BUCKET).isin(touched)).withColumn("_seen", F.lit(0))
        both = current.unionByName(fresh.withColumn("_seen", F.lit(1)), allowMissingColumns=True)
        # The current row comes first among equals, so replays leave the table as it is.
        merged = keep_first(both, ("event_id",), (*order, "_seen")).withColumn("_seen", F.lit(0))
        self.table.replace_partitions(merged, BUCKET)
        return len(touched)

    def merge_batch(self, batch: DataFrame, stream: DataFrame, row_order: Sequence[str], profile: str | None = None) -> int:
        """Take in what a run adds to the batch table and to the landed stream; either may be empty."""
        both = silver.union_stream(batch, stream, profile)
        return self.merge(both, (*silver.EVENT_ORDER, *row_order, "event_ts"))

    def read(self, late_before: str = silver.LATE_BEFORE) -> DataFrame:
        """The silver events, without another dedup."""
        rows = self.table.read().drop(BUCKET, "_seen", *silver.EVENT_ORDER)
        return silver.web_events(rows, late_before)
