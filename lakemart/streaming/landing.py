"""Exactly-once landing of an event topic, and release of landed events run by run.

A streaming query receives what is new into an inbox: one folder per micro-batch, named after the query and the batch,
so a replay after a crash lands on the same files and a new query (after a lost checkpoint) never on those of an old
one. Lines that are no JSON are kept apart. Every event has an offset, its position in the topic, counted over all
batches. A run then releases the next events in offset order, at most as many as its cap, into a folder of its own and
writes a ledger row for them; freshness and offset columns are read from the ledger. Landing is stateless: late events
are kept, repeated ones are left to the exact dedup in silver.

A topic can be a folder into which finished files are dropped (``file_topic``), Kafka (``kafka_topic``), or a log that
producers append to (``Landing.consume_log``), whose capped runs read no more lines than their cap.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.session import delete_folder
from lakemart.sources import topic
from lakemart.sources.lake import folders, path_exists, read_or_empty

CORRUPT = "_corrupt_record"
SOURCE, BLOCK, ROW = "_topic_source", "_topic_block", "_topic_row"

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("profile", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("latest_event_ts", T.TimestampType()),
        T.StructField("events_consumed", T.LongType()),
        T.StructField("stream_offset_start", T.LongType()),
        T.StructField("stream_offset_end", T.LongType()),
        T.StructField("run_id", T.LongType()),
    ]
)
_INBOX_SCHEMA = T.StructType(
    [
        T.StructField("batch_key", T.StringType()),
        T.StructField("first_offset", T.LongType()),
        T.StructField("next_offset", T.LongType()),
        T.StructField("rejected", T.LongType()),
    ]
)


def file_topic(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None, source: str = "json"
) -> DataFrame:
    """Stream of the files dropped into a folder, with the place of each line; ``max_files`` caps one micro-batch.

    Spark remembers whole files, so a file must be complete when it appears; ``Landing.consume_log`` reads growing ones.
    """
    if source == "json":
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.readStream.schema(schema).option("columnNameOfCorruptRecord", CORRUPT)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    written = F.date_format("_metadata.file_modification_time", "yyyyMMddHHmmss.SSS")
    return reader.format(source).load(path).select(
        "*",
        F.concat_ws(" ", written, "_metadata.file_path").alias(SOURCE),
        F.col("_metadata.file_block_start").alias(BLOCK),
    )


def kafka_topic(
    spark: SparkSession, servers: str, topic: str, schema: T.StructType, max_events: int | None = None
) -> DataFrame:
    """Stream of JSON events from Kafka, with partition and offset as their place. Needs the connector package."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_events is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_events)
    return parse_messages(reader.load(), schema)


def parse_messages(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Events from rows with value, partition and offset; a value that is no JSON object is kept as corrupt."""
    source = F.lpad(F.col("partition").cast("string"), 6, "0")
    return _parsed(messages, F.col("value").cast("string"), schema, source, F.col("offset"))


def parse_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Events from the lines of a topic log, whose place is their file and first byte."""
    text = F.regexp_replace(F.col("value").cast("string"), r"[\r\n]+$", "")
    return _parsed(lines, text, schema, F.col("file"), F.col("place"))


def _parsed(rows: DataFrame, text: Column, schema: T.StructType, source: Column, block: Column) -> DataFrame:
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    event = F.from_json(text, with_corrupt, {"columnNameOfCorruptRecord": CORRUPT})
    return rows.select(event.alias("event"), source.alias(SOURCE), block.alias(BLOCK)).select("event.*", SOURCE, BLOCK)


Segment = tuple[int, int, str]  # first and last run of a folder, and its path


def _is_merged(path: str) -> bool:
    return path.split("/")[0].endswith("_merged")


class Landing:
    """Inbox, released events and their ledger below one folder."""

    def __init__(self, spark: SparkSession, folder: str, profile: str = "ci", topic: str = "commerce.events"):
        self.spark = spark
        self.folder = folder
        self.profile = profile
        self.topic = topic

    def _path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def consume(self, events: DataFrame, max_events: int | None = None) -> int:
        """Receive everything new, then release at most ``max_events``; returns the number of events released."""
        query = (
            events.writeStream.foreachBatch(self.receive)
            .option("checkpointLocation", self._path("checkpoint"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return self.release(events.drop(CORRUPT, SOURCE, BLOCK).schema, max_events)

    def consume_log(
        self,
        path: str,
        schema: T.StructType,
        max_events: int | None = None,
        piece: int = topic.PIECE,
        cell: int = topic.CELL_LINES,
    ) -> int:
        """Receive what was appended to a topic log, and release it; returns the number of events released.

        ``path`` is a file of JSON lines or a folder of such files, taken in the order of their names; it need not be
        there yet. With ``max_events`` the run reads just so many lines: the places of every ``cell``-th line are
        indexed once, by Spark, so the byte behind the last admitted line is found without reading the backlog again.
        A run that was killed is finished first, with the very lines it had planned, and admits no others.
        """
        known, complete = self._planned()
        until = topic.finished(path, known) if complete else known
        if complete and max_events is not None:
            until = self._admitted(path, known, until, max_events, piece, cell)
        if until != known or not complete:
            lines = topic.line_stream(self.spark, path, known, until, piece)
            return self.consume(parse_lines(lines, schema), max_events)
        return self.release(schema, max_events)

    def _planned(self) -> tuple[dict[str, int], bool]:
        """Positions up to which batches have been planned, and whether the last of them is complete."""
        planned = sorted(map(int, self._numbered("offsets")))
        if not planned:
            return {}, True
        text = self.spark.read.text(self._path(f"checkpoint/offsets/{planned[-1]}"), wholetext=True).first()[0]
        return json.loads(text.splitlines()[-1]), str(planned[-1]) in self._numbered("commits")

    def _numbered(self, name: str) -> set[str]:
        """Names of the numbered files in one folder of the checkpoint."""
        pattern = self.spark._jvm.org.apache.hadoop.fs.Path(self._path(f"checkpoint/{name}/[0-9]*"))
        found = pattern.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(pattern)
        return {str(status.getPath().getName()) for status in found or []}

    def _admitted(
        self, path: str, known: dict[str, int], ends: dict[str, int], most: int, piece: int, cell: int
    ) -> dict[str, int]:
        """Positions behind the next ``most`` lines, by the index of the lines that wait."""
        cells = self._index(path, known, ends, piece, cell)
        before = F.sum("lines").over(Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1))
        # One row for ``cell`` lines that wait, and only those up to the cap come to the driver as one row per file.
        placed = cells.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < most)
        whole = F.col("before") + F.col("lines") <= most
        reached = placed.groupBy("file").agg(
            F.max(F.when(whole, F.col("stop"))).alias("stop"),
            F.max(F.when(~whole, F.struct("start", "stop", (F.lit(most) - F.col("before")).alias("lines")))).alias("cut"),
        )
        until = dict(known)
        for row in reached.collect():
            until[row.file] = max(row.stop or 0, until.get(row.file, 0))
            if row.cut is not None:
                start = max(row.cut.start, until[row.file])
                until[row.file] = topic.place_after(path, row.file, start, row.cut.stop, row.cut.lines)
        return {name: place for name, place in sorted(until.items()) if place}

    def _index(self, path: str, known: dict[str, int], ends: dict[str, int], piece: int, cell: int) -> DataFrame:
        """Cells of the lines that wait, the first of them cut at what has been read. Only new bytes are indexed."""
        parts = folders(self.spark, self._path("index"), "part")
        whole = [p for p in parts if path_exists(self.spark, self._path(f"index/part={p}/_SUCCESS"))]
        paths = [self._path(f"index/part={p}") for p in whole]
        cells = self.spark.read.schema(topic.CELLS).parquet(*paths) if paths else None
        seen = dict(known)
        if cells is not None:
            for row in cells.groupBy("file").agg(F.max("stop").alias("stop")).collect():
                seen[row.file] = max(row.stop, seen.get(row.file, 0))
        if any(seen.get(name, 0) < end for name, end in ends.items()):
            fresh = topic.line_cells(self.spark, path, seen, ends, piece, cell)
            part = self._path(f"index/part={hashlib.sha256(json.dumps(seen, sort_keys=True).encode()).hexdigest()[:32]}")
            fresh.write.mode("overwrite").parquet(part)
            paths.append(part)
        if not paths:
            return self.spark.createDataFrame([], topic.CELLS)
        cells = self.spark.read.schema(topic.CELLS).parquet(*paths)
        read = self.spark.createDataFrame(sorted(known.items()), "file string, read long")
        waiting = cells.join(read, "file", "left").where(F.col("stop") > F.coalesce("read", F.lit(0)))
        return self._cut_cells(path, waiting)

    def _cut_cells(self, path: str, waiting: DataFrame) -> DataFrame:
        """Cells with the part that was read taken off: at most one a file has such a part."""
        partly = F.coalesce(F.col("read") > F.col("start"), F.lit(False))
        rows = []
        for row in waiting.where(partly).collect():
            lines = topic.count_lines(path, row.file, row.read, row.stop)
            rows.append((row.file, row.read, row.stop, lines))
        rest = waiting.where(~partly).select("file", "start", "stop", "lines")
        return rest.unionByName(self.spark.createDataFrame(rows, topic.CELLS)) if rows else rest

    # --- inbox ---------------------------------------------------------------------------------------------------

    def receive(self, batch: DataFrame, batch_id: int) -> None:
        """Write one micro-batch with its offsets; called again for the same batch it writes the same place."""
        key = f"{self._query_id()}-{batch_id:012d}"
        marked = batch
        for name, kind in ((CORRUPT, "string"), (SOURCE, "string"), (BLOCK, "bigint")):
            if name not in batch.columns:
                marked = marked.withColumn(name, F.lit(None).cast(kind))
        raw = self._path(f"inbox/raw/batch_key={key}")
        # Events and rejects are counted as they are written, so the batch is read back for its numbers only.
        counted = Observation()
        placed = marked.withColumn(ROW, F.monotonically_increasing_id()).observe(
            counted,
            F.count_if(F.col(CORRUPT).isNull()).alias("events"),
            F.count_if(F.col(CORRUPT).isNotNull()).alias("rejects"),
        )
        placed.write.mode("overwrite").parquet(raw)
        events, rejects = counted.get["events"], counted.get["rejects"]
        landed = self.spark.read.schema(marked.withColumn(ROW, F.lit(0).cast("bigint")).schema).parquet(raw)
        first = self._received_before(key)
        # Rows of one block are numbered without gaps, so blocks only (few rows) are ordered and added up.
        good = landed.where(F.col(CORRUPT).isNull())
        entry = [(key, first, first + events, rejects)]
        if events:
            self._number(good, first).write.mode("overwrite").parquet(self._path(f"inbox/events/batch_key={key}"))
        if rejects:
            bad = landed.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("line"), F.lit(key).alias("batch_key"))
            bad.write.mode("overwrite").parquet(self._path(f"rejects/part={key}"))
        entries = self.spark.createDataFrame(entry, _INBOX_SCHEMA)
        entries.write.mode("overwrite").parquet(self._path(f"inbox/log/part={key}"))
        delete_folder(self.spark, raw)

    @staticmethod
    def _number(rows: DataFrame, first: int) -> DataFrame:
        """Add ``stream_offset``: the position by source, block and row, from ``first`` on.

        Neighbouring blocks (bytes of a file, offsets of a Kafka partition) are counted together, 65,536 at a time, so
        the counts that one task adds up are few however many blocks there are.
        """
        rows = rows.withColumn("_stretch", F.shiftright(BLOCK, 16))
        place = [F.col(SOURCE).asc_nulls_first(), F.col("_stretch").asc_nulls_first()]
        counts = rows.groupBy(SOURCE, "_stretch").agg(F.count(F.lit(1)).alias("_n"))
        ahead = F.sum("_n").over(Window.orderBy(*place).rowsBetween(Window.unboundedPreceding, -1))
        starts = counts.select(
            F.col(SOURCE).alias("_s"), F.col("_stretch").alias("_b"), F.coalesce(ahead, F.lit(0)).alias("_before")
        )
        same = F.col(SOURCE).eqNullSafe(F.col("_s")) & F.col("_stretch").eqNullSafe(F.col("_b"))
        inside = F.row_number().over(Window.partitionBy(SOURCE, "_stretch").orderBy(BLOCK, ROW)) - 1
        numbered = rows.withColumn("_inside", inside).join(starts, same)
        offset = (F.lit(first) + F.col("_before") + F.col("_inside")).cast("bigint")
        return numbered.withColumn("stream_offset", offset).drop(
            "_s", "_b", "_before", "_inside", "_stretch", CORRUPT, SOURCE, BLOCK, ROW
        )

    def _query_id(self) -> str:
        """Id of the streaming query, from its checkpoint; ``direct`` where batches are handed over without one."""
        path = self._path("checkpoint/metadata")
        if not path_exists(self.spark, path):
            return "direct"
        return json.loads(self.spark.read.text(path).first()[0])["id"]

    def _log(self) -> DataFrame:
        return read_or_empty(self.spark, self._path("inbox/log"), _INBOX_SCHEMA)

    def _received_before(self, key: str) -> int:
        """The first offset of a batch: where it stood before if it is a replay, else behind all others."""
        row = self._log().agg(
            F.max(F.when(F.col("batch_key") == key, F.col("first_offset"))).alias("own"),
            F.max(F.when(F.col("batch_key") != key, F.col("next_offset"))).alias("others"),
        ).first()
        return row["own"] if row["own"] is not None else row["others"] or 0

    # --- release -------------------------------------------------------------------------------------------------

    def release(self, schema: T.StructType, max_events: int | None = None) -> int:
        """Hand the next received events over as one run; without any nothing is written."""
        done = self.ledger().agg(F.max("stream_offset_end"), F.max("run_id")).first()
        start, run = done[0] or 0, 0 if done[1] is None else done[1] + 1
        received = self._log().agg(F.max("next_offset")).first()[0] or 0
        end = received if max_events is None else min(received, start + max_events)
        if end <= start:
            return 0
        numbered = T.StructType([*schema.fields, T.StructField("stream_offset", T.LongType())])
        waiting = read_or_empty(self.spark, self._path("inbox/events"), numbered)
        chosen = waiting.where(F.col("stream_offset").between(start, end - 1)).withColumns(
            {"stream_offset_start": F.lit(start).cast("bigint"), "stream_offset_end": F.lit(end).cast("bigint")}
        )
        target = self._path(f"events/run_id={run}")
        chosen.write.mode("overwrite").parquet(target)
        facts = self.spark.read.parquet(target).agg(
            F.max(F.col("event_ts").try_cast("timestamp")).alias("latest_event_ts"),
            F.count(F.lit(1)).alias("events_consumed"),
        )
        row = facts.select(
            F.lit(self.profile).alias("profile"),
            F.lit(self.topic).alias("topic"),
            "latest_event_ts",
            "events_consumed",
            F.lit(start).cast("bigint").alias("stream_offset_start"),
            F.lit(end).cast("bigint").alias("stream_offset_end"),
        )
        row.write.mode("overwrite").parquet(self._path(f"ledger/run_id={run}"))
        self._forget(end)
        return end - start

    def _forget(self, end: int) -> None:
        """Delete inbox batches whose events have all been released; their log stays, for replays."""
        waiting = set(folders(self.spark, self._path("inbox/events"), "batch_key"))
        finished = self._log().where((F.col("next_offset") <= end) & F.col("batch_key").isin(sorted(waiting)))
        for row in finished.select("batch_key").collect():  # at most the folders listed just before
            delete_folder(self.spark, self._path(f"inbox/events/batch_key={row.batch_key}"))

    def compact(self, fan: int | None = None) -> None:
        """Merge the folders of finished runs; a merged folder counts from the moment it is complete.

        Without ``fan`` all runs become one folder. With it, whenever ``fan`` neighbouring folders hold runs of the same
        order of magnitude (1, fan, fan * fan ...), these become one, so over n runs an event is rewritten log(n) times
        and a reader meets fan * log(n) folders at most.
        """
        for name in ("events", "ledger"):
            while chosen := self._mergeable(self._segments(name), fan):
                first, last = chosen[0][0], chosen[-1][1]
                schema = self._read_segments(name, chosen).schema
                merged = self._read_segments(name, chosen, schema).hint("rebalance")
                merged.write.mode("overwrite").parquet(self._path(f"{name}_merged/runs={first}-{last}"))
            covered = self._segments(name)
            for _, _, path in self._complete(name):
                if path not in {p for _, _, p in covered}:
                    delete_folder(self.spark, self._path(path))

    @staticmethod
    def _mergeable(segments: list[Segment], fan: int | None) -> list[Segment]:
        """Neighbouring segments to merge next, none if there is nothing to do."""
        if fan is None:
            return segments if len(segments) > 1 or any(not _is_merged(path) for _, _, path in segments) else []

        def level(segment: Segment) -> int:
            runs, found = segment[1] - segment[0] + 1, 0
            while runs >= fan:
                runs, found = runs // fan, found + 1
            return found

        for k in range(len(segments) - fan + 1):
            part = segments[k : k + fan]
            if len({level(segment) for segment in part}) == 1:
                return part
        return []

    def _names(self, pattern: str) -> list[str]:
        """Parent folders of the files that match a pattern below this landing, relative to it."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(self._path(pattern))
        found = place.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(place)
        return ["/".join(str(s.getPath().getParent().toString()).rsplit("/", 2)[1:]) for s in found or []]

    def _complete(self, name: str) -> list[Segment]:
        """Complete folders of single and merged runs. Events count once their run stands in the ledger."""
        out = []
        for path in self._names(f"{name}/run_id=*/_SUCCESS"):
            run = int(path.rpartition("=")[2])
            out.append((run, run, path))
        for path in self._names(f"{name}_merged/runs=*/_SUCCESS"):
            first, last = path.rpartition("=")[2].split("-")
            out.append((int(first), int(last), path))
        if name == "events":
            known = [(first, last) for first, last, _ in self._complete("ledger")]
            out = [s for s in out if _is_merged(s[2]) or any(a <= s[0] and s[1] <= b for a, b in known)]
        return out

    def _segments(self, name: str) -> list[Segment]:
        """The folders that hold every run once, the widest ones first chosen, in the order of runs."""
        out, after = [], -1
        for first, last, path in sorted(self._complete(name), key=lambda s: (s[0], -s[1])):
            if first > after:
                out.append((first, last, path))
                after = last
        return out

    def _read_segments(self, name: str, segments: list[Segment], schema: T.StructType | None = None) -> DataFrame:
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        merged = [self._path(path) for _, _, path in segments if _is_merged(path)]
        single = [self._path(path) for _, _, path in segments if not _is_merged(path)]
        parts = [reader.parquet(*merged)] if merged else []
        if single:
            parts.append(reader.option("basePath", self._path(name)).parquet(*single))
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
        return rows.withColumn("run_id", F.col("run_id").cast("bigint"))

    # --- reading -------------------------------------------------------------------------------------------------

    def _runs(self, name: str, schema: T.StructType) -> DataFrame:
        segments = self._segments(name)
        return self._read_segments(name, segments, schema) if segments else self.spark.createDataFrame([], schema)

    def received(self) -> DataFrame:
        """One row per micro-batch: its offsets, and how many lines of it were no JSON."""
        return self._log()

    def ledger(self) -> DataFrame:
        return self._runs("ledger", LEDGER_SCHEMA)

    def read(self, schema: T.StructType) -> DataFrame:
        """All released events with their offset and the offsets of their run; no rows when nothing has landed."""
        more = [T.StructField(n, T.LongType()) for n in ("stream_offset", "stream_offset_start", "stream_offset_end", "run_id")]
        return self._runs("events", T.StructType([*schema.fields, *more]))

    def rejects(self) -> DataFrame:
        """Lines that were no JSON, as they stood in the topic."""
        schema = T.StructType([T.StructField("line", T.StringType()), T.StructField("batch_key", T.StringType())])
        return read_or_empty(self.spark, self._path("rejects"), schema)

    def freshness(self) -> DataFrame:
        """The last run that released events."""
        last = F.max_by(F.struct("latest_event_ts", "events_consumed", "stream_offset_end"), "run_id").alias("b")
        return (
            self.ledger()
            .where(F.col("events_consumed") > 0)
            .groupBy("profile", "topic")
            .agg(last)
            .select(
                "profile",
                "topic",
                "b.latest_event_ts",
                "b.events_consumed",
                F.col("b.stream_offset_end").alias("checkpoint"),
            )
        )
