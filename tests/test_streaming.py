import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from lakemart.plans import silver
from lakemart.sources.model import stream_schema
from lakemart.streaming.landing import Landing, file_topic, parse_messages
from tests.conftest import rows


def event(i, **extra):
    base = dt.datetime(2026, 5, 18, tzinfo=dt.UTC) + dt.timedelta(seconds=3 * i)
    return {
        "event_id": f"e{i:02d}",
        "customer_id": "c1",
        "session_id": f"s{i % 3}",
        "event_ts": base.isoformat(),
        "event_type": "search",
        "product_id": "p1",
        "device": "web",
        "campaign": "email",
        "event_source": "stream",
        **extra,
    }


def drop(folder, name, events):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(e) + "\n" for e in events))


def consumed(landing):
    ledger = landing.ledger().orderBy("run_id")
    return [tuple(r) for r in ledger.select("events_consumed", "stream_offset_start", "stream_offset_end").collect()]


def test_a_run_takes_no_more_than_its_cap(spark, tmp_path):
    topic = tmp_path / "topic"
    drop(topic, "1.jsonl", map(event, range(12)))
    landing = Landing(spark, str(tmp_path / "landing"))
    schema = stream_schema()
    sizes = [landing.consume(file_topic(spark, str(topic), schema), 5) for _ in range(4)]
    assert sizes == [5, 5, 2, 0]
    assert consumed(landing) == [(5, 0, 5), (5, 5, 10), (2, 10, 12)]

    landed = landing.read(schema)
    assert landed.count() == 12
    assert rows(landed.where("event_id = 'e07'"), "stream_offset", "stream_offset_start", "stream_offset_end") == [(7, 5, 10)]
    fresh = landing.freshness().first()
    assert (fresh.topic, fresh.events_consumed, fresh.checkpoint) == ("commerce.events", 2, 12)
    assert fresh.latest_event_ts == dt.datetime(2026, 5, 18, 0, 0, 33)
    assert not list((tmp_path / "landing/inbox").glob("raw/*"))
    assert not list((tmp_path / "landing/inbox").glob("events/*"))


def test_new_files_follow_the_old_ones(spark, tmp_path):
    topic = tmp_path / "topic"
    landing = Landing(spark, str(tmp_path / "landing"))
    for number, (a, b) in enumerate([(0, 5), (5, 10), (10, 12), (12, 12)]):
        if b > a:
            drop(topic, f"{9 - number}.jsonl", map(event, range(a, b)))
        assert landing.consume(file_topic(spark, str(topic), stream_schema(), max_files=1)) == b - a
    assert rows(landing.read(stream_schema()), "event_id", "stream_offset") == [(f"e{i:02d}", i) for i in range(12)]


def test_nothing_landed_reads_as_no_rows(spark, tmp_path):
    landing = Landing(spark, str(tmp_path / "none"))
    assert landing.read(stream_schema()).count() == 0
    assert landing.freshness().count() == 0
    assert landing.rejects().count() == 0


BATCH = "event_id string, event_ts string"


def test_replayed_batch_lands_on_the_same_place(spark, tmp_path):
    landing = Landing(spark, str(tmp_path / "landing"))
    batch = spark.createDataFrame([("a", "2026-01-01T00:00:00+00:00")], BATCH)
    landing.receive(batch, 0)
    landing.receive(batch, 1)
    landing.receive(batch, 0)
    assert landing.release(batch.schema) == 2
    assert consumed(landing) == [(2, 0, 2)]
    assert rows(landing.read(batch.schema), "stream_offset") == [(0,), (1,)]


def test_lost_checkpoint_overwrites_nothing(spark, tmp_path):
    topic = tmp_path / "topic"
    drop(topic, "1.jsonl", map(event, range(13)))
    landing = Landing(spark, str(tmp_path / "landing"))
    landing.consume(file_topic(spark, str(topic), stream_schema()))
    (tmp_path / "landing/checkpoint").rename(tmp_path / "lost")
    drop(topic, "2.jsonl", map(event, range(20, 25)))
    landing.consume(file_topic(spark, str(topic), stream_schema()))
    landed = landing.read(stream_schema())
    assert consumed(landing) == [(13, 0, 13), (18, 13, 31)]
    assert landed.select("event_id").distinct().count() == 18


def test_broken_lines_are_kept_apart(spark, tmp_path):
    topic = tmp_path / "topic"
    drop(topic, "1.jsonl", map(event, range(3)))
    with (topic / "1.jsonl").open("a") as file:
        file.write('{"event_id": "cut\n\nno json\n')
    landing = Landing(spark, str(tmp_path / "landing"))
    assert landing.consume(file_topic(spark, str(topic), stream_schema())) == 3
    assert rows(landing.read(stream_schema()), "event_id") == [("e00",), ("e01",), ("e02",)]
    assert rows(landing.rejects(), "line") == [("no json",), ('{"event_id": "cut',)]


def test_compaction_keeps_every_run(spark, tmp_path):
    topic = tmp_path / "topic"
    drop(topic, "1.jsonl", map(event, range(12)))
    landing = Landing(spark, str(tmp_path / "landing"))
    stream = file_topic(spark, str(topic), stream_schema())
    landing.consume(stream, 5)
    landing.consume(stream, 3)
    before = rows(landing.read(stream_schema()))
    landing.compact()
    landing.compact()
    assert rows(landing.read(stream_schema())) == before
    landing.consume(stream)
    landing.compact()
    assert consumed(landing) == [(5, 0, 5), (3, 5, 8), (4, 8, 12)]
    assert landing.read(stream_schema()).count() == 12
    assert len(list((tmp_path / "landing").glob("events_merged/*"))) == 1
    assert not list((tmp_path / "landing").glob("events/run_id=*"))


def test_messages_keep_partition_and_offset(spark):
    values = [(b'{"event_id": "a"}', 0, 7), (b"broken", 1, 3)]
    messages = spark.createDataFrame(values, "value binary, partition int, offset long")
    out = parse_messages(messages, stream_schema())
    assert rows(out, "event_id", "_topic_source", "_topic_block", "_corrupt_record") == [
        ("a", "000000", 7, None), (None, "000001", 3, "broken"),
    ]


def test_earlier_line_of_a_repeated_event_stays(spark, tmp_path):
    topic = tmp_path / "topic"
    drop(topic, "1.jsonl", [event(k % 20, device=f"d{k:03d}", event_ts="2026-01-01T00:00:00+00:00") for k in range(200)])
    landing = Landing(spark, str(tmp_path / "landing"))
    landing.consume(file_topic(spark, str(topic), stream_schema()))
    batch = spark.createDataFrame([], stream_schema()).drop("event_source").withColumn("ingest_profile", F.lit(""))
    out = silver.web_events_with_stream(batch, landing.read(stream_schema()), ["event_ts"], profile="ci")
    assert rows(out, "event_id", "device", "ingest_profile") == [(f"e{k:02d}", f"d{k:03d}", "ci") for k in range(20)]


def test_unknown_and_absent_fields(spark, tmp_path):
    topic = tmp_path / "topic"
    lean = event(1)
    del lean["device"]
    drop(topic, "1.jsonl", [event(0, extra="x"), lean])
    landing = Landing(spark, str(tmp_path / "landing"))
    landing.consume(file_topic(spark, str(topic), stream_schema()))
    assert rows(landing.read(stream_schema()), "event_id", "device") == [("e00", "web"), ("e01", None)]


def test_stream_flows_into_silver_once_per_event(spark, tmp_path):
    topic = tmp_path / "topic"
    drop(topic, "1.jsonl", [event(0), event(1), event(1), event(2)])
    landing = Landing(spark, str(tmp_path / "landing"))
    landing.consume(file_topic(spark, str(topic), stream_schema()))
    batch = (
        spark.createDataFrame([event(0, device="batch")], stream_schema())
        .drop("event_source")
        .withColumns({"ingest_profile": F.lit("ci"), "ingest_run_date": F.lit("2026-05-18")})
    )
    out = silver.web_events_with_stream(batch, landing.read(stream_schema()), ["event_ts"], profile="ci")
    assert rows(out, "event_id", "device", "ingest_profile", "ingest_run_date") == [
        ("e00", "batch", "ci", "2026-05-18"), ("e01", "web", "ci", "stream"), ("e02", "web", "ci", "stream"),
    ]


def sizes_of(folder):
    return {p: p.stat().st_size for p in folder.rglob("*.parquet")}


def test_tiers_rewrite_each_event_a_few_times(spark, tmp_path):
    landing = Landing(spark, str(tmp_path / "landing"))
    written, fan, runs = 0, 4, 16
    for k in range(runs):
        landing.receive(spark.createDataFrame([(f"e{j}", None) for j in range(5 * k, 5 * k + 5)], BATCH), k)
        assert landing.release(spark.createDataFrame([], BATCH).schema) == 5
        before = set(sizes_of(tmp_path / "landing/events_merged"))
        landing.compact(fan)
        fresh = set(sizes_of(tmp_path / "landing/events_merged")) - before
        written += sum(spark.read.parquet(str(p)).count() for p in fresh)
        assert len(landing._segments("events")) <= (fan - 1) * 3
    assert written <= 5 * runs * 2  # log to the base of 4 of 16
    got = landing.read(spark.createDataFrame([], BATCH).schema)
    assert rows(got, "event_id", "stream_offset", "run_id") == rows(
        spark.createDataFrame([(f"e{j}", j, j // 5) for j in range(5 * runs)], "event_id string, stream_offset long, run_id long")
    )
    assert consumed(landing) == [(5, 5 * k, 5 * k + 5) for k in range(runs)]
    assert len(landing._segments("events")) == 1


def test_a_merge_that_was_cut_off_changes_nothing(spark, tmp_path, monkeypatch):
    landing = Landing(spark, str(tmp_path / "landing"))
    for k in range(4):
        landing.receive(spark.createDataFrame([(f"e{k}", None)], BATCH), k)
        landing.release(spark.createDataFrame([], BATCH).schema)
    schema = spark.createDataFrame([], BATCH).schema
    before = rows(landing.read(schema))
    with monkeypatch.context() as broken:
        broken.setattr("lakemart.streaming.landing.delete_folder", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            landing.compact(2)
    assert rows(landing.read(schema)) == before
    (tmp_path / "landing/events_merged/runs=0-9").mkdir()  # a merge that never ended has no _SUCCESS
    assert rows(landing.read(schema)) == before
    landing.compact(2)
    assert rows(landing.read(schema)) == before
    assert not list((tmp_path / "landing").glob("events/run_id=*"))


def test_events_count_once_their_run_stands_in_the_ledger(spark, tmp_path):
    landing = Landing(spark, str(tmp_path / "landing"))
    schema = spark.createDataFrame([], BATCH).schema
    landing.receive(spark.createDataFrame([("a", None)], BATCH), 0)
    landing.release(schema)
    ledger = tmp_path / "landing/ledger/run_id=0"
    ledger.rename(tmp_path / "aside")
    assert landing.read(schema).count() == 0
    assert landing.release(schema) in (0, 1)


def test_a_batch_is_read_back_for_its_numbers_only(spark, tmp_path):
    landing = Landing(spark, str(tmp_path / "landing"))
    batch = spark.range(6).selectExpr(
        "string(id) as event_id", "if(id = 4, 'cut', null) as _corrupt_record", "'a' as _topic_source", "0L as _topic_block"
    )
    spark.sparkContext.setJobGroup("receive", "one batch")
    try:
        landing.receive(batch, 0)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("receive")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 10  # 12 with a count over what was written
    assert [tuple(r) for r in landing.received().select("first_offset", "next_offset", "rejected").collect()] == [(0, 5, 1)]
