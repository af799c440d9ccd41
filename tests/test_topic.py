import json
import random

import pytest

from lakemart.sources import topic
from lakemart.sources.model import stream_schema
from lakemart.streaming import landing as landing_module
from lakemart.streaming.landing import Landing, parse_messages
from tests.conftest import rows
from tests.test_streaming import consumed, event


def append(path, events):
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("a", encoding="utf-8") as file:
        file.writelines(json.dumps(e) + "\n" for e in events)


def ids(landing):
    return rows(landing.read(stream_schema()), "event_id", "stream_offset")


def test_appended_lines_are_read(spark, tmp_path):
    log, landing = tmp_path / "topic/commerce.events.jsonl", Landing(spark, str(tmp_path / "landing"))
    for a, b in ((0, 5), (5, 12), (12, 12)):
        append(log, map(event, range(a, b)))
        assert landing.consume_log(str(log), stream_schema()) == b - a
    assert consumed(landing) == [(5, 0, 5), (7, 5, 12)]
    assert ids(landing) == [(f"e{i:02d}", i) for i in range(12)]


def test_a_missing_topic_is_an_empty_one(spark, tmp_path):
    landing = Landing(spark, str(tmp_path / "landing"))
    assert landing.consume_log(str(tmp_path / "none.jsonl"), stream_schema()) == 0
    assert landing.consume_log(str(tmp_path / "none.jsonl"), stream_schema(), 5) == 0
    assert not (tmp_path / "landing").exists()
    (tmp_path / "topic").mkdir()
    assert landing.consume_log(str(tmp_path / "topic"), stream_schema()) == 0
    append(tmp_path / "none.jsonl", [event(1)])
    assert landing.consume_log(str(tmp_path / "none.jsonl"), stream_schema()) == 1


def test_an_unfinished_line_waits(spark, tmp_path):
    log, landing = tmp_path / "topic.jsonl", Landing(spark, str(tmp_path / "landing"))
    line = json.dumps(event(2))
    append(log, [event(0), event(1)])
    with log.open("a") as file:
        file.write(line[:20])
    assert landing.consume_log(str(log), stream_schema()) == 2
    with log.open("a") as file:
        file.write(line[20:])
    assert landing.consume_log(str(log), stream_schema()) == 0
    with log.open("a") as file:
        file.write("\r\n\n  \n")
    assert landing.consume_log(str(log), stream_schema()) == 1
    assert ids(landing) == [("e00", 0), ("e01", 1), ("e02", 2)]


def test_a_capped_run_reads_its_share_only(spark, tmp_path, monkeypatch):
    read = []
    monkeypatch.setattr(landing_module.Landing, "receive", _counting(landing_module.Landing.receive, read))
    log, landing = tmp_path / "topic", Landing(spark, str(tmp_path / "landing"))
    append(log / "a.jsonl", map(event, range(7)))
    append(log / "b.jsonl", map(event, range(7, 12)))
    for wanted in (5, 5, 2, 0):
        assert landing.consume_log(str(log), stream_schema(), 5, piece=300, cell=3) == wanted
    assert read == [5, 5, 2]
    assert ids(landing) == [(f"e{i:02d}", i) for i in range(12)]
    append(log / "a.jsonl", map(event, range(12, 20)))
    assert landing.consume_log(str(log), stream_schema(), 3, piece=300, cell=3) == 3
    append(log / "a.jsonl", map(event, range(20, 24)))
    assert landing.consume_log(str(log), stream_schema(), 100, piece=300, cell=3) == 9
    assert [i for i, _ in ids(landing)] == [f"e{i:02d}" for i in range(24)]
    assert [o for _, o in ids(landing)] == list(range(24))


def _counting(receive, read):
    def run(self, batch, batch_id):
        read.append(batch.count())
        receive(self, batch, batch_id)

    return run


@pytest.mark.parametrize("place", ["receive", "_received_before", "release"])
@pytest.mark.parametrize("cap", [None, 4])
def test_a_killed_run_loses_and_repeats_nothing(spark, tmp_path, monkeypatch, place, cap):
    log, landing = tmp_path / "topic.jsonl", Landing(spark, str(tmp_path / "landing"))
    append(log, map(event, range(6)))
    with monkeypatch.context() as broken:
        broken.setattr(Landing, place, _killed)
        with pytest.raises(Exception, match="killed"):
            landing.consume_log(str(log), stream_schema(), cap)
    append(log, map(event, range(6, 9)))
    sizes = [landing.consume_log(str(log), stream_schema(), cap) for _ in range(4)]
    assert sum(sizes) == 9
    assert cap is None or max(sizes) <= cap
    assert ids(landing) == [(f"e{i:02d}", i) for i in range(9)]


def _killed(*_):
    raise RuntimeError("killed")


def test_a_file_that_shrank_is_an_error(spark, tmp_path):
    log, landing = tmp_path / "topic.jsonl", Landing(spark, str(tmp_path / "landing"))
    append(log, map(event, range(3)))
    assert landing.consume_log(str(log), stream_schema()) == 3
    log.write_text(json.dumps(event(9)) + "\n")
    with pytest.raises(ValueError, match="topic.jsonl"):
        landing.consume_log(str(log), stream_schema())


def test_broken_lines_of_a_log_are_kept_apart(spark, tmp_path):
    log, landing = tmp_path / "topic.jsonl", Landing(spark, str(tmp_path / "landing"))
    append(log, map(event, range(2)))
    with log.open("a") as file:
        file.write('{"event_id": "cut\nno json\n')
    assert landing.consume_log(str(log), stream_schema()) == 2
    assert rows(landing.rejects(), "line") == [("no json",), ('{"event_id": "cut',)]


@pytest.mark.parametrize("seed", range(6))
def test_pieces_and_cells_cover_every_line_once(tmp_path, monkeypatch, seed):
    rng = random.Random(seed)
    monkeypatch.setattr(topic, "BUFFER", rng.choice([7, 64, 1 << 20]))
    lines = ["".join(rng.choices("ab é", k=rng.choice([0, 1, 5, 60]))) for _ in range(rng.randrange(40))]
    (tmp_path / "t.log").write_text("".join(line + "\n" for line in lines) + "open", encoding="utf-8")
    path = str(tmp_path / "t.log")
    ends = topic.finished(path, {})
    wanted = [line for line in lines if line.strip()]
    size = rng.choice([1, 3, 17, 1000])
    cut = topic.pieces(path, {}, ends, size)
    found = [v.decode().rstrip("\n") for p in cut for b in topic.read_lines(path, p, ends[p.file]) for v in b["value"].to_pylist()]
    assert found == wanted
    most = rng.choice([1, 4, 100])
    cells = [r for p in cut for b in topic.read_cells(path, p, ends[p.file], most) for r in b.to_pylist()]
    assert sum(c["lines"] for c in cells) == len(wanted)
    assert all(c["lines"] <= most for c in cells)
    assert all(topic.count_lines(path, "t.log", c["start"], c["stop"]) == c["lines"] for c in cells)
    assert not cells or (cells[0]["start"], cells[-1]["stop"]) == (0, ends["t.log"])
    if wanted:
        place = topic.place_after(path, "t.log", 0, ends["t.log"], len(wanted) // 2 + 1)
        assert topic.count_lines(path, "t.log", 0, place) == len(wanted) // 2 + 1


def test_kafka_events_are_numbered_side_by_side(spark, tmp_path):
    values = [(json.dumps(event(p * 8 + k)).encode(), p, 100 + 3 * k) for k in range(8) for p in range(10)]
    messages = spark.createDataFrame(values, "value binary, partition int, offset long")
    batch = parse_messages(messages, stream_schema())
    landing = Landing(spark, str(tmp_path / "landing"))
    landing.receive(batch, 0)
    assert landing.release(stream_schema()) == 80
    assert [o for _, o in ids(landing)] == list(range(80))
    assert [i for i, _ in sorted(ids(landing), key=lambda r: r[1])] == [f"e{k:02d}" for k in range(80)]
    numbered = Landing._number(batch.selectExpr("*", "monotonically_increasing_id() as _topic_row"), 0)
    plan = numbered._jdf.queryExecution().optimizedPlan().toString()
    whole = [line for line in plan.splitlines() if "Window [" in line and "row_number" in line]
    assert whole and all("_stretch" in line for line in whole)
