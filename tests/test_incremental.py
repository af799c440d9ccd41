import random

import pytest
from pyspark.sql import functions as F

from lakemart.operators import distincts
from lakemart.operators.rank import placed
from lakemart.plans import silver
from lakemart.plans.incremental import EventBuckets
from lakemart.sources.lake import Workspace
from tests.conftest import rows

BATCH = "event_id string, event_ts timestamp, device string, ingest_profile string, ingest_run_date string, at int"
STREAM = "event_id string, event_ts string, device string, stream_offset long"


def runs(spark, seed, n=3):
    rng = random.Random(seed)
    offset, out = 0, []
    for run in range(n):
        ids = [rng.choice([None, *[f"e{k}" for k in range(30)]]) for _ in range(25)]
        batch = [(i, None, f"b{run}-{k}", "ci", f"r{run}", 100 * run + k) for k, i in enumerate(ids[:12])]
        stream = [(i, f"2024-01-0{1 + rng.randrange(9)}", f"s{run}-{k}", offset + k) for k, i in enumerate(ids[12:])]
        offset += len(stream)
        out.append((spark.createDataFrame(batch, BATCH), spark.createDataFrame(stream, STREAM)))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_runs_add_up_to_a_full_rebuild(spark, tmp_path, seed):
    store, seen = EventBuckets(spark, str(tmp_path / "events"), 8), []
    for batch, stream in runs(spark, seed):
        store.merge_batch(batch, stream, ["at"], "ci")
        seen.append((batch, stream))
        whole = [seen[0][0], seen[0][1]]
        for b, s in seen[1:]:
            whole = [whole[0].unionByName(b), whole[1].unionByName(s)]
        rebuilt = silver.web_events_with_stream(whole[0], whole[1], ["at"], profile="ci")
        assert rows(store.read(), *rebuilt.columns) == rows(rebuilt)


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    store = EventBuckets(spark, str(tmp_path / "events"), 16)
    batch, stream = runs(spark, 5)[0]
    store.merge_batch(batch, stream, ["at"], "ci")
    before = set(store.table.snapshot().folders)
    one = spark.createDataFrame([("e7", "2024-01-01", "late", 99)], STREAM)
    none = spark.createDataFrame([], BATCH)
    assert store.merge_batch(none, one, ["at"], "ci") == 1
    after = set(store.table.snapshot().folders)
    assert len(before - after) <= 1 and len(after - before) == 1
    assert store.merge_batch(none, spark.createDataFrame([], STREAM), ["at"], "ci") == 0
    again = rows(store.read())
    store.merge_batch(batch, stream, ["at"], "ci")
    assert rows(store.read()) == again


def test_sets_of_days_give_those_of_months(spark):
    table = [(d, r, None if k % 7 == 0 else (k * 37) % 90_001 - 500) for k in range(3000) for d, r in [(k % 60, "ns"[k % 2])]]
    facts = spark.createDataFrame(table, "day int, region string, person long")
    days = distincts.id_sets(facts, ("day", "region"), "person")
    months = days.withColumn("month", F.expr("day div 30"))
    got = {(r.month, r.region): r.people for r in distincts.counted(months, ("month", "region"), "people").collect()}
    wanted = {}
    for d, r, p in table:
        if p is not None:
            wanted.setdefault((d // 30, r), set()).add(p)
    assert got == {k: len(v) for k, v in wanted.items()}
    assert rows(distincts.counted(days, ("region",), "people")) == sorted(
        [(r, len({p for _, s, p in table if s == r and p is not None})) for r in "ns"], key=str
    )
    assert distincts.counted(distincts.id_sets(facts.where("false"), ("day",), "person"), ("day",), "n").count() == 0


def test_dictionary_numbers_are_dense_and_ordered(spark):
    space = Workspace(spark)
    facts = spark.createDataFrame([(v,) for v in ["b", "a", None, "c", "a", "", "é"]], "v string")
    numbers = distincts.numbered(facts, "v", space, "words", "n")
    assert rows(numbers) == sorted([("", 0), ("a", 1), ("b", 2), ("c", 3), ("é", 4)], key=str)


def test_places_without_a_single_task(spark):
    space = Workspace(spark)
    facts = spark.range(5000).selectExpr("id", "int(id * 7919 % 5000) as v")
    ranked = placed(facts, [F.col("v").desc(), F.col("id")], space, "ranked")
    assert rows(ranked, "v", "place") == sorted([(v, 5000 - v) for v in range(5000)], key=str)
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    assert all("_range" in line for line in plan.splitlines() if "row_number" in line)
    assert placed(facts.where("false"), [F.col("id")], space, "none").count() == 0
