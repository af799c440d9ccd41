from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakemart.session import work_folder
from lakemart.sources import lake
from lakemart.sources.lake import Workspace
from lakemart.sources.model import raw_schema
from tests.conftest import rows


def test_csv_reads_null_markers_and_quoted_text(spark, tmp_path):
    (tmp_path / "t.csv").write_text('id,x\n1,NA\n2,\n3,"say ""hi"", you"\n4,nan\n5,none\n')
    frame = lake.read_csv(spark, str(tmp_path / "t.csv"))
    assert rows(frame) == [("1", None), ("2", None), ("3", 'say "hi", you'), ("4", None), ("5", "none")]


def test_csv_columns_are_those_of_the_header(spark, tmp_path):
    (tmp_path / "t.csv").write_text("b,a\n1,2\n")
    assert lake.read_csv(spark, str(tmp_path / "t.csv")).columns == ["b", "a"]


def test_jsonl_skips_blank_lines_and_fills_absent_fields(spark, tmp_path):
    (tmp_path / "e.jsonl").write_text('{"event_id": "a", "other": 1}\n\n   \n{"event_id": "b", "device": "ios"}\n')
    frame = lake.read_jsonl(spark, str(tmp_path / "e.jsonl"), raw_schema("web_events"))
    assert rows(frame, "event_id", "device") == [("a", None), ("b", "ios")]


def test_row_numbers_follow_the_file_across_splits(spark, tmp_path):
    lines = "".join(f"{i},{'x' * (i % 7)}\n" for i in range(500))
    (tmp_path / "t.csv").write_text("id,pad\n" + lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        placed = Workspace(spark).save(lake.with_position(lake.read_csv(spark, str(tmp_path / "t.csv"))), "t")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert placed.select(lake.BLOCK).distinct().count() > 1
    numbered = lake.row_numbers(placed, placed)
    assert numbered.where(F.col("row_number") != F.col("id").cast("bigint")).count() == 0
    assert numbered.count() == 500


def test_partition_overwrite_keeps_other_partitions_and_latest_is_the_greatest(spark, tmp_path):
    path = str(tmp_path / "table")
    schema = "x int, run_date string"
    lake.write_partition(spark.createDataFrame([(1, "2026-05-17"), (2, "2026-05-18")], schema), path, "run_date")
    lake.write_partition(spark.createDataFrame([(3, "2026-05-18")], schema), path, "run_date")
    table = spark.read.schema(schema).parquet(path)
    assert rows(table) == [(1, "2026-05-17"), (3, "2026-05-18")]
    assert rows(lake.latest_partition(spark, path, schema=table.schema)) == [(3, "2026-05-18")]


def test_read_or_empty(spark, tmp_path):
    schema = spark.createDataFrame([], "x int, y string").schema
    assert lake.read_or_empty(spark, str(tmp_path / "none"), schema).count() == 0
    spark.createDataFrame([(1, "a")], schema).write.parquet(str(tmp_path / "some"))
    assert rows(lake.read_or_empty(spark, str(tmp_path / "some"), schema)) == [(1, "a")]


def test_latest_folder_is_the_greatest_name(spark, tmp_path):
    for day in ("2026-05-09", "2026-05-18", "2026-04-30"):
        (tmp_path / f"run_date={day}").mkdir()
    (tmp_path / "other=9999").mkdir()
    assert lake.latest_folder(spark, str(tmp_path)).endswith("run_date=2026-05-18")
    with pytest.raises(FileNotFoundError):
        lake.latest_folder(spark, str(tmp_path / "none"))


def test_absent_export_is_empty(spark, tmp_path):
    assert lake.read_csv_or_empty(spark, str(tmp_path / "none")).columns == []


def test_export_and_catalog_table(spark, tmp_path):
    frame = spark.createDataFrame([(1, "a"), (2, None)], "x int, y string")
    lake.write_export(frame, str(tmp_path / "mart"))
    assert spark.read.parquet(str(tmp_path / "mart/parquet")).count() == 2
    assert rows(lake.read_csv(spark, str(tmp_path / "mart/csv"))) == [("1", "a"), ("2", None)]
    lake.save_table(frame, "mart_t")
    lake.save_table(frame.where("x = 1"), "mart_t")
    assert spark.table("mart_t").count() == 1
    spark.sql("drop table mart_t")


def test_manifest_counts_every_table(spark):
    tables = {"a": spark.range(3), "b": spark.range(0)}
    assert rows(lake.manifest(tables, "ci", "run_date=1", "table_name", "n")) == [
        ("ci", "run_date=1", "a", 3),
        ("ci", "run_date=1", "b", 0),
    ]


def test_saved_tables_broadcast_by_their_real_size(spark):
    space = Workspace(spark)
    wide = space.save(spark.range(1000).withColumn("k", F.col("id") % 10), "wide")
    # Far beyond the broadcast limit by estimate, one row in truth.
    keys = wide.join(wide.toDF("a", "b"), F.col("k") == F.col("b")).groupBy("k").count().where("k = 3")
    saved = space.save_all({"keys": keys, "none": keys.where("false")})
    plan = wide.join(saved["keys"], "k", "left")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert saved["none"].count() == 0


def test_work_folder_lies_in_a_shared_place(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert work_folder(spark).startswith(base)

    class Unset:
        class conf:
            @staticmethod
            def get(key, default=None):
                return default if key == "spark.checkpoint.dir" else spark.conf.get(key)

        _jvm, _jsc = spark._jvm, spark._jsc

    assert work_folder(Unset).startswith(spark.conf.get("spark.sql.warehouse.dir"))


def test_files_with_another_header_fail_the_read(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t/1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "t/2.csv").write_text("b,a\nx,y\n")
    with pytest.raises(Exception, match="(?i)header"):
        lake.read_csv(spark, str(tmp_path / "t")).collect()


def test_a_broken_json_line_fails_the_read(spark, tmp_path):
    (tmp_path / "t.jsonl").write_text('{"a": "1"}\n\n{"a": \n')
    schema = spark.createDataFrame([], "a string").schema
    with pytest.raises(Exception, match="(?i)malformed"):
        lake.read_jsonl(spark, str(tmp_path / "t.jsonl"), schema).collect()


def test_glob_reads_the_matching_folders(spark, tmp_path):
    spark.range(6).selectExpr("id", "id % 3 as part").write.partitionBy("part").parquet(str(tmp_path / "t"))
    assert rows(lake.read_glob(spark, str(tmp_path / "t"), "part=[12]"), "id") == [(1,), (2,), (4,), (5,)]


def test_dropped_tables_and_closed_workspaces_are_gone(spark):
    space = Workspace(spark)
    space.save_all({"a": spark.range(3), "b": spark.range(3)})
    space.drop("a", "never")
    assert (lake.path_exists(spark, space.path("a")), lake.path_exists(spark, space.path("b"))) == (False, True)
    space.close()
    assert not lake.path_exists(spark, space.folder)


def test_no_machine_local_folders():
    package = Path(lake.__file__).resolve().parents[1]
    assert not [p for p in package.rglob("*.py") if "tempfile" in p.read_text()]
