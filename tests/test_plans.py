"""The plans must keep their shape: no cross joins, no Python, pruned scans, hot keys folded or split."""

import contextlib
import re

import pytest
from pyspark.sql import functions as F

from lakemart.operators.contracts import annotate, first_positions, repeated_counts
from lakemart.operators.dedup import keep_first
from lakemart.plans import marts
from lakemart.plans.star_queries import QUERIES
from lakemart.sources.lake import POSITION, Workspace, latest_partition, with_position
from lakemart.sources.model import TableContract

SMALLEST = "/root/testdata/sf0.001"
LAZY = sorted(
    name
    for name in QUERIES
    if name.startswith(("silver_", "mart_", "fn_", "dedup_", "top", "stock_", "item_", "order_", "shippable", "returned"))
    and name not in ("silver_manifest", "silver_zone", "mart_returns", "mart_pipeline_runs", "mart_read_order")
)


def rows_of(frame):
    return sorted(map(tuple, frame.collect()))


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@contextlib.contextmanager
def settings(spark, **values):
    names = {key.replace("__", "."): value for key, value in values.items()}
    before = {key: spark.conf.get(key, None) for key in names}
    for key, value in names.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python_at_any_size(spark, name):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = plan(QUERIES[name](spark, SMALLEST))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text
    assert "BroadcastExchange" not in text  # no side is broadcast but by the planner, which checks its size


def test_dedup_limits_groups_before_the_shuffle(spark):
    text = plan(keep_first(spark.range(10).withColumn("k", F.col("id") % 3), ["k"], ["id"]))
    assert text.count("WindowGroupLimit") == 2


def test_scans_read_only_what_they_need(spark):
    text = plan(QUERIES["mart_funnel_conversion"](spark, SMALLEST))
    scan = re.search(r"FileScan parquet \[([^\]]*)\]", text).group(1)
    assert set(re.sub(r"#\d+L?", "", scan).split(",")) == {"event_id", "event_type", "ts", "user_id", "props"}


def test_key_sets_are_narrow(spark):
    frame = spark.range(100).selectExpr("id as n", "id % 7 as k", "string(id) as wide")
    rows = Workspace(spark).save(frame, "t")
    counts = repeated_counts(rows, "k")
    text = plan(first_positions(rows, "k", counts, ["n"]))
    assert all("wide" not in scan for scan in re.findall(r"FileScan parquet \[([^\]]*)\]", text))
    assert "SortAggregate" not in plan(counts)


def test_only_rows_of_repeated_keys_are_ordered(spark, tmp_path):
    """The order of a file position is no type for hash aggregation, so the bulk of the keys must not reach it."""
    spark.range(50_000).selectExpr("if(id < 20, 0, id) as k", "string(id) as wide").write.csv(str(tmp_path / "t"))
    space = Workspace(spark)
    rows = space.save(with_position(spark.read.csv(str(tmp_path / "t")).toDF("k", "wide")), "t")
    counts = space.save(repeated_counts(rows, "k"), "counts")
    assert counts.count() == 1
    text = plan(first_positions(rows, "k", counts, POSITION))
    assert text.count("SortAggregate") == 2
    assert "BroadcastHashJoin" in text


def test_wide_table_is_not_shuffled_when_key_sets_are_small(spark):
    space = Workspace(spark)
    rows = space.save(spark.range(5000).selectExpr("id as n", "id % 4990 as k", "id % 50 as p"), "rows")
    parent = space.save(spark.range(49).selectExpr("id as p"), "parent")
    contract = TableContract("t", unique=("k",), foreign_keys={"p": ("parent", "p")})
    result = annotate(rows, contract, {"parent": parent}, ["n"], space)
    text = plan(result.annotated)
    assert text.count("BroadcastHashJoin") == 2
    assert "hashpartitioning" not in text
    assert result.rejected().count() == 109


def test_latest_partition_prunes(spark, tmp_path):
    spark.range(10).selectExpr("id", "string(id % 3) as run_date").write.partitionBy("run_date").parquet(str(tmp_path / "t"))
    table = spark.read.schema("id bigint, run_date string").parquet(str(tmp_path / "t"))
    newest = latest_partition(spark, str(tmp_path / "t"), schema=table.schema)
    assert sorted(f.rsplit("/", 2)[1] for f in newest.inputFiles()) == ["run_date=2"] * len(newest.inputFiles())
    assert rows_of(newest) == [(2, "2"), (5, "2"), (8, "2")]


SKEW = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20KB",
    "spark__sql__shuffle__partitions": "16",
}


def test_hot_product_is_split_in_the_revenue_join(spark):
    space = Workspace(spark)
    items = space.save(
        spark.range(0, 60000, 1, 8).selectExpr(
            "string(id) as order_item_id", "id div 3 as order_id", "if(id % 3 = 0, 0, id % 5000) as product_id",
            "bigint(1) as quantity", "cast(rand(7) * 100 as decimal(18,2)) as net_sales",
        ),
        "items",
    )
    orders = space.save(
        spark.range(20000).selectExpr(
            "id as order_id", "id % 10 as customer_id", "date '2025-01-01' as order_date", "'x' as region",
            "'paid' as status",
        ),
        "orders",
    )
    products = space.save(spark.range(5000).selectExpr("id as product_id", "cast(1 as decimal(12,2)) as unit_cost"), "products")
    with settings(spark, **SKEW):
        frame = marts.revenue_daily({"products": products, "orders": orders, "order_items": items})
        row = frame.collect()
        text = plan(frame)
    assert row[0].total_orders == 20000
    assert "skew=true" in text


def test_hot_orphan_key_is_split_when_key_sets_are_large(spark):
    space = Workspace(spark)
    rows = space.save(
        spark.range(0, 60000, 1, 8).selectExpr("id as n", "if(id % 3 = 0, 0, id) as p", "uuid() as pad"), "rows"
    )
    parent = space.save(spark.range(1, 10).selectExpr("id as p"), "parent")
    contract = TableContract("t", foreign_keys={"p": ("parent", "p")})
    with settings(spark, **SKEW):
        frame = annotate(rows, contract, {"parent": parent}, ["n"], space).clean().select("n", "pad")
        assert len(frame.collect()) == 6
        text = plan(frame)
    assert "skew=true" in text
