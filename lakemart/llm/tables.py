"""Reading tables, intermediate tables and global order, shared by the corpus operators."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakemart.sources.lake import Workspace

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def workspace(spark: SparkSession) -> Workspace:
    """A new workspace; Python workers on this machine find the package wherever the session was started.

    On a cluster the package comes with ``--py-files`` or lies in the executors' PYTHONPATH.
    """
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{paths}:{root}".strip(":")
    return Workspace(spark)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_or_empty(column: str | Column = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def running_total(rows: DataFrame, keys: list[str], value: str, out: str, work: Workspace, name: str) -> DataFrame:
    """Add the sum of ``value`` over all rows before, in ascending order of ``keys``.

    The rows are cut into ranges of their keys and written; each range is summed by itself and only one total per
    range (as many as shuffle partitions) goes through a single task.
    """
    ranged = rows.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id())
    ranged = work.save(ranged, name)
    totals = ranged.groupBy("_part").agg(F.sum(value).alias("_sum"))
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_part", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    summed = ranged.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return (
        summed.join(F.broadcast(totals), "_part")
        .withColumn(out, F.col("_before") + F.col("_inside"))
        .drop("_part", "_before", "_inside")
    )
