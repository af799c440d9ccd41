"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.sources.lake import Workspace


def components(links: DataFrame, work: Workspace, name: str = "components") -> DataFrame:
    """(node, label) for every node of ``links`` (a, b); label is the smallest node of its component.

    Every round takes the smallest label among the neighbours and then the label of that label, so labels travel at
    doubling distance. Rounds are written tables; per round only changed rows are counted in the driver. A hub's
    neighbours are folded by a map-side combined minimum.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = work.save(both.where("a <> b").distinct(), f"{name}_edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
    labels = work.save(labels.select("node", F.least("node", "label").alias("label")), f"{name}_0")
    step = 0
    while True:
        step += 1
        near = both.join(labels.withColumnRenamed("node", "b"), "b").select(F.col("a").alias("node"), "label")
        told = near.withColumn("own", F.lit(None).cast("long")).unionByName(labels.withColumn("own", F.col("label")))
        moved = told.groupBy("node").agg(F.min("label").alias("label"), F.max("own").alias("old"))
        far = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        moved = moved.join(far, "label").select("node", "old", F.least("label", "far").alias("label"))
        moved = work.save(moved, f"{name}_{step}")
        work.drop(f"{name}_{step - 1}")
        if moved.where("old <> label").isEmpty():
            work.drop(f"{name}_edges")
            return moved.select("node", "label")
        labels = moved.select("node", "label")
