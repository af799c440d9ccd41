"""Join helpers on entity keys. Strategy is left to the planner and AQE, which knows sizes and splits hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows without a parent; a null key has none."""
    known = parent.select(F.col(parent_key).alias("_known"))
    return child.join(known, F.col(key) == F.col("_known"), "left_anti")


def members(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows that have a parent, each once."""
    known = parent.select(F.col(parent_key).alias("_known"))
    return child.join(known, F.col(key) == F.col("_known"), "left_semi")


def lookup(facts: DataFrame, key: str, table: DataFrame, table_key: str, *columns: str) -> DataFrame:
    """Facts with attribute columns of the matching row; unmatched facts stay with nulls."""
    attributes = table.select(F.col(table_key).alias("_lookup"), *columns)
    return facts.join(attributes, F.col(key) == F.col("_lookup"), "left").drop("_lookup")


def grid_gaps(stock: DataFrame, row: str, column: str, rows: DataFrame, columns: DataFrame) -> DataFrame:
    """Per row of a rows-by-columns grid: cells in the grid, filled and missing, without building the grid.

    Filled cells are counted from distinct pairs that lie inside the grid; the rest follows by subtraction.
    """
    pairs = stock.select(row, column).distinct()
    filled = members(pairs, column, columns, column).groupBy(row).agg(F.count(F.lit(1)).alias("filled"))
    width = columns.agg(F.count_distinct(column)).scalar()
    counted = rows.select(row).distinct().join(filled, row, "left")
    cells = counted.select(row, width.alias("cells"), F.coalesce("filled", F.lit(0)).alias("filled"))
    return cells.withColumn("missing", F.col("cells") - F.col("filled"))
