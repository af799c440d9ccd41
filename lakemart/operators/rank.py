"""Places in a total order over a whole table, without one task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.sources.lake import Workspace

_RANGE = "_range"


def placed(rows: DataFrame, order: Sequence[Column], space: Workspace, name: str, out: str = "place") -> DataFrame:
    """Add ``out``, the place from 1 on in ``order``, which must tell all rows apart.

    The rows are dealt out by ranges of the order and written as ``name``. Each range is ordered by itself; only the
    number of rows per range (as many numbers as shuffle partitions) is added up in a single task.
    """
    ranged = space.save(rows.repartitionByRange(*order).withColumn(_RANGE, F.spark_partition_id()), name)
    counts = ranged.groupBy(_RANGE).agg(F.count(F.lit(1)).alias("_rows"))
    ahead = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(_RANGE, F.coalesce(F.sum("_rows").over(ahead), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(_RANGE).orderBy(*order))
    return (
        ranged.withColumn("_inside", inside)
        .join(starts, _RANGE)
        .withColumn(out, F.col("_before") + F.col("_inside"))
        .drop(_RANGE, "_before", "_inside")
    )
