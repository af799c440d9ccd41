"""Keep-first deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_first(frame: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """First row per key in ``order_by`` order (nulls last); null keys form one group.

    The rank-equals-one filter lets Catalyst put a group limit in front of the shuffle, so each map task sends at most
    one row per key and a hot key cannot pile up in one reducer.
    """
    order = [F.col(name).asc_nulls_last() for name in order_by]
    ranked = frame.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")
