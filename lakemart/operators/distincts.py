"""Exact distinct counts that can be added up: bitmaps of ids per group, merged from fine groups into coarse ones.

A set of ids is kept as bitmaps of 32,768 bits, one for each stretch of the id space that it touches. Merging is a
bitwise or, so the sets of days give those of months and regions without another look at the facts, which plain
distinct counts cannot do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions.scalars import quoted
from lakemart.operators.rank import placed
from lakemart.sources.lake import Workspace

STRETCH, BITS = "_stretch", "_bits"


def id_sets(rows: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """One bitmap per group and stretch of a whole-number column; nulls are in no set, negative numbers count too.

    Built by a map-side combined aggregate: a group that holds most rows travels as one bitmap per task and stretch.
    """
    known = rows.where(f"{quoted(column)} is not null")
    name = quoted(column)
    return known.groupBy(*keys, F.expr(f"bitmap_bucket_number(bigint({name}))").alias(STRETCH)).agg(
        F.expr(f"bitmap_construct_agg(bitmap_bit_position(bigint({name})))").alias(BITS)
    )


def rolled_up(sets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The sets of coarser groups, from those of finer ones."""
    return sets.groupBy(*keys, STRETCH).agg(F.expr(f"bitmap_or_agg({BITS})").alias(BITS))


def counted(sets: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Exact number of ids per group."""
    merged = rolled_up(sets, keys)
    return merged.groupBy(*keys).agg(F.expr(f"sum(bitmap_count({BITS}))").alias(out))


def numbered(rows: DataFrame, column: str, space: Workspace, name: str, out: str) -> DataFrame:
    """A dictionary of a column's values: the value and ``out``, dense numbers from 0 on in the order of the values.

    Equal values have equal numbers, so bitmaps of the numbers count values of any type. Nulls are left out. The
    distinct values are ordered by ranges, so no task sees all of them.
    """
    values = rows.where(f"{quoted(column)} is not null").select(column).distinct()
    ranked = placed(values, [F.col(quoted(column)).asc()], space, f"{name}_ranges", "_place")
    return space.save(ranked.select(column, (F.col("_place") - 1).alias(out)), name)
