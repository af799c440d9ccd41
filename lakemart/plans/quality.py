"""Quality rules over the contract summary, the manifests and the marts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions.scalars import TOTAL, half_up, holds, literal, quoted


# Thresholds and outputs a run must meet.
@dataclass(frozen=True)
class Rules:
    minimum_contract_score: int = 95
    maximum_late_event_rate: float = 0.05
    minimum_gold_marts: int = 9
    required_outputs: tuple[str, ...] = (
        "mart_revenue_daily.csv",
        "mart_customer_ltv.csv",
        "mart_funnel_conversion.csv",
        "mart_fulfillment_sla.csv",
        "contract_summary.csv",
        "silver_manifest.csv",
        "gold_manifest.csv",
    )


def _row(name: str, passed: str, observed: str, expected: str) -> list[str]:
    return [
        f"{literal(name)} as check_name",
        f"{holds(passed)} as passed",
        f"{observed} as observed",
        f"{literal(expected)} as expected",
    ]


def _number(value: str) -> str:
    """A number as plain text without trailing zeros."""
    return f"regexp_replace(string(cast({value} as decimal(38,4))), '[.]?0+$', '')"


def contract_floor(summary: DataFrame, rules: Rules = Rules()) -> DataFrame:
    limit = rules.minimum_contract_score
    low = summary.agg(F.expr("coalesce(min(quality_score), 0.0D)").alias("low"))
    return low.selectExpr(*_row("contract_quality_floor", f"low >= {limit}", _number("low"), f">= {limit}"))


def required_outputs(spark: SparkSession, present: Sequence[str], rules: Rules = Rules()) -> DataFrame:
    """One row per required output; ``present`` names the exports that exist (a list of names, not of rows)."""
    rows = [(name, name in set(present)) for name in rules.required_outputs]
    return spark.createDataFrame(rows, "name string, found boolean").selectExpr(
        "concat('required_export:', name) as check_name",
        "found as passed",
        "name as observed",
        "'present' as expected",
    )


def mart_count(gold_manifest: DataFrame, rules: Rules = Rules()) -> DataFrame:
    limit = rules.minimum_gold_marts
    counted = gold_manifest.agg(F.count(F.lit(1)).alias("n"))
    return counted.selectExpr(*_row("gold_mart_count", f"n >= {limit}", "string(n)", f">= {limit}"))


def late_event_rate(funnel: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The unrounded rate is compared, the rounded one reported; no events means a rate of zero."""
    limit = rules.maximum_late_event_rate
    rate = F.expr("coalesce(double(sum(late_events)) / nullif(double(sum(events)), 0.0D), 0.0D)")
    return funnel.agg(rate.alias("rate")).selectExpr(
        *_row("late_event_rate", f"rate <= {limit}D", _number(half_up("rate", 4)), f"<= {limit}")
    )


def positive_revenue(revenue: DataFrame) -> DataFrame:
    total = revenue.agg(F.expr(f"coalesce(cast(sum(revenue) as {TOTAL}), 0)").alias("total"))
    return total.selectExpr(*_row("positive_revenue", "total > 0", _number("total"), "> 0"))


def sla_bounds(sla: DataFrame) -> DataFrame:
    """Every rate lies in [0, 1]; a null rate fails, and so does an empty mart."""
    inside = F.expr(f"bool_and({holds('on_time_rate between 0 and 1')})")
    return sla.agg(inside.alias("inside")).selectExpr(*_row("sla_rate_bounds", "inside", "'0..1'", "all rows"))


def checks(
    summary: DataFrame,
    gold_manifest: DataFrame,
    revenue: DataFrame,
    funnel: DataFrame,
    sla: DataFrame,
    present: Sequence[str],
    rules: Rules = Rules(),
) -> DataFrame:
    """All checks, one row each: name, passed, observed, expected."""
    parts = [
        contract_floor(summary, rules),
        required_outputs(summary.sparkSession, present, rules),
        mart_count(gold_manifest, rules),
        late_event_rate(funnel, rules),
        positive_revenue(revenue),
        sla_bounds(sla),
    ]
    return reduce(DataFrame.unionByName, parts)


def scorecard(results: DataFrame) -> DataFrame:
    counted = results.agg(F.count(F.lit(1)).alias("checks_total"), F.count_if("passed").alias("checks_passed"))
    score = half_up("double(checks_passed) / nullif(double(checks_total), 0.0D) * 100.0D", 2)
    return counted.selectExpr(
        "checks_total",
        "checks_passed",
        "checks_total - checks_passed as checks_failed",
        f"coalesce({score}, 0.0D) as platform_score",
    )


def failed(results: DataFrame) -> DataFrame:
    return results.where("not passed")


def not_null(table: str, frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null count per column in one pass, one row per column."""
    counts = frame.agg(*[F.expr(f"count_if({quoted(c)} is null)").alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "null_rows").selectExpr(
        f"{literal(table)} as table_name", "column_name", "null_rows", "null_rows = 0 as passed"
    )
