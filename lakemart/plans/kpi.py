"""Console reads over marts: KPIs, top-k listings, reshapes and ad-hoc SQL."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions.scalars import TOTAL, ratio
from lakemart.plans import readonly
from lakemart.plans.marts import sort_keys
from lakemart.sources.lake import register_views

FUNNEL_STAGES = ("product_views", "add_to_cart", "checkout_starts", "purchase_events")


def executive(
    revenue: DataFrame, ltv: DataFrame, sla: DataFrame, scorecard: DataFrame, digits: int = 4
) -> DataFrame:
    """One row of headline numbers; each is zero when its source is empty.

    The on-time rate is the plain mean over SLA rows, not weighted by shipments. Mart rates have four digits, so they
    are averaged as exact decimals.
    """

    def number(frame: DataFrame, value: str) -> Column:
        return F.coalesce(frame.agg(F.expr(f"double({value})")).scalar(), F.lit(0.0))

    rate = "cast(on_time_rate as decimal(9,4))"
    return revenue.sparkSession.range(1).select(
        number(revenue, f"cast(sum(revenue) as {TOTAL})").alias("revenue"),
        number(revenue, "sum(total_orders)").alias("orders"),
        number(ltv, "count(1)").alias("customers"),
        number(sla, ratio(f"sum({rate})", f"count({rate})", digits)).alias("on_time_rate"),
        number(scorecard, "max(platform_score)").alias("platform_score"),
    )


def daily_revenue(revenue: DataFrame) -> DataFrame:
    return revenue.groupBy("order_date").agg(F.expr(f"cast(sum(revenue) as {TOTAL})").alias("revenue"))


def funnel_stages(funnel: DataFrame) -> DataFrame:
    """Stage totals, one row per stage."""
    totals = funnel.agg(*[F.sum(name).alias(name) for name in FUNNEL_STAGES])
    return totals.unpivot([], list(FUNNEL_STAGES), "stage", "events")


def risk_band_counts(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("risk_band").agg(F.count(F.lit(1)).alias("size"))


def top_revenue_days(revenue: DataFrame, limit: int = 25) -> DataFrame:
    newest = (F.col("order_date").desc_nulls_last(), F.col("revenue").desc_nulls_last(), F.col("region"))
    return revenue.select("order_date", "region", "revenue", "gross_margin_pct").orderBy(*newest).limit(limit)


def top_revenue(revenue: DataFrame, limit: int = 50) -> DataFrame:
    keys = (F.col("revenue").desc_nulls_last(), *sort_keys("mart_revenue_daily"))
    return revenue.orderBy(*keys).limit(limit)


def top_funnel(funnel: DataFrame, limit: int = 50) -> DataFrame:
    keys = (F.col("sessions").desc_nulls_last(), *sort_keys("mart_funnel_conversion"))
    return funnel.orderBy(*keys).limit(limit)


def top_inventory(inventory: DataFrame, limit: int = 75) -> DataFrame:
    return inventory.orderBy(*sort_keys("mart_inventory_risk")).limit(limit)


def sql(spark: SparkSession, query: str, marts: Mapping[str, DataFrame]) -> DataFrame:
    """Any query over the marts, registered as views under their names, and nothing but a query (``readonly``)."""
    register_views(marts)
    return readonly.query(spark, query, marts)
