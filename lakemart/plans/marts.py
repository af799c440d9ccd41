"""Gold marts over silver entities.

Facts are pre-aggregated on their join key before they meet the next table wherever the measures allow it. That keeps
what is shuffled narrow, folds a hot key on the map side before any join sees it, and turns the distinct order counts
into plain counts, because an order is one row after the first step. Stored marts carry no ORDER BY; ``ordered``
sorts one for reading or export.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions.scalars import COUNT, TOTAL, literal, ratio
from lakemart.sources.lake import Workspace

Tables = Mapping[str, DataFrame]


def _sum(value: str) -> Column:
    return F.expr(f"cast(sum({value}) as {TOTAL})")


COSTED = "_costed"
_PARTS = 4  # tasks over which the lines of one product are spread


def costed(rows: DataFrame, products: DataFrame) -> DataFrame:
    """Rows by product with its unit cost; ``_costed`` is true where the product is known, and null elsewhere.

    Order lines that carry these columns need no join by product for their revenue.
    """
    costs = products.select("product_id", "unit_cost", F.lit(True).alias(COSTED))
    return rows.join(costs, "product_id", "left").select(*rows.columns, "unit_cost", COSTED)


def revenue_daily(silver: Tables) -> DataFrame:
    """Revenue, profit and reach per order date and region, without cancelled orders."""
    items = silver["order_items"]
    if COSTED in items.columns:
        items = items.where(COSTED).select("order_id", "quantity", "net_sales", "unit_cost")
    else:
        costs = silver["products"].select("product_id", "unit_cost")
        items = items.select("order_id", "product_id", "quantity", "net_sales").join(costs, "product_id")
    per_order = items.groupBy("order_id").agg(
        _sum("net_sales").alias("net"),
        _sum(f"net_sales - cast(quantity as {COUNT}) * unit_cost").alias("profit"),
        F.count("net_sales").alias("items"),
    )
    grouped = (
        silver["orders"]
        .where("status <> 'cancelled'")
        .select("order_id", "customer_id", "order_date", "region")
        .join(per_order, "order_id")
        .groupBy("order_date", "region")
        .agg(
            F.count("order_id").alias("total_orders"),
            F.count_distinct("customer_id").alias("active_customers"),
            _sum("net").alias("revenue"),
            _sum("profit").alias("gross_profit"),
            F.sum("items").alias("items"),
        )
    )
    return grouped.selectExpr(
        "order_date",
        "region",
        "total_orders",
        "active_customers",
        "revenue",
        "gross_profit",
        f"{ratio('gross_profit', 'revenue', 4)} as gross_margin_pct",
        f"{ratio('revenue', 'items', 2)} as avg_item_revenue",
    )


def product_performance(silver: Tables) -> DataFrame:
    """Sales per product, cancelled orders included; products never sold stay with empty sums.

    The unit cost is one value per product, so profit follows from the summed quantity after the aggregation. A line
    whose sales are unknown has no profit either, so its quantity costs nothing.

    Pairs of product and order hardly ever repeat, so folding them on the map side would only make rows wider. Lines
    travel once, narrow, dealt out by product and a part of its orders: an order lies in one part, so distinct orders
    add up, and a hot product has several tasks.
    """
    lines = silver["order_items"].select(
        "product_id",
        "order_id",
        "quantity",
        "net_sales",
        "discount_pct",
        F.expr(f"pmod(hash(order_id), {_PARTS})").alias("_part"),
    )
    parts = (
        lines.repartition("product_id", "_part")
        .groupBy("product_id", "_part")
        .agg(
            F.count_distinct("order_id").alias("orders"),
            F.sum("quantity").alias("units_sold"),
            F.expr("sum(if(net_sales is null, null, quantity))").alias("priced_units"),
            _sum("net_sales").alias("revenue"),
            F.sum("discount_pct").alias("discount"),
            F.count("discount_pct").alias("lines"),
        )
    )
    sold = parts.groupBy("product_id").agg(
        F.sum("orders").alias("orders"),
        F.sum("units_sold").alias("units_sold"),
        F.sum("priced_units").alias("priced_units"),
        _sum("revenue").alias("revenue"),
        F.sum("discount").alias("discount"),
        F.sum("lines").alias("lines"),
    )
    return (
        silver["products"]
        .select("product_id", "sku", "category", "unit_cost")
        .join(sold, "product_id", "left")
        .selectExpr(
            "product_id",
            "sku",
            "category",
            "coalesce(orders, 0) as orders",
            "units_sold",
            "revenue",
            f"cast(revenue - cast(priced_units as {COUNT}) * unit_cost as {TOTAL}) as gross_profit",
            f"{ratio('discount', 'lines', 4)} as avg_discount_pct",
        )
    )


def inventory_risk(silver: Tables) -> DataFrame:
    """Stock rows with their risk band; the first band that fits counts."""
    homes = silver["warehouses"].select("warehouse_id", "region")
    kinds = silver["products"].select("product_id", "category")
    band = (
        "case when on_hand_units = 0 then 'stockout' when inventory_risk then 'reorder'"
        " when on_hand_units < reorder_point * 2 then 'watch' else 'healthy' end"
    )
    return (
        silver["inventory"]
        .join(homes, "warehouse_id")
        .join(kinds, "product_id")
        .selectExpr(
            "snapshot_date",
            "warehouse_id",
            "region",
            "product_id",
            "category",
            "on_hand_units",
            "reorder_point",
            "inventory_risk",
            f"{band} as risk_band",
        )
    )


def customer_ltv(silver: Tables) -> DataFrame:
    """Lifetime value per customer over orders that were not cancelled; customers without orders stay with zeros."""
    per_order = (
        silver["order_items"]
        .groupBy("order_id")
        .agg(_sum("net_sales").alias("net"), F.count("net_sales").alias("items"))
    )
    kept = silver["orders"].where("status <> 'cancelled'").select("order_id", "customer_id", "order_date")
    per_customer = (
        kept.join(per_order, "order_id", "left")
        .groupBy("customer_id")
        .agg(
            F.count("order_id").alias("orders"),
            _sum("net").alias("net"),
            F.sum("items").alias("items"),
            F.max("order_date").alias("last_order_date"),
        )
    )
    return (
        silver["customers"]
        .select("customer_id", "region", "acquisition_channel", "loyalty_tier")
        .join(per_customer, "customer_id", "left")
        .selectExpr(
            "customer_id",
            "region",
            "acquisition_channel",
            "loyalty_tier",
            "coalesce(orders, 0) as orders",
            f"coalesce(net, cast(0 as {TOTAL})) as lifetime_revenue",
            f"coalesce({ratio('net', 'items', 2)}, 0.0D) as avg_item_revenue",
            "last_order_date",
        )
    )


def funnel_conversion(silver: Tables) -> DataFrame:
    """Funnel stages per event date and campaign."""
    stages = {
        "product_views": "product_view",
        "add_to_cart": "add_to_cart",
        "checkout_starts": "checkout_start",
        "purchase_events": "purchase",
    }
    grouped = (
        silver["web_events"]
        .groupBy("event_date", "campaign")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.count_distinct("session_id").alias("sessions"),
            *[F.expr(f"count_if(event_type = '{kind}')").alias(name) for name, kind in stages.items()],
            F.count_if("is_late_event").alias("late_events"),
        )
    )
    return grouped.selectExpr(
        "event_date",
        "campaign",
        "events",
        "sessions",
        *stages,
        f"{ratio('purchase_events', 'sessions', 4)} as session_purchase_rate",
        "late_events",
    )


def fulfillment_sla(silver: Tables) -> DataFrame:
    """Delivery speed and punctuality per order date and carrier."""
    days = silver["orders"].select("order_id", "order_date")
    grouped = (
        silver["shipments"]
        .select("order_id", "carrier", "delivery_hours", "delivered_on_time", "shipping_cost")
        .join(days, "order_id")
        .groupBy("order_date", "carrier")
        .agg(
            F.count(F.lit(1)).alias("shipments"),
            _sum("delivery_hours").alias("hours"),
            F.count("delivery_hours").alias("delivered"),
            F.count_if("delivered_on_time").alias("on_time"),
            _sum("shipping_cost").alias("shipping_cost"),
        )
    )
    return grouped.selectExpr(
        "order_date",
        "carrier",
        "shipments",
        f"{ratio('hours', 'delivered', 2)} as avg_delivery_hours",
        f"{ratio('on_time', 'shipments', 4)} as on_time_rate",
        "shipping_cost",
    )


def returns(silver: Tables) -> DataFrame:
    """Refunds per category and reason; folded per product before the product join."""
    lines = silver["order_items"].select("order_item_id", "product_id")
    per_product = (
        silver["returns"]
        .select("order_item_id", "reason", "refund_amount")
        .join(lines, "order_item_id")
        .groupBy("product_id", "reason")
        .agg(
            F.count(F.lit(1)).alias("returns"),
            _sum("refund_amount").alias("refunded"),
            F.count("refund_amount").alias("refunds"),
        )
    )
    return (
        per_product.join(silver["products"].select("product_id", "category"), "product_id")
        .groupBy("category", "reason")
        .agg(
            F.sum("returns").alias("returns"),
            _sum("refunded").alias("refunded_amount"),
            F.sum("refunds").alias("refunds"),
        )
        .selectExpr(
            "category",
            "reason",
            "returns",
            "refunded_amount",
            f"{ratio('refunded_amount', 'refunds', 2)} as avg_refund",
        )
    )


def data_freshness(silver: Tables, profile: str, run_partition: str) -> DataFrame:
    """Newest time stamp and row count of the three moving sources."""
    sources = {"orders": "order_ts", "payments": "payment_ts", "web_events": "event_ts"}
    parts = [
        silver[name]
        .agg(F.max(ts).alias("max_observed_ts"), F.count(F.lit(1)).alias("rows_loaded"))
        .selectExpr(
            f"{literal(profile)} as profile",
            f"{literal(run_partition)} as run_partition",
            f"{literal(name)} as source_name",
            "max_observed_ts",
            "rows_loaded",
        )
        for name, ts in sources.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def pipeline_runs(silver: Tables, gold: Tables, profile: str, run_partition: str) -> DataFrame:
    """One row per run, from scalar subqueries over silver and over marts built before."""

    def rows(frame: DataFrame) -> Column:
        return frame.agg(F.count(F.lit(1))).scalar()

    spark = silver["orders"].sparkSession
    return spark.range(1).select(
        F.lit(profile).alias("profile"),
        F.lit(run_partition).alias("run_partition"),
        F.current_timestamp().alias("built_at"),
        rows(silver["orders"]).alias("silver_orders"),
        rows(silver["web_events"]).alias("silver_events"),
        gold["mart_revenue_daily"].agg(_sum("revenue")).scalar().alias("gold_revenue"),
        rows(gold["mart_inventory_risk"].where("inventory_risk")).alias("inventory_risk_items"),
        rows(gold["mart_funnel_conversion"].where("late_events > 0")).alias("late_event_partitions"),
    )


# Read order of each mart: column and whether it descends. Keys that follow break ties.
READ_ORDER: dict[str, tuple[tuple[str, bool], ...]] = {
    "mart_revenue_daily": (("order_date", False), ("region", False)),
    "mart_product_performance": (("revenue", True), ("product_id", False)),
    "mart_inventory_risk": (
        ("inventory_risk", True),
        ("on_hand_units", False),
        ("warehouse_id", False),
        ("product_id", False),
    ),
    "mart_customer_ltv": (("lifetime_revenue", True), ("customer_id", False)),
    "mart_funnel_conversion": (("event_date", False), ("campaign", False)),
    "mart_fulfillment_sla": (("order_date", False), ("carrier", False)),
    "mart_returns": (("refunded_amount", True), ("category", False), ("reason", False)),
    "mart_data_freshness": (("source_name", False),),
    "mart_pipeline_runs": (("run_partition", False),),
}

ENTITY_MARTS = {
    "mart_revenue_daily": revenue_daily,
    "mart_product_performance": product_performance,
    "mart_inventory_risk": inventory_risk,
    "mart_customer_ltv": customer_ltv,
    "mart_funnel_conversion": funnel_conversion,
    "mart_fulfillment_sla": fulfillment_sla,
    "mart_returns": returns,
}

GOLD_MARTS = tuple(READ_ORDER)


def sort_keys(mart: str) -> list[Column]:
    return [
        F.col(name).desc_nulls_last() if down else F.col(name).asc_nulls_last() for name, down in READ_ORDER[mart]
    ]


def ordered(frame: DataFrame, mart: str) -> DataFrame:
    return frame.orderBy(*sort_keys(mart))


def build_all(silver: Tables, profile: str, run_partition: str, store: Workspace | None = None) -> dict[str, DataFrame]:
    """All nine marts, in their fixed order.

    With a store the entity marts are written side by side, and the run mart reads the written tables.
    """
    gold = {name: build(silver) for name, build in ENTITY_MARTS.items()}
    gold["mart_data_freshness"] = data_freshness(silver, profile, run_partition)
    if store:
        gold = store.save_all(gold)
    runs = pipeline_runs(silver, gold, profile, run_partition)
    gold["mart_pipeline_runs"] = store.save(runs, "mart_pipeline_runs") if store else runs
    return gold
