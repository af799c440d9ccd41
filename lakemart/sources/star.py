"""Commerce entities derived from the star-schema test tables.

The test data has no commerce tables, so every raw entity is a projection of the whole star-schema tables with
deterministic expressions. Business columns that later steps need (row order, return flag) ride along.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions.scalars import AMOUNT, PRICE, RATE, listed, one_of, shift, sku
from lakemart.operators.dedup import keep_first
from lakemart.sources.model import CONTRACTS, SHIPPABLE_STATUSES, TableContract

# First day and hour that counts as on time for the test events, which span January 2024.
LATE_CUTOFF = "2024-01-02 00:00:00"

# Business order that is total on the raw rows; it plays the part of the file order.
ROW_ORDER = {
    "customers": ("customer_id",),
    "products": ("product_id",),
    "warehouses": ("warehouse_id",),
    "inventory": ("warehouse_id", "product_id"),
    "orders": ("order_id",),
    "order_items": ("ship_date", "product_id", "warehouse_id", "extended_price", "quantity"),
    "payments": ("payment_id",),
    "shipments": ("shipment_id",),
    "returns": ("return_id",),
    "web_events": ("event_id",),
}

# The plain contracts plus a balance rule, which the test customers break in about one row of twelve.
STAR_CONTRACTS: dict[str, TableContract] = {
    **CONTRACTS,
    "customers": replace(CONTRACTS["customers"], non_negative=("account_balance",)),
}


# Columns of the tables that are read, as SQL schemas (saves a footer read per table).
_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

_STATUS = """
    case when o_orderpriority = '4-NOT SPECIFIED' then 'cancelled'
         when o_orderstatus = 'F' and o_orderpriority = '5-LOW' then 'returned'
         when o_orderstatus = 'F' then 'delivered'
         when o_orderstatus = 'O' then 'shipped'
         else 'paid' end"""


class StarTables:
    """Lazy raw entities over one folder of star-schema Parquet tables; ``known`` holds those written before."""

    def __init__(self, spark: SparkSession, folder: str, known: Mapping[str, DataFrame] | None = None):
        self.spark = spark
        self.folder = folder
        self.known = dict(known or {})
        self.__dict__.update(self.known)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(_SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def _regions(self) -> DataFrame:
        named = self.table("nation").join(self.table("region"), F.expr("n_regionkey = r_regionkey"))
        return named.selectExpr("n_nationkey", "r_name as region")

    @cached_property
    def customers(self) -> DataFrame:
        return (
            self.table("customer")
            .join(self._regions, F.expr("c_nationkey = n_nationkey"))
            .selectExpr(
                "c_custkey as customer_id",
                "c_name as email",
                "region",
                "c_mktsegment as acquisition_channel",
                "date_add(date '1994-01-01', int(c_custkey % 365)) as signup_date",
                "case when c_acctbal < 2500 then 'standard' when c_acctbal < 5000 then 'silver'"
                " when c_acctbal < 8000 then 'gold' else 'platinum' end as loyalty_tier",
                "c_acctbal as account_balance",
            )
        )

    @cached_property
    def products(self) -> DataFrame:
        price = f"cast(p_retailprice as {PRICE})"
        return self.table("part").selectExpr(
            "p_partkey as product_id",
            f"{sku('p_type', 'p_partkey')} as sku",
            "p_type as category",
            "p_brand as brand",
            f"cast({price} * 0.60BD as {PRICE}) as unit_cost",
            f"{price} as unit_price",
            "p_partkey % 25 <> 0 as active",
        )

    @cached_property
    def warehouses(self) -> DataFrame:
        return (
            self.table("supplier")
            .join(self._regions, F.expr("s_nationkey = n_nationkey"))
            .selectExpr(
                "s_suppkey as warehouse_id",
                "region",
                "1000 + s_suppkey * 37 % 997 as capacity_units",
                "1 + s_suppkey % 5 as priority",
            )
        )

    @cached_property
    def inventory(self) -> DataFrame:
        # Dealt out by product, on which stock is joined later: the pairs need not travel again.
        stocked = (
            self.table("lineitem")
            .selectExpr("l_suppkey as warehouse_id", "l_partkey as product_id", "l_shipdate")
            .repartition("product_id")
            .groupBy("warehouse_id", "product_id")
            .agg(F.max("l_shipdate").alias("newest"))
        )
        return stocked.selectExpr(
            "warehouse_id",
            "product_id",
            "date(newest) as snapshot_date",
            "(product_id * 3 + warehouse_id * 7) % 211 as on_hand_units",
            "10 + (product_id * 5 + warehouse_id * 3) % 83 as reorder_point",
        )

    @cached_property
    def placed_orders(self) -> DataFrame:
        """Orders without their region, for plans that do not need it and so can do without the customer join."""
        return self.table("orders").selectExpr(
            "o_orderkey as order_id",
            "o_custkey as customer_id",
            "o_orderdate as order_ts",
            f"{_STATUS} as status",
            "'USD' as currency",
        )

    @cached_property
    def orders(self) -> DataFrame:
        homes = self.customers.selectExpr("customer_id as home_of", "region")
        columns = ("order_id", "customer_id", "order_ts", "status", "region", "currency")
        return self.placed_orders.join(homes, F.expr("customer_id = home_of"), "left").select(*columns)

    @cached_property
    def unpriced_items(self) -> DataFrame:
        """Order lines before they meet their price and get their id."""
        return self.table("lineitem").selectExpr(
            "l_orderkey as order_id",
            "l_linenumber",
            "l_partkey as product_id",
            "l_suppkey as warehouse_id",
            "bigint(l_quantity) as quantity",
            f"cast(l_discount as {RATE}) as discount_pct",
            "l_extendedprice as extended_price",
            "l_returnflag as return_flag",
            "l_shipdate as ship_date",
        )

    def priced(self, lines: DataFrame, prices: DataFrame) -> DataFrame:
        """Raw order lines from unpriced ones and from what is known by product: the price, and columns that ride along."""
        known = prices.withColumnRenamed("product_id", "_priced")
        carried = [name for name in prices.columns if name not in ("product_id", "unit_price")]
        columns = "product_id, warehouse_id, quantity, unit_price, discount_pct, extended_price, return_flag, ship_date"
        return lines.join(known, F.expr("product_id = _priced"), "left").selectExpr(
            "concat(order_id, '-', l_linenumber) as order_item_id", "order_id", *columns.split(", "), *carried
        )

    @cached_property
    def order_items(self) -> DataFrame:
        return self.priced(self.unpriced_items, self.products.select("product_id", "unit_price"))

    @cached_property
    def prices(self) -> DataFrame:
        """One price by product."""
        return self.products.groupBy("product_id").agg(F.min("unit_price").alias("unit_price"))

    def first_items(self, prices: DataFrame) -> DataFrame:
        """The first copy of every order line, which is found before the lines meet their price: it does not depend on it.

        Order and line number stand for the id, and are null where it is null, because all lines without one are copies.
        """
        key = {
            "_order": F.expr("if(l_linenumber is null, null, order_id)"),
            "_line": F.expr("if(order_id is null, null, l_linenumber)"),
        }
        first = keep_first(self.unpriced_items.withColumns(key), list(key), ROW_ORDER["order_items"])
        return self.priced(first.drop(*key), prices)

    @cached_property
    def payments(self) -> DataFrame:
        methods = ("voucher", "transfer", "invoice")
        return self.table("orders").selectExpr(
            "o_orderkey as payment_id",
            "o_orderkey as order_id",
            f"{shift('MINUTE', '5 + o_orderkey % 50', 'o_orderdate')} as payment_ts",
            f"{one_of('o_orderkey % 3', methods)} as payment_method",
            "case when o_orderkey % 10 < 6 then 'captured' when o_orderkey % 10 < 8 then 'authorized'"
            " when o_orderkey % 10 < 9 then 'refunded' else 'failed' end as payment_status",
            f"cast(o_totalprice as {AMOUNT}) as amount",
        )

    @cached_property
    def shipments(self) -> DataFrame:
        suppliers = self.table("supplier").agg(F.count(F.lit(1))).scalar()
        sent = shift("HOUR", "1 + o_orderkey % 30", "o_orderdate")
        carriers = ("north line", "south line", "east line")
        return (
            self.table("orders")
            .where(f"{_STATUS} in ({listed(SHIPPABLE_STATUSES)})")
            .withColumn("warehouse_id", F.col("o_orderkey") % suppliers)
            .selectExpr(
                "o_orderkey as shipment_id",
                "o_orderkey as order_id",
                "warehouse_id",
                f"{sent} as ship_ts",
                f"{shift('DAY', '3 + o_orderkey % 3', 'o_orderdate')} as promised_delivery_ts",
                f"{shift('HOUR', '20 + o_orderkey * 11 % 79', sent)} as delivered_ts",
                f"{one_of('o_orderkey % 3', carriers)} as carrier",
                f"cast(cast(300 + o_orderkey % 1501 as {PRICE}) * 0.01BD as {PRICE}) as shipping_cost",
            )
        )

    def returns(self, items: DataFrame) -> DataFrame:
        """Returned lines of the deduplicated ``items``."""
        reasons = ("broken", "too small", "too large", "other")
        return items.where("return_flag = 'R'").selectExpr(
            "order_item_id as return_id",
            "order_item_id",
            f"{shift('DAY', '10', 'ship_date')} as return_ts",
            f"{one_of('product_id % 4', reasons)} as reason",
            "net_sales as refund_amount",
        )

    @cached_property
    def web_events(self) -> DataFrame:
        campaign = "concat('campaign ', bigint(get_json_object(props, '$.k')) % 7)"
        return self.table("events").selectExpr(
            "event_id",
            "user_id as customer_id",
            "concat(user_id, '-', date(ts)) as session_id",
            "ts as event_ts",
            "case event_type when 'view' then 'product_view' when 'click' then 'add_to_cart'"
            " when 'signup' then 'checkout_start' when 'error' then 'search' else event_type end as event_type",
            "event_id % 200 as product_id",
            f"{one_of('event_id % 3', ('phone', 'tablet', 'desktop'))} as device",
            f"{campaign} as campaign",
        )
