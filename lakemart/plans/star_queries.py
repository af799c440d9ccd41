"""Every operator as a query over the whole star-schema test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions import scalars
from lakemart.operators import contracts, distincts, joins
from lakemart.operators.contracts import Validation
from lakemart.operators.dedup import keep_first
from lakemart.operators.rank import placed
from lakemart.plans import kpi, marts, medallion, quality, silver
from lakemart.plans.incremental import EventBuckets
from lakemart.sources import lake, topic
from lakemart.sources.lake import Workspace
from lakemart.sources.model import CONTRACTS, EVENT_TYPES, KEYS, SHIPPABLE_STATUSES, TABLES, TableContract, stream_schema
from lakemart.sources.star import LATE_CUTOFF, ROW_ORDER, STAR_CONTRACTS, StarTables
from lakemart.sources.versions import VersionedTable
from lakemart.streaming.landing import Landing, file_topic

PROFILE, RUN_DATE = "star", "2024-02-01"
RUN = f"run_date={RUN_DATE}"
LINE_COLUMNS = ("order_item_id", "product_id", "warehouse_id", "quantity", "ship_date", "extended_price")

# Columns of silver order lines that neither returns nor a mart reads; intermediate copies go without them.
UNREAD = ("warehouse_id", "unit_price", "extended_price", "gross_sales")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[StarTables], DataFrame]) -> Callable[[StarTables], DataFrame]:
    """Register ``build`` under its own name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return build(StarTables(spark, folder))

    QUERIES[build.__name__] = run
    return build


class Silver(Mapping):
    """Silver entities over the star tables, each deduplicated by its key and built when first asked for.

    With a workspace, order lines are written once, because returns are derived from them and joined back to them. They
    meet price and cost of their product in one join, behind their deduplication. ``firsts`` holds raw tables of which
    only the first copies are left, because a contract has found them; they are not deduplicated again.
    Plans that do not read the region of an order leave it out and save the join that derives it.
    """

    def __init__(
        self,
        star: StarTables,
        order_region: bool = True,
        space: Workspace | None = None,
        firsts: Mapping[str, DataFrame] | None = None,
    ):
        self._star = star
        self._firsts = {} if firsts is None else firsts
        self._order_region = order_region
        self._space = space
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._built:
            self._built[table] = self._build(table)
        return self._built[table]

    def __iter__(self) -> Iterator[str]:
        return iter(TABLES)

    def __len__(self) -> int:
        return len(TABLES)

    def _build(self, table: str) -> DataFrame:
        order = ROW_ORDER[table]
        if table in self._firsts:
            late = (LATE_CUTOFF,) if table == "web_events" else ()
            return silver.ENTITIES[table](self._firsts[table], *late)
        if table == "order_items" and self._space:
            known = self._space.save(marts.costed(self._star.prices, self["products"]), "product_prices")
            lines = silver.order_items(self._star.first_items(known))
            return self._space.save(lines.drop(*UNREAD), "silver_order_items")
        if table == "order_items":
            return silver.order_items(self._star.order_items, order)
        if table == "returns":
            return silver.returns(self._star.returns(self["order_items"]), order)
        if table == "web_events":
            return silver.web_events(self._star.web_events, LATE_CUTOFF, order)
        if table == "orders" and not self._order_region:
            return silver.orders(self._star.placed_orders, order)
        return silver.ENTITIES[table](getattr(self._star, table), order)


def work(star: StarTables) -> Workspace:
    """A work folder for tables that are wide and read a few times, so they are packed tight."""
    return Workspace(star.spark, codec="zstd")


def written(star: StarTables, space: Workspace) -> StarTables:
    """The same tables; raw order lines, which a join derives and several steps read, are written and read from there."""
    lines = space.save(star.order_items, "raw_order_items")
    return StarTables(star.spark, star.folder, {"order_items": lines})


def joined_late(star: StarTables, space: Workspace) -> StarTables:
    """The same tables, for contracts alone: they read the keys of order lines first and whole lines once.

    Where every product is there once, lines are not written: a plan that reads no price leaves the prices out.
    """
    products, known = star.products.agg(F.count("product_id"), F.count_distinct("product_id")).first()
    if products > known:
        return written(star, space)
    return StarTables(star.spark, star.folder, {"order_items": star.priced(star.unpriced_items, star.prices)})


def raw_table(star: StarTables, table: str) -> DataFrame:
    """A raw entity; returns are taken from deduplicated lines."""
    if table == "returns":
        return star.returns(silver.order_items(star.order_items, ROW_ORDER["order_items"]))
    return getattr(star, table)


def validated(star: StarTables, *tables: str) -> dict[str, Validation]:
    """The named tables and their parents, validated table by table through the shared work folder.

    Returns are taken from deduplicated order lines. So they come behind the other tables, whose contracts find the
    first copy of every line.
    """
    chosen = {name: STAR_CONTRACTS[name] for name in STAR_CONTRACTS if name in tables}
    space = work(star)
    if "order_items" in chosen and "order_items" not in star.known:
        star = joined_late(star, space)
    others = {name: contract for name, contract in chosen.items() if name != "returns"}
    results = contracts.validate_all({name: getattr(star, name) for name in others}, others, ROW_ORDER, space)
    if "returns" in chosen:
        lines = Silver(star, space=space, firsts=_first_copies(results))["order_items"]
        results["returns"] = _returns(star, results, lines)
    return {name: results[name] for name in chosen}


def _first_copies(results: Mapping[str, Validation]) -> dict[str, DataFrame]:
    """Of every table whose key is one column, the first copies, where its contract tells them."""
    found = {name: result.first_copies(*KEYS[name]) for name, result in results.items() if len(KEYS[name]) == 1}
    return {name: rows for name, rows in found.items() if rows is not None}


def _returns(star: StarTables, results: Mapping[str, Validation], lines: DataFrame) -> Validation:
    """The returns of the deduplicated ``lines``, when all other tables have been validated."""
    parents = {"order_items": results["order_items"]}
    contract = STAR_CONTRACTS["returns"]
    return contracts.validate_behind(
        star.returns(lines), contract, parents, STAR_CONTRACTS, ROW_ORDER["returns"], work(star)
    )


# --- scans, sinks, manifests -------------------------------------------------------------------------------------


@query
def scan_csv_roundtrip(star: StarTables) -> DataFrame:
    space = Workspace(star.spark)
    lake.write_csv(star.products, space.path("products_csv"))
    rows = lake.read_csv(star.spark, space.path("products_csv"))
    return silver.products(scalars.assign(rows, {"product_id": "bigint(product_id)"}))


def _event_lines(star: StarTables) -> DataFrame:
    """Events as topic messages: every value as text, like a JSON producer writes them."""
    texts = [f"string({name}) as {name}" for name in star.web_events.columns]
    return star.web_events.selectExpr(*texts, "'stream' as event_source")


def _typed_events(rows: DataFrame) -> DataFrame:
    return rows.selectExpr(
        "bigint(event_id) as event_id",
        "bigint(customer_id) as customer_id",
        "session_id",
        "cast(event_ts as timestamp_ntz) as event_ts",
        "event_type",
        "bigint(product_id) as product_id",
        "device",
        "campaign",
    )


@query
def scan_jsonl_roundtrip(star: StarTables) -> DataFrame:
    space = Workspace(star.spark)
    _event_lines(star).write.json(space.path("events_json"))
    return _typed_events(lake.read_jsonl(star.spark, space.path("events_json"), stream_schema()))


@query
def latest_partition(star: StarTables) -> DataFrame:
    space = Workspace(star.spark)
    rows = scalars.assign(star.orders, {"run_date": scalars.month_of("order_ts")})
    # Rebalancing gathers each month into few files and, unlike a plain repartition, splits a hot month.
    table = space.save(rows.hint("rebalance", "run_date"), "orders_by_month", ("run_date",))
    return lake.latest_partition(star.spark, space.path("orders_by_month"), schema=table.schema)


@query
def scan_glob(star: StarTables) -> DataFrame:
    """Orders of the last quarter of every year, read through one path pattern over monthly folders."""
    space = Workspace(star.spark)
    rows = scalars.assign(star.placed_orders, {"run_date": scalars.month_of("order_ts")})
    space.save(rows.hint("rebalance", "run_date"), "orders_by_month", ("run_date",))
    months = lake.read_glob(star.spark, space.path("orders_by_month"), "run_date=*-1[012]")
    return scalars.assign(months, {"run_date": "left(string(run_date), 7)"})


@query
def create_table(star: StarTables) -> DataFrame:
    """A catalog table that is created and then replaced by another query."""
    place = Workspace(star.spark).path("products")
    name = f"lakemart_products_{uuid.uuid4().hex}"
    lake.save_table(star.products.where("not active"), name, place)
    lake.save_table(star.products.where("active"), name, place)
    return star.spark.table(name)


@query
def table_versions(star: StarTables) -> DataFrame:
    """Orders by status in four versions: paid ones, others added, shipped ones replaced, and all compacted."""
    table = VersionedTable(star.spark, Workspace(star.spark).path("orders"))
    orders = star.placed_orders.select("order_id", "customer_id", "status")
    table.replace_partitions(orders.where("status = 'paid'"), "status")
    table.append(orders.where("status <> 'paid'"), ("status",))
    table.replace_partitions(orders.where("status = 'shipped' and order_id % 2 = 0"), "status")
    table.compact()
    versions = [table.read(v).withColumn("version", F.lit(v)) for v in table.versions()]
    return reduce(DataFrame.unionByName, versions).groupBy("version", "status").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("order_id").alias("ids"), F.sum("customer_id").alias("customers")
    )


@query
def ingest_metadata(star: StarTables) -> DataFrame:
    space = Workspace(star.spark)
    tagged = lake.ingest_metadata(star.products, PROFILE, RUN_DATE)
    target = space.path("bronze_products")
    table = VersionedTable(star.spark, target)
    table.replace_partitions(tagged.where("not active"), "ingest_profile", "ingest_run_date")
    table.replace_partitions(tagged, "ingest_profile", "ingest_run_date")
    return table.read()


@query
def raw_manifest(star: StarTables) -> DataFrame:
    tables = {table: raw_table(star, table) for table in TABLES} | {"orders": star.placed_orders}
    return lake.manifest(tables, PROFILE, RUN, "table_name", "raw_rows")


@query
def silver_manifest(star: StarTables) -> DataFrame:
    return lake.manifest(Silver(star, order_region=False), PROFILE, RUN, "table_name", "silver_rows")


def _gold(
    star: StarTables, space: Workspace, silver_tables: Silver | None = None
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """All marts, written once each, over order tables that are derived once; also the entities."""
    entities = _read_often(silver_tables or Silver(star, space=space), space)
    return marts.build_all(entities, PROFILE, RUN, space), entities


def _read_often(entities: Mapping[str, DataFrame], space: Workspace) -> dict[str, DataFrame]:
    """All entities, those that several marts read written once, side by side.

    What is known of a written table is its real size: joins with small ones need no shuffle of the facts.
    """
    often = {f"silver_{name}": entities[name] for name in ("orders", "products", "warehouses")}
    saved = {name.removeprefix("silver_"): frame for name, frame in space.save_all(often).items()}
    return {**entities, **saved}


def _star_run(star: StarTables) -> medallion.Run:
    """A run of the lake whose root lies in a work folder."""
    return medallion.Run(star.spark, Workspace(star.spark).folder, PROFILE, RUN_DATE)


def _bronze_run(star: StarTables) -> tuple[medallion.Run, dict[str, Validation]]:
    """Customers, orders and payments through the bronze step of a run."""
    run = _star_run(star)
    raw = {name: getattr(star, name) for name in ("customers", "orders", "payments")}
    chosen = {name: STAR_CONTRACTS[name] for name in raw}
    return run, medallion.bronze(run, raw, ROW_ORDER, chosen)


@query
def bronze_zone(star: StarTables) -> DataFrame:
    """What a user finds in the bronze zone: clean rows with the labels of the run."""
    run, _ = _bronze_run(star)
    return run.read("bronze", "orders")


@query
def silver_zone(star: StarTables) -> DataFrame:
    run, results = _bronze_run(star)
    medallion.build_silver(run, results, ROW_ORDER)
    return run.read("silver", "orders")


@query
def observability_exports(star: StarTables) -> DataFrame:
    """The contract summary as people download it."""
    run, _ = _bronze_run(star)
    rows = medallion.read_export(run, "contract_summary")
    counts = {n: f"bigint({n})" for n in ("raw_rows", "clean_rows", "rejected_rows", "validation_issues")}
    return scalars.assign(rows, {**counts, "quality_score": "double(quality_score)"})


@query
def rejects_export(star: StarTables) -> DataFrame:
    run, _ = _bronze_run(star)
    return medallion.read_export(run, "rejected_rows").groupBy("rejected_from").agg(F.count(F.lit(1)).alias("rows"))


@query
def missing_outputs(star: StarTables) -> DataFrame:
    """Required exports that a run has not made yet; one that never ran any step lacks all, and reads as empty."""
    run, _ = _bronze_run(star)
    absent = medallion.missing_outputs(run, quality.Rules().required_outputs)
    none = medallion.read_export(run, "mart_revenue_daily")
    rows = star.spark.createDataFrame([(name,) for name in absent], "output string")
    return rows.withColumn("export_columns", F.lit(len(none.columns)))


@query
def gold_zone(star: StarTables) -> DataFrame:
    """The fulfilment mart of a run, from the gold zone."""
    run, space = _star_run(star), work(star)
    medallion.build_gold(run, _read_often(Silver(star, space=space), space))
    return run.read("gold", "mart_fulfillment_sla")


@query
def mart_read_order(star: StarTables) -> DataFrame:
    """Place of every product in the read order of its mart, which its export has too."""
    mart = marts.product_performance(Silver(star, order_region=False))
    keys = marts.sort_keys("mart_product_performance")
    ranked = placed(mart.select("product_id", "revenue"), keys, Workspace(star.spark), "ordered")
    return ranked.withColumn("place", F.col("place").cast("int"))


@query
def gold_manifest(star: StarTables) -> DataFrame:
    gold, _ = _gold(star, work(star))
    return lake.manifest(gold, PROFILE, RUN, "mart_name", "row_count")


# --- contract checks ---------------------------------------------------------------------------------------------


@query
def contract_missing_column(star: StarTables) -> DataFrame:
    result = contracts.annotate(
        star.warehouses.drop("priority"), CONTRACTS["warehouses"], {}, ROW_ORDER["warehouses"]
    )
    return result.summary()


@query
def contract_missing_column_issue(star: StarTables) -> DataFrame:
    """The log entry for a whole column: one row without key and value, and all rows are rejected."""
    result = contracts.annotate(
        star.warehouses.drop("priority"), CONTRACTS["warehouses"], {}, ROW_ORDER["warehouses"]
    )
    rejected = result.rejected().agg(F.count(F.lit(1))).scalar()
    return result.issues("warehouse_id").withColumn("rejected_rows", rejected)


@query
def contract_many_rules(star: StarTables) -> DataFrame:
    """More rules than one long has bits: every customer column required again and again under other names."""
    names = [f"balance_{k}" for k in range(100)]
    rows = star.customers.selectExpr("customer_id", *[f"account_balance - {100 * k} as {n}" for k, n in enumerate(names)])
    contract = TableContract("customers", non_negative=tuple(names))
    result = contracts.annotate(rows, contract, {}, ROW_ORDER["customers"])
    return result.issues("customer_id").groupBy("column_name").agg(F.count(F.lit(1)).alias("issues"))


@query
def contract_required(star: StarTables) -> DataFrame:
    currency = (
        "case when order_id % 97 = 0 then null when order_id % 89 = 0 then '' when order_id % 83 = 0 then ' '"
        " else currency end"
    )
    contract = TableContract("orders", required=CONTRACTS["orders"].required)
    rows = scalars.assign(star.orders, {"currency": currency})
    return contracts.annotate(rows, contract, {}, ROW_ORDER["orders"]).issues("order_id")


@query
def contract_unique(star: StarTables) -> DataFrame:
    contract = TableContract("order_items", unique=("order_item_id",))
    space = Workspace(star.spark)
    lines = space.save(star.order_items.select(*LINE_COLUMNS), "raw_order_items")
    return contracts.annotate(lines, contract, {}, ROW_ORDER["order_items"], space).issues(*LINE_COLUMNS)


@query
def contract_positive(star: StarTables) -> DataFrame:
    quantity = (
        "case when order_id % 13 = 0 then 'n/a' when order_id % 11 = 0 then '-3' when order_id % 7 = 0 then '0'"
        " when order_id % 17 = 0 then null else string(quantity) end"
    )
    contract = TableContract("order_items", positive=("quantity", "unit_price"))
    rows = scalars.assign(star.order_items, {"quantity": quantity})
    result = contracts.annotate(rows, contract, {}, ROW_ORDER["order_items"])
    return result.issues("order_item_id", "product_id", "ship_date", "extended_price")


@query
def contract_non_negative(star: StarTables) -> DataFrame:
    contract = TableContract("customers", non_negative=("account_balance",))
    issues = contracts.annotate(star.customers, contract, {}, ROW_ORDER["customers"]).issues("customer_id")
    return scalars.assign(issues, {"value": "double(value)"})


@query
def contract_allowed(star: StarTables) -> DataFrame:
    kind = "if(event_id % 41 = 0, null, event_type) as event_type"
    rows = star.table("events").selectExpr("event_id", kind)
    contract = TableContract("web_events", allowed={"event_type": EVENT_TYPES})
    return contracts.annotate(rows, contract, {}, ("event_id",)).issues("event_id")


@query
def contract_fk(star: StarTables) -> DataFrame:
    space = Workspace(star.spark)
    customers = contracts.annotate(star.customers, STAR_CONTRACTS["customers"], {}, ROW_ORDER["customers"], space)
    contract = TableContract("orders", foreign_keys=CONTRACTS["orders"].foreign_keys)
    return contracts.annotate(
        star.orders, contract, {"customers": customers.clean()}, ROW_ORDER["orders"], space
    ).issues("order_id")


@query
def contract_clean(star: StarTables) -> DataFrame:
    return validated(star, "customers", "orders")["orders"].clean()


@query
def contract_rejected(star: StarTables) -> DataFrame:
    tables = ("customers", "products", "warehouses", "orders", "order_items")
    return validated(star, *tables)["order_items"].rejected()


@query
def contract_issues(star: StarTables) -> DataFrame:
    tables = ("customers", "products", "warehouses", "orders", "order_items")
    return validated(star, *tables)["order_items"].issues(*LINE_COLUMNS)


@query
def orphan_rows(star: StarTables) -> DataFrame:
    space = Workspace(star.spark)
    customers = contracts.annotate(star.customers, STAR_CONTRACTS["customers"], {}, ROW_ORDER["customers"], space)
    rows = star.orders.select("order_id", "customer_id", "order_ts")
    return joins.orphans(rows, "customer_id", customers.clean(), "customer_id")


@query
def contract_cascade(star: StarTables) -> DataFrame:
    tables = ("customers", "products", "warehouses", "orders", "order_items", "returns")
    return validated(star, *tables)["returns"].clean()


@query
def rejected_union(star: StarTables) -> DataFrame:
    return contracts.union_rejected(list(validated(star, *TABLES).values()))


@query
def issue_counts(star: StarTables) -> DataFrame:
    return contracts.issue_counts(list(validated(star, *TABLES).values()))


@query
def contract_summary(star: StarTables) -> DataFrame:
    return contracts.contract_summary(list(validated(star, *TABLES).values()))


# --- silver entities ---------------------------------------------------------------------------------------------


@query
def silver_customers(star: StarTables) -> DataFrame:
    return silver.customers(star.customers, ROW_ORDER["customers"])


@query
def silver_products(star: StarTables) -> DataFrame:
    return silver.products(star.products, ROW_ORDER["products"])


@query
def silver_warehouses(star: StarTables) -> DataFrame:
    return silver.warehouses(star.warehouses, ROW_ORDER["warehouses"])


@query
def silver_inventory(star: StarTables) -> DataFrame:
    return silver.inventory(star.inventory, ROW_ORDER["inventory"])


@query
def silver_orders(star: StarTables) -> DataFrame:
    return silver.orders(star.orders, ROW_ORDER["orders"])


@query
def silver_order_items(star: StarTables) -> DataFrame:
    return silver.order_items(star.order_items, ROW_ORDER["order_items"])


@query
def silver_wide_values(star: StarTables) -> DataFrame:
    """Lines with quantities, prices and discounts far beyond usual ones, as text like raw files hold them."""
    wide = scalars.assign(
        star.order_items,
        {
            "quantity": "string(quantity * 4000000000)",
            "unit_price": "string(unit_price * 100000000)",
            "discount_pct": "case when order_id % 7 = 0 then string(discount_pct + 15) when order_id % 11 = 0 then 'n/a'"
            " when order_id % 13 = 0 then null else string(discount_pct + decimal(order_id % 10000) * 0.00000001BD) end",
        },
    )
    return silver.order_items(wide, ROW_ORDER["order_items"])


@query
def silver_payments(star: StarTables) -> DataFrame:
    return silver.payments(star.payments, ROW_ORDER["payments"])


@query
def silver_shipments(star: StarTables) -> DataFrame:
    return silver.shipments(star.shipments, ROW_ORDER["shipments"])


@query
def silver_returns(star: StarTables) -> DataFrame:
    return silver.returns(raw_table(star, "returns"), ROW_ORDER["returns"])


@query
def silver_web_events(star: StarTables) -> DataFrame:
    return silver.web_events(star.web_events, LATE_CUTOFF, ROW_ORDER["web_events"])


@query
def silver_events_union(star: StarTables) -> DataFrame:
    """Stream copies carry doubled ids, so the even ids meet a batch row and the rest are new."""
    batch = lake.ingest_metadata(star.web_events, PROFILE, RUN_DATE)
    doubled = scalars.assign(star.web_events, {"event_id": "event_id * 2", "event_source": "'stream'"})
    stream = doubled.drop("campaign")
    return silver.web_events_with_stream(batch, stream, ROW_ORDER["web_events"], LATE_CUTOFF, PROFILE)


@query
def silver_events_incremental(star: StarTables) -> DataFrame:
    """The union of batch and stream, taken in by three runs in which stream copies come before and after batch ones."""
    batch = lake.ingest_metadata(star.web_events, PROFILE, RUN_DATE)
    doubled = scalars.assign(star.web_events, {"event_id": "event_id * 2", "event_source": "'stream'"}).drop("campaign")
    store = EventBuckets(star.spark, Workspace(star.spark).path("events"), 16)
    for run in range(3):
        added = batch.where(F.pmod("event_id", F.lit(3)) == run)
        streamed = doubled.where(F.pmod(F.col("event_id") + 1, F.lit(3)) == run)
        store.merge_batch(added, streamed, ROW_ORDER["web_events"], PROFILE)
    return store.read(LATE_CUTOFF)


# --- scalars and dedup -------------------------------------------------------------------------------------------


@query
def dedup_keep_first(star: StarTables) -> DataFrame:
    order = ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    return keep_first(star.table("lineitem"), ("l_orderkey", "l_linenumber"), order)


@query
def dedup_composite(star: StarTables) -> DataFrame:
    rows = star.table("lineitem").selectExpr(
        "l_suppkey", "l_partkey", "date(l_shipdate) as ship_day", "l_orderkey", "l_linenumber"
    )
    return keep_first(rows, ("l_suppkey", "l_partkey", "ship_day"), ("l_orderkey", "l_linenumber"))


@query
def fn_try_numeric(star: StarTables) -> DataFrame:
    dirty = "case when product_id % 5 = 0 then 'n/a' when product_id % 7 = 0 then '' else string(unit_price) end"
    rows = star.products.selectExpr("product_id", f"{dirty} as price_text")
    return scalars.assign(rows, {"price": scalars.parse_decimal("price_text", scalars.PRICE)})


@query
def fn_try_date(star: StarTables) -> DataFrame:
    dirty = (
        "case when customer_id % 5 = 0 then 'soon' when customer_id % 7 = 0 then '2024-13-45'"
        " else string(signup_date) end"
    )
    rows = star.customers.selectExpr("customer_id", f"{dirty} as signup_text")
    return scalars.assign(rows, {"signup_date": scalars.parse_date("signup_text")})


@query
def fn_pii_hash(star: StarTables) -> DataFrame:
    padded = r"concat(' \t', upper(email), ' \n')"
    return star.customers.selectExpr("customer_id", f"{scalars.pii_hash(padded)} as email_hash")


@query
def fn_json_field(star: StarTables) -> DataFrame:
    return star.table("events").selectExpr("event_id", "bigint(get_json_object(props, '$.k')) as k")


@query
def fn_ts_add(star: StarTables) -> DataFrame:
    return star.table("orders").selectExpr(
        "o_orderkey",
        f"{scalars.shift('MINUTE', 'o_orderkey % 90', 'o_orderdate')} as plus_minutes",
        f"{scalars.shift('HOUR', 'o_orderkey % 50', 'o_orderdate')} as plus_hours",
        f"{scalars.shift('DAY', 'o_orderkey % 6', 'o_orderdate')} as plus_days",
    )


@query
def fn_sku(star: StarTables) -> DataFrame:
    return star.products.select("product_id", "sku")


# --- filters, joins, helpers -------------------------------------------------------------------------------------


@query
def shippable_orders(star: StarTables) -> DataFrame:
    return star.orders.where(f"status in ({scalars.listed(SHIPPABLE_STATUSES)})")


@query
def returned_items_semi(star: StarTables) -> DataFrame:
    returned = star.placed_orders.where("status = 'returned'")
    return joins.members(star.order_items, "order_id", returned, "order_id")


@query
def stock_grid_gaps(star: StarTables) -> DataFrame:
    return joins.grid_gaps(star.inventory, "warehouse_id", "product_id", star.warehouses, star.products)


@query
def item_price_lookup(star: StarTables) -> DataFrame:
    lines = star.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    return joins.lookup(lines, "l_partkey", star.products, "product_id", "unit_price", "unit_cost")


@query
def order_net_totals(star: StarTables) -> DataFrame:
    net = f"cast(quantity as {scalars.COUNT}) * unit_price * (cast(1 as {scalars.RATE}) - discount_pct)"
    return star.order_items.groupBy("order_id").agg(F.expr(f"cast(sum({net}) as decimal(38,6))").alias("net_total"))


# --- marts -------------------------------------------------------------------------------------------------------


@query
def mart_revenue_daily(star: StarTables) -> DataFrame:
    return marts.revenue_daily(Silver(star))


@query
def mart_product_performance(star: StarTables) -> DataFrame:
    return marts.product_performance(Silver(star))


@query
def mart_product_performance_dirty(star: StarTables) -> DataFrame:
    """Lines as raw text: some prices are no numbers, some are missing, and discounts have up to eight digits."""
    dirty = scalars.assign(
        star.order_items,
        {
            "quantity": "string(quantity)",
            "unit_price": "case when order_id % 5 = 0 then 'unknown' when order_id % 17 = 0 then null"
            " else string(unit_price) end",
            "discount_pct": "string(discount_pct + decimal(order_id % 10000) * 0.00000001BD)",
        },
    )
    products = silver.products(star.products, ROW_ORDER["products"])
    lines = silver.order_items(dirty, ROW_ORDER["order_items"])
    return marts.product_performance({"products": products, "order_items": lines})


@query
def mart_product_performance_recent(star: StarTables) -> DataFrame:
    """Only lines of the newest orders, which leaves most products unsold."""
    entities = dict(Silver(star, order_region=False))
    late = entities["orders"].where("order_ts >= timestamp_ntz '2001-07-01 00:00:00'")
    entities["order_items"] = joins.members(entities["order_items"], "order_id", late, "order_id")
    return marts.product_performance(entities)


@query
def mart_inventory_risk(star: StarTables) -> DataFrame:
    return marts.inventory_risk(Silver(star))


@query
def mart_customer_ltv(star: StarTables) -> DataFrame:
    return marts.customer_ltv(Silver(star, order_region=False))


@query
def mart_customer_ltv_recent(star: StarTables) -> DataFrame:
    """Only the orders of the newest year, which leaves half of the customers without any."""
    entities = dict(Silver(star, order_region=False))
    entities["orders"] = entities["orders"].where("order_ts >= timestamp_ntz '2001-01-01 00:00:00'")
    return marts.customer_ltv(entities)


@query
def mart_funnel_conversion(star: StarTables) -> DataFrame:
    return marts.funnel_conversion(Silver(star))


@query
def mart_fulfillment_sla(star: StarTables) -> DataFrame:
    return marts.fulfillment_sla(Silver(star, order_region=False))


@query
def mart_returns(star: StarTables) -> DataFrame:
    return marts.returns(Silver(star, space=Workspace(star.spark)))


@query
def mart_data_freshness(star: StarTables) -> DataFrame:
    return marts.data_freshness(Silver(star, order_region=False), PROFILE, RUN)


@query
def mart_pipeline_runs(star: StarTables) -> DataFrame:
    """From written marts, like in a run; counts of silver come from the entities."""
    space = Workspace(star.spark)
    entities = dict(Silver(star))
    entities["orders"] = space.save(entities["orders"], "silver_orders")
    read = ("mart_revenue_daily", "mart_inventory_risk", "mart_funnel_conversion")
    gold = space.save_all({name: marts.ENTITY_MARTS[name](entities) for name in read})
    return marts.pipeline_runs(entities, gold, PROFILE, RUN).drop("built_at")


# --- console reads -----------------------------------------------------------------------------------------------


@query
def executive_kpis(star: StarTables) -> DataFrame:
    """Headline numbers from the written marts and the full written scorecard."""
    results, gold = _checked(star)
    return kpi.executive(
        gold["mart_revenue_daily"], gold["mart_customer_ltv"], gold["mart_fulfillment_sla"], quality.scorecard(results)
    )


@query
def daily_revenue(star: StarTables) -> DataFrame:
    return kpi.daily_revenue(marts.revenue_daily(Silver(star)))


@query
def funnel_stages(star: StarTables) -> DataFrame:
    return kpi.funnel_stages(marts.funnel_conversion(Silver(star)))


@query
def risk_band_counts(star: StarTables) -> DataFrame:
    return kpi.risk_band_counts(marts.inventory_risk(Silver(star)))


@query
def active_customers_monthly(star: StarTables) -> DataFrame:
    """Customers who ordered in a month, from the customer sets of its days."""
    orders = silver.orders(star.placed_orders, ROW_ORDER["orders"])
    days = Workspace(star.spark).save(distincts.id_sets(orders, ("order_date",), "customer_id"), "customers_of_days")
    months = days.withColumn("order_month", F.date_format("order_date", "yyyy-MM"))
    return distincts.counted(months, ("order_month",), "active_customers")


@query
def sessions_weekly(star: StarTables) -> DataFrame:
    """Sessions of a week, from the session sets of its days; sessions are text, so a dictionary numbers them."""
    space = Workspace(star.spark)
    events = silver.web_events(star.web_events, LATE_CUTOFF, ROW_ORDER["web_events"]).select("session_id", "event_date")
    named = events.join(distincts.numbered(events, "session_id", space, "sessions", "session"), "session_id")
    days = space.save(distincts.id_sets(named, ("event_date",), "session"), "sessions_of_days")
    weeks = days.withColumn("week", F.to_date(F.date_trunc("week", "event_date")))
    return distincts.counted(weeks, ("week",), "sessions")


@query
def top_revenue_days(star: StarTables) -> DataFrame:
    return kpi.top_revenue_days(marts.revenue_daily(Silver(star)))


@query
def top50_revenue(star: StarTables) -> DataFrame:
    return kpi.top_revenue(marts.revenue_daily(Silver(star)))


@query
def top50_funnel(star: StarTables) -> DataFrame:
    return kpi.top_funnel(marts.funnel_conversion(Silver(star)))


@query
def top75_inventory(star: StarTables) -> DataFrame:
    return kpi.top_inventory(marts.inventory_risk(Silver(star)))


@query
def adhoc_sql(star: StarTables) -> DataFrame:
    entities = Silver(star)
    gold = {name: marts.ENTITY_MARTS[name](entities) for name in ("mart_revenue_daily", "mart_customer_ltv")}
    text = """
        with homes as (select region, count(*) as customers from mart_customer_ltv group by region)
        select r.region, count(*) as days, max(total_orders) as most_orders,
               cast(sum(revenue) as decimal(38, 2)) as revenue, max(customers) as customers
        from mart_revenue_daily r join homes on r.region = homes.region
        group by r.region
    """
    return kpi.sql(star.spark, text, gold)


# --- quality -----------------------------------------------------------------------------------------------------


_BUILT: dict[tuple[str, str], tuple[dict[str, DataFrame], dict[str, DataFrame]]] = {}


def _built(star: StarTables) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Marts and counts of a run over the whole tables, built once per session and folder; all checks read them.

    The contracts come first, because they find the first copy of every key, which the marts need too.
    """
    key = (star.spark.sparkContext.applicationId, star.folder)
    if key not in _BUILT:
        space = work(star)
        results = validated(star, *TABLES)
        entities = Silver(star, space=space, firsts=_first_copies(results))
        with ThreadPoolExecutor(2) as pool:
            made = pool.submit(_gold, star, space, entities)
            summary = contracts.contract_summary(list(results.values()))
            summed = pool.submit(space.save, summary, "contract_summary")
            gold, built = made.result()
            observed = {
                "gold_manifest": lake.manifest(gold, PROFILE, RUN, "mart_name", "row_count"),
                "silver_manifest": lake.manifest(built, PROFILE, RUN, "table_name", "silver_rows"),
            }
            _BUILT[key] = gold, space.save_all(observed) | {"contract_summary": summed.result()}
    return _BUILT[key]


def _checked(star: StarTables, without: str = "") -> tuple[DataFrame, dict[str, DataFrame]]:
    """All checks of a run over the whole tables, and its marts; the export named ``without`` is left out."""
    run = _star_run(star)
    gold, observed = _built(star)
    wanted = {f"{name}.csv" for name in (*gold, *observed)} & set(quality.Rules().required_outputs) - {f"{without}.csv"}
    with ThreadPoolExecutor(8) as pool:
        stored = pool.submit(run.store("observability").save_all, observed)
        exports = [pool.submit(run.export, f, name) for name, f in {**gold, **observed}.items() if f"{name}.csv" in wanted]
        for future in (stored, *exports):
            future.result()
    return medallion.evaluate(run, gold)["quality_checks"], gold


@query
def quality_checks(star: StarTables) -> DataFrame:
    return _checked(star)[0]


@query
def quality_checks_incomplete(star: StarTables) -> DataFrame:
    """The checks of a run that did not export its funnel mart."""
    return quality.failed(_checked(star, without="mart_funnel_conversion")[0])


@query
def platform_scorecard(star: StarTables) -> DataFrame:
    return quality.scorecard(_checked(star)[0])


@query
def failed_checks(star: StarTables) -> DataFrame:
    return quality.failed(_checked(star)[0])


@query
def check_contract_floor(star: StarTables) -> DataFrame:
    return quality.contract_floor(contracts.contract_summary(list(validated(star, *TABLES).values())))


@query
def check_late_rate(star: StarTables) -> DataFrame:
    return quality.late_event_rate(marts.funnel_conversion(Silver(star)))


@query
def check_sla_bounds(star: StarTables) -> DataFrame:
    return quality.sla_bounds(marts.fulfillment_sla(Silver(star, order_region=False)))


@query
def not_null_test(star: StarTables) -> DataFrame:
    revenue = marts.revenue_daily(Silver(star))
    return quality.not_null("mart_revenue_daily", revenue, ("order_date", "revenue"))


# --- streaming ---------------------------------------------------------------------------------------------------


def _topic(star: StarTables, space: Workspace, rows: DataFrame | None = None, files: int | None = None) -> str:
    """All events written as a JSON topic of several files."""
    files = files or int(star.spark.conf.get("spark.sql.shuffle.partitions"))
    lines = rows if rows is not None else _event_lines(star).repartitionByRange(files, "event_ts")
    lines.write.json(space.path("topic"))
    return space.path("topic")


def _landed(star: StarTables, caps: tuple[int | None, ...] = (None,)) -> tuple[Landing, DataFrame]:
    """All events landed from a topic, in one run per cap."""
    space = Workspace(star.spark)
    landing = Landing(star.spark, space.path("landing"), PROFILE)
    stream = file_topic(star.spark, _topic(star, space), stream_schema(), max_files=4)
    for cap in caps:
        landing.consume(stream, cap)
    return landing, stream


@query
def stream_land(star: StarTables) -> DataFrame:
    landing, _ = _landed(star)
    return _typed_events(landing.read(stream_schema()))


@query
def stream_bronze_scan(star: StarTables) -> DataFrame:
    """Landed events plus the scan of a folder into which nothing has been landed."""
    landing, _ = _landed(star)
    empty = Landing(star.spark, f"{landing.folder}/none")
    return _typed_events(landing.read(stream_schema()).unionByName(empty.read(stream_schema())))


@query
def stream_capped(star: StarTables) -> DataFrame:
    """Runs with a cap of 300, 300 and 250 events over a topic that holds more, then the rest in one."""
    landing, _ = _landed(star, (300, 300, 250, None))
    return landing.ledger().select("run_id", "events_consumed", "stream_offset_start", "stream_offset_end")


@query
def stream_rerun_noop(star: StarTables) -> DataFrame:
    landing, stream = _landed(star)
    landing.consume(stream)
    return landing.ledger().agg(
        F.count(F.lit(1)).alias("batches"), F.sum("events_consumed").alias("events_consumed")
    )


@query
def stream_offsets(star: StarTables) -> DataFrame:
    """Offset of every event in a topic log ordered by event id, with the offsets of its run."""
    space = Workspace(star.spark)
    ordered = _event_lines(star).orderBy(F.col("event_id").cast("bigint"))
    landing = Landing(star.spark, space.path("landing"), PROFILE)
    place = _topic(star, space, ordered)
    for cap in (400, None):
        landing.consume_log(place, stream_schema(), cap)
    events = landing.read(stream_schema())
    return events.selectExpr("bigint(event_id) as event_id", "stream_offset", "stream_offset_start", "stream_offset_end")


@query
def stream_append(star: StarTables) -> DataFrame:
    """Producers append the odd events to files that the first run has read; the run of every event."""
    space = Workspace(star.spark)
    events = _event_lines(star).repartition(int(star.spark.conf.get("spark.sql.shuffle.partitions")), "event_id")
    landing = Landing(star.spark, space.path("landing"), PROFILE)
    for odd in (0, 1):
        part = events.where(F.col("event_id").cast("bigint") % 2 == odd)
        topic.append_lines(part.select(F.to_json(F.struct(*part.columns)).alias("line")), space.path("topic"))
        landing.consume_log(space.path("topic"), stream_schema())
    return landing.read(stream_schema()).selectExpr("bigint(event_id) as event_id", "run_id", "stream_offset_end")


@query
def stream_log_capped(star: StarTables) -> DataFrame:
    """Lines read and events released by runs with a cap of 300, 300 and 250 over a log that holds more."""
    space = Workspace(star.spark)
    place = _topic(star, space)
    landing = Landing(star.spark, space.path("landing"), PROFILE)
    for cap in (300, 300, 250, None):
        landing.consume_log(place, stream_schema(), cap, cell=128)
    read = landing.received().select("first_offset", (F.col("next_offset") - F.col("first_offset")).alias("lines_read"))
    runs = landing.ledger().select("run_id", "events_consumed", "stream_offset_start")
    return runs.join(read, runs["stream_offset_start"] == read["first_offset"]).drop("first_offset")


@query
def stream_missing_topic(star: StarTables) -> DataFrame:
    """Runs over a topic that is not there yet consume nothing and leave nothing; once it is there, all of it."""
    space = Workspace(star.spark)
    landing = Landing(star.spark, space.path("landing"), PROFILE)
    early = [landing.consume_log(space.path("topic"), stream_schema(), cap) for cap in (None, 100)]
    traces = int(lake.path_exists(star.spark, landing.folder))
    landing.consume_log(_topic(star, space), stream_schema())
    consumed = landing.ledger().agg(F.sum("events_consumed").alias("consumed"), F.count(F.lit(1)).alias("runs"))
    return consumed.withColumns({"consumed_early": F.lit(sum(early)), "traces": F.lit(traces)})


@query
def stream_rejects(star: StarTables) -> DataFrame:
    """Every tenth line of the topic is cut short; such lines are kept apart and the others land."""
    space = Workspace(star.spark)
    event = F.to_json(F.struct(*_event_lines(star).columns))
    number = F.col("event_id").cast("bigint")
    line = F.when(number % 10 == 3, F.substring(event, 1, 30)).otherwise(event)
    _event_lines(star).select(line.alias("value")).write.text(space.path("topic"))
    landing = Landing(star.spark, space.path("landing"), PROFILE)
    landing.consume(file_topic(star.spark, space.path("topic"), stream_schema()))
    good = landing.read(stream_schema()).selectExpr("'landed' as kind", "bigint(event_id) as event_id")
    cut = landing.rejects().select(F.regexp_extract("line", "\"event_id\":\"([0-9]+)", 1).cast("bigint").alias("event_id"))
    both = good.unionByName(cut.select(F.lit("rejected").alias("kind"), "event_id"))
    return both.groupBy("kind").agg(F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("ids"))


@query
def stream_compacted(star: StarTables) -> DataFrame:
    """Three capped runs, merged into one folder after the second, read like three."""
    landing, stream = _landed(star, (300, 300))
    landing.compact()
    landing.consume(stream)
    return landing.read(stream_schema()).groupBy("run_id").agg(
        F.count(F.lit(1)).alias("events"), F.min("stream_offset").alias("first"), F.max("stream_offset").alias("last")
    )


@query
def stream_freshness(star: StarTables) -> DataFrame:
    landing, _ = _landed(star)
    return landing.freshness().withColumn("latest_event_ts", F.col("latest_event_ts").cast("timestamp_ntz"))


@query
def stream_dedup(star: StarTables) -> DataFrame:
    """The topic is landed twice from two folders; silver keeps each event once."""
    with ThreadPoolExecutor(2) as pool:  # neither waits for the other
        landing, replay = (landed for landed, _ in pool.map(_landed, [star, star]))
    both = landing.read(stream_schema()).unionByName(replay.read(stream_schema()))
    return silver.web_events(_typed_events(both), LATE_CUTOFF, ("event_ts",))


@query
def late_events(star: StarTables) -> DataFrame:
    events = silver.web_events(star.web_events, LATE_CUTOFF)
    return events.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("events"), F.count_if("is_late_event").alias("late_events")
    )
