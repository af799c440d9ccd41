import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException, ParseException

from lakemart.plans import kpi, marts, quality
from tests.conftest import rows

D = Decimal
DAY = dt.date(2025, 1, 1)


@pytest.fixture(scope="module")
def silver(spark):
    make = spark.createDataFrame
    money = "decimal(18,2)"
    return {
        "customers": make(
            [("c1", "north", "email", "gold"), ("c2", "south", "social", "silver"), ("c3", "south", "email", "gold")],
            "customer_id string, region string, acquisition_channel string, loyalty_tier string",
        ),
        "products": make(
            [("p1", "A-1", "a", D("6.00")), ("p2", "B-2", "b", D("1.00")), ("p3", "B-3", "b", D("2.00"))],
            "product_id string, sku string, category string, unit_cost decimal(12,2)",
        ),
        "warehouses": make([("w1", "north")], "warehouse_id string, region string"),
        "inventory": make(
            [("w1", "p1", "d", 0, 5, True), ("w1", "p2", "d", 5, 5, True), ("w1", "p3", "d", 9, 5, False),
             ("w1", "p1", "e", 10, 5, False), ("w9", "p1", "d", 1, 5, True)],
            "warehouse_id string, product_id string, snapshot_date string, on_hand_units bigint,"
            " reorder_point bigint, inventory_risk boolean",
        ),
        "orders": make(
            [("o1", "c1", DAY, "north", "paid", dt.datetime(2025, 1, 1, 8)),
             ("o2", "c1", DAY, "north", "delivered", dt.datetime(2025, 1, 1, 9)),
             ("o3", "c2", DAY, "south", "cancelled", dt.datetime(2025, 1, 1, 10)),
             ("o4", "c2", DAY, "south", None, dt.datetime(2025, 1, 1, 11)),
             ("o5", "c2", dt.date(2025, 1, 2), "south", "paid", dt.datetime(2025, 1, 2, 11))],
            "order_id string, customer_id string, order_date date, region string, status string, order_ts timestamp",
        ),
        "order_items": make(
            [("i1", "o1", "p1", 1, D("10.00"), D("0.1")), ("i2", "o1", "p2", 2, D("5.01"), D("0")),
             ("i3", "o2", "p1", 1, D("10.00"), D("0")), ("i4", "o3", "p2", 3, D("9.00"), D("0"))],
            f"order_item_id string, order_id string, product_id string, quantity bigint, net_sales {money},"
            " discount_pct decimal(5,4)",
        ),
        "payments": make([("y1", None)], "payment_id string, payment_ts timestamp"),
        "shipments": make(
            [("s1", "o1", "DHL", D("10.00"), True, D("3.00")), ("s2", "o2", "DHL", None, False, D("4.00"))],
            f"shipment_id string, order_id string, carrier string, delivery_hours {money},"
            " delivered_on_time boolean, shipping_cost decimal(12,2)",
        ),
        "returns": make(
            [("r1", "i2", "damaged", D("5.01")), ("r2", "i4", "damaged", D("9.00")), ("r3", "zz", "quality", D("1"))],
            f"return_id string, order_item_id string, reason string, refund_amount {money}",
        ),
        "web_events": make(
            [("e1", "s1", "purchase", DAY, "email", True), ("e2", "s1", "purchase", DAY, "email", False),
             ("e3", "s1", "page_view", DAY, "email", False), ("e4", None, "product_view", DAY, "social", False)],
            "event_id string, session_id string, event_type string, event_date date, campaign string,"
            " is_late_event boolean",
        ).selectExpr("*", "timestamp '2025-01-01 00:00:00' as event_ts"),
    }


def test_revenue_daily(silver):
    assert rows(marts.revenue_daily(silver)) == [
        (DAY, "north", 2, 1, D("25.01"), D("11.01"), 0.4402, 8.34),
    ]


def test_product_performance_counts_cancelled_and_keeps_unsold(silver):
    out = rows(marts.product_performance(silver))
    assert out == [
        ("p1", "A-1", "a", 2, 2, D("20.00"), D("8.00"), 0.05),
        ("p2", "B-2", "b", 2, 5, D("14.01"), D("9.01"), 0.0),
        ("p3", "B-3", "b", 0, None, None, None, None),
    ]
    listed = [r.product_id for r in marts.ordered(marts.product_performance(silver), "mart_product_performance").collect()]
    assert listed == ["p1", "p2", "p3"]


def test_inventory_bands_and_unknown_warehouse(silver):
    out = rows(marts.inventory_risk(silver), "product_id", "snapshot_date", "risk_band")
    assert out == [("p1", "d", "stockout"), ("p1", "e", "healthy"), ("p2", "d", "reorder"), ("p3", "d", "watch")]
    assert rows(kpi.risk_band_counts(marts.inventory_risk(silver))) == [
        ("healthy", 1), ("reorder", 1), ("stockout", 1), ("watch", 1),
    ]


def test_customer_ltv_ignores_cancelled_and_unknown_status(silver):
    assert rows(marts.customer_ltv(silver)) == [
        ("c1", "north", "email", "gold", 2, D("25.01"), 8.34, DAY),
        ("c2", "south", "social", "silver", 1, D("0.00"), 0.0, dt.date(2025, 1, 2)),
        ("c3", "south", "email", "gold", 0, D("0.00"), 0.0, None),
    ]


def test_funnel_rate_may_exceed_one_and_is_null_without_sessions(silver):
    funnel = marts.funnel_conversion(silver)
    assert rows(funnel) == [
        (DAY, "email", 3, 1, 0, 0, 0, 2, 2.0, 1),
        (DAY, "social", 1, 0, 1, 0, 0, 0, None, 0),
    ]
    assert rows(kpi.funnel_stages(funnel)) == [
        ("add_to_cart", 0), ("checkout_starts", 0), ("product_views", 1), ("purchase_events", 2),
    ]


def test_fulfillment_sla_averages_only_delivered(silver):
    assert rows(marts.fulfillment_sla(silver)) == [(DAY, "DHL", 2, 10.0, 0.5, D("7.00"))]


def test_returns_per_category(silver):
    assert rows(marts.returns(silver)) == [("b", "damaged", 2, D("14.01"), 7.01)]


def test_freshness_and_run_row(silver):
    gold = marts.build_all(silver, "ci", "run_date=x")
    assert tuple(gold) == marts.GOLD_MARTS
    fresh = rows(gold["mart_data_freshness"], "source_name", "rows_loaded")
    assert fresh == [("orders", 5), ("payments", 1), ("web_events", 4)]
    run = gold["mart_pipeline_runs"].first()
    assert (run.silver_orders, run.silver_events, run.gold_revenue) == (5, 4, D("25.01"))
    assert (run.inventory_risk_items, run.late_event_partitions) == (2, 1)
    assert run.built_at is not None


def test_empty_marts_give_zero_kpis_and_failing_checks(spark, silver):
    empty = {name: frame.where("false") for name, frame in silver.items()}
    revenue, sla = marts.revenue_daily(empty), marts.fulfillment_sla(empty)
    funnel = marts.funnel_conversion(empty)
    card = quality.scorecard(quality.failed(quality.positive_revenue(revenue)).where("false"))
    assert rows(card) == [(0, 0, 0, 0.0)]
    assert rows(kpi.executive(revenue, marts.customer_ltv(empty), sla, card)) == [(0.0, 0.0, 0.0, 0.0, 0.0)]
    summary = spark.createDataFrame([], "quality_score double")
    manifest = spark.createDataFrame([], "mart_name string")
    checks = quality.checks(summary, manifest, revenue, funnel, sla, ["gold_manifest.csv"])
    got = {r.check_name: (r.passed, r.observed) for r in checks.collect()}
    assert got["contract_quality_floor"] == (False, "0")
    assert got["gold_mart_count"] == (False, "0")
    assert got["late_event_rate"] == (True, "0")
    assert got["positive_revenue"] == (False, "0")
    assert got["sla_rate_bounds"] == (False, "0..1")
    assert got["required_export:gold_manifest.csv"][0] is True
    assert got["required_export:silver_manifest.csv"][0] is False


def test_checks_compare_the_unrounded_rate(spark):
    funnel = spark.createDataFrame([(50004, 1000000)], "late_events bigint, events bigint")
    row = quality.late_event_rate(funnel).first()
    assert (row.passed, row.observed) == (False, "0.05")


def test_sla_bounds_fail_on_null_and_out_of_range(spark):
    def passed(*rates):
        return quality.sla_bounds(spark.createDataFrame([(r,) for r in rates], "on_time_rate double")).first().passed

    assert passed(0.0, 1.0) is True
    assert passed(0.5, None) is False
    assert passed(1.01) is False


def test_scorecard_failed_and_not_null(spark):
    results = spark.createDataFrame([("a", True), ("b", False), ("c", True)], "check_name string, passed boolean")
    assert rows(quality.scorecard(results)) == [(3, 2, 1, 66.67)]
    assert rows(quality.failed(results)) == [("b", False)]
    frame = spark.createDataFrame([(1, None), (2, 3)], "x int, y int")
    assert rows(quality.not_null("t", frame, ["x", "y"])) == [("t", "x", 0, True), ("t", "y", 1, False)]


def test_top_listings_and_sql(spark, silver):
    gold = {"mart_revenue_daily": marts.revenue_daily(silver)}
    assert kpi.top_revenue_days(gold["mart_revenue_daily"]).columns == [
        "order_date", "region", "revenue", "gross_margin_pct",
    ]
    assert kpi.top_revenue(gold["mart_revenue_daily"], 1).count() == 1
    assert kpi.top_funnel(marts.funnel_conversion(silver), 1).first().campaign == "email"
    assert kpi.top_inventory(marts.inventory_risk(silver), 1).first().risk_band == "stockout"
    assert rows(kpi.daily_revenue(gold["mart_revenue_daily"])) == [(DAY, D("25.01"))]
    assert kpi.sql(spark, "select count(*) as n from mart_revenue_daily", gold).first().n == 1


@pytest.mark.parametrize("text", [
    "create table t as select 1", "insert into mart_x values (1)", "set spark.sql.shuffle.partitions = 3", "drop view mart_x",
    "select 1; drop view mart_x", "cache table mart_x", "use default", "",
])
def test_only_queries_run(spark, text):
    with pytest.raises((ParseException, AnalysisException)):
        kpi.sql(spark, text, {"mart_x": spark.range(3)})
    marts_ = {"mart_x": spark.range(3)}
    assert kpi.sql(spark, "with a as (select id from mart_x) select sum(id) as s from a -- all\n;", marts_).first().s == 3


def test_stock_is_not_shuffled_for_small_written_tables(spark, tmp_path):
    from lakemart.plans import star_queries
    from lakemart.sources.star import _SCHEMAS

    day = dt.datetime(2024, 1, 1)
    data = {
        "region": [(0, "north")],
        "nation": [(0, "a", 0)],
        "customer": [(1, "c", 0, 1.0, "m")],
        "supplier": [(1, "s", 0, 1.0)],
        "part": [(1, "p", "b", "t", 1, 1.0)],
        "orders": [(1, 1, "O", 1.0, day, "1-URGENT")],
        "events": [(1, day, 1, "view", 1.0, "{}")],
        "lineitem": [(1, 1, 1, k, 1.0, 1.0, 0.0, 0.0, "R", "O", day) for k in range(3)],
    }
    for name, table in data.items():
        spark.createDataFrame(table, _SCHEMAS[name]).write.parquet(str(tmp_path / f"{name}.parquet"))
    star = star_queries.StarTables(spark, str(tmp_path))
    entities = star_queries._read_often(star_queries.Silver(star), star_queries.work(star))
    stock = marts.inventory_risk(entities)
    plan = stock._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
    assert stock.count() == 1


def _star(spark, folder, **data):
    from lakemart.plans import star_queries
    from lakemart.sources.star import _SCHEMAS

    day = dt.datetime(2024, 1, 1)
    plain = {
        "region": [(0, "north")],
        "nation": [(0, "a", 0)],
        "customer": [(1, "c", 0, 1.0, "m")],
        "supplier": [(1, "s", 0, 1.0)],
        "part": [(k, "p", "b", "t", 1, 10.0 * k) for k in (1, 2, 3, 3)],
        "orders": [(k, 1, "O", 1.0, day, "1-URGENT") for k in range(4)],
        "events": [(1, day, 1, "view", 1.0, "{}")],
        "lineitem": [
            (order, product, 1, line, 2.0, price, 0.1, 0.0, flag, "O", day)
            for order, line in ((1, 1), (1, 2), (2, 1), (3, None), (None, 1), (None, None))
            for product, price, flag in ((1, 5.0, "R"), (3, 3.0, "R"), (9, 4.0, "N"), (None, 9.0, "R"))
        ],
    }
    for name, table in {**plain, **data}.items():
        spark.createDataFrame(table, _SCHEMAS[name]).write.parquet(str(folder / f"{name}.parquet"))
    return star_queries.StarTables(spark, str(folder))


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_lines_deduplicated_before_they_are_priced_are_the_same(spark, tmp_path):
    from lakemart.plans import silver as entities
    from lakemart.plans import star_queries

    star = _star(spark, tmp_path)
    order = star_queries.ROW_ORDER["order_items"]
    before = entities.order_items(star.order_items, order)
    lines = star_queries.Silver(star, space=star_queries.work(star))["order_items"]
    same = [name for name in before.columns if name not in star_queries.UNREAD]
    assert rows(lines.select(same)) == rows(before.select(same))
    assert len(rows(lines)) == 4  # three ids, and all lines without one


def test_revenue_of_costed_lines_needs_no_products(spark, tmp_path):
    from lakemart.plans import star_queries

    star = _star(spark, tmp_path)
    plain = star_queries.Silver(star)
    written = star_queries.Silver(star, space=star_queries.work(star))
    assert rows(marts.revenue_daily(written)) == rows(marts.revenue_daily(plain))
    none = {**written, "products": None}
    assert rows(marts.revenue_daily(none)) == rows(marts.revenue_daily(plain))


def test_stock_is_dealt_out_by_product_once(spark, tmp_path):
    from lakemart.plans import star_queries

    star = _star(spark, tmp_path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stock = star.inventory.join(star.products.select("product_id", "category"), "product_id")
        assert _plan(stock).count("Exchange hashpartitioning") == 2  # order lines and products
        assert stock.count() == 3  # product 3 is there twice
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_product_has_several_tasks(spark):
    lines = spark.range(4000).selectExpr(
        "if(id % 10 < 9, 1, id) as product_id", "id div 2 as order_id", "bigint(1) as quantity",
        "cast(1 as decimal(18,2)) as net_sales", "cast(0 as decimal(5,4)) as discount_pct",
    )
    products = spark.range(1, 10).selectExpr("id as product_id", "'s' as sku", "'c' as category", "1BD as unit_cost")
    frame = marts.product_performance({"order_items": lines, "products": products})
    text = _plan(frame)
    assert "hashpartitioning(product_id" in text and "_part" in text
    assert "order_id" not in "".join(part for part in text.splitlines() if "Exchange" in part)  # pairs do not travel twice
    hot = frame.where("product_id = 1").first()
    assert (hot.orders, hot.units_sold, hot.revenue) == (2000, 3600, D("3600.00"))


def test_exports_are_compressed_and_read_back(spark, tmp_path):
    from lakemart.plans import medallion

    run = medallion.Run(spark, str(tmp_path), "p", "2024-01-01")
    run.export(spark.createDataFrame([(1, 'a "b", c'), (2, None)], "n int, x string"), "t")
    parts = [path.name for path in (tmp_path / "exports/t.csv").iterdir() if path.name.startswith("part-")]
    assert parts and all(name.endswith(".csv.gz") for name in parts)
    assert rows(medallion.read_export(run, "t")) == [("1", 'a "b", c'), ("2", None)]


def _found(star):
    from lakemart.plans import star_queries
    from lakemart.sources.model import TABLES

    lines = star_queries.written(star, star_queries.work(star))
    results = star_queries.validated(lines, *[table for table in TABLES if table != "returns"])
    return lines, results, star_queries._first_copies(results)


@pytest.mark.parametrize("few", [100_000, 0])
def test_first_copies_of_the_contracts_are_those_of_the_deduplication(spark, tmp_path, monkeypatch, few):
    from lakemart.operators import contracts
    from lakemart.plans import star_queries

    monkeypatch.setattr(contracts, "_FEW", few)
    day = dt.datetime(2024, 1, 1)
    lines = [
        (order, product, 1, 1 + k % 2, -1.0 if product == 2 else 2.0, 7.0 + k, 0.1, 0.0, "RN"[k % 2], "O", day)
        for order in (1, 2, 9)
        for k, product in enumerate((3, 2, 1, 2, 1))
    ]
    parts = [(k, "p", "b", "t", 1, 10.0 * k) for k in (1, 2, 3)]
    star = _star(spark, tmp_path, lineitem=lines, part=parts)
    written, results, firsts = _found(star)
    assert {"order_items", "orders", "customers", "payments", "shipments", "web_events"} <= set(firsts)
    results["returns"] = star_queries._returns(written, results, star_queries.Silver(written, firsts=firsts)["order_items"])
    firsts.update(star_queries._first_copies({"returns": results["returns"]}))
    plain, known = star_queries.Silver(star), star_queries.Silver(written, firsts=firsts)
    for table in plain:
        assert rows(known[table].select(plain[table].columns)) == rows(plain[table]), table
    assert all(word not in _plan(known["order_items"]) for word in ("Window", "Exchange", "Join"))
    for table, result in _at_once(star).items():
        assert rows(results[table].rejected()) == rows(result.rejected()), table


def _at_once(star):
    from lakemart.operators import contracts
    from lakemart.plans import star_queries
    from lakemart.sources.model import TABLES

    raw = {table: star_queries.raw_table(star, table) for table in TABLES}
    order = star_queries.ROW_ORDER
    return contracts.validate_all(raw, star_queries.STAR_CONTRACTS, order, star_queries.work(star))


def test_rejects_are_the_same_where_copies_share_a_place(spark, tmp_path):
    from lakemart.plans import star_queries

    day = dt.datetime(2024, 1, 1)
    lines = [(1, 1, 1, 1, -1.0, 5.0, 0.1, 0.0, "R", "O", day)] * 2 + [(2, 2, 1, 1, 2.0, 5.0, 0.1, 0.0, "R", "O", day)]
    star = _star(spark, tmp_path, lineitem=lines, orders=[(2, 1, "O", 1.0, day, "1-URGENT")] * 2)
    behind = star_queries.validated(star, *star_queries.TABLES)
    for table, result in _at_once(star).items():
        assert rows(behind[table].rejected()) == rows(result.rejected()), table
    assert behind["returns"].rejected().count() > 0


def test_copies_that_share_a_place_are_left_to_the_deduplication(spark, tmp_path):
    from lakemart.plans import star_queries

    star = _star(spark, tmp_path)  # product 3 is there twice, and lines have nulls in their order
    written, _, firsts = _found(star)
    assert "products" not in firsts and "order_items" not in firsts and "orders" in firsts
    plain, known = star_queries.Silver(star), star_queries.Silver(written, firsts=firsts)
    for table in ("products", "order_items", "orders", "returns"):
        assert rows(known[table].select(plain[table].columns)) == rows(plain[table]), table


def test_keys_of_lines_are_read_without_their_prices(spark, tmp_path):
    from lakemart.plans import star_queries
    from lakemart.sources.lake import Workspace

    (tmp_path / "a").mkdir(), (tmp_path / "b").mkdir()
    parts = [(k, "p", "b", "t", 1, 10.0 * k) for k in (1, 2, 3)]
    star = _star(spark, tmp_path / "a", part=parts)
    late = star_queries.joined_late(star, Workspace(spark)).order_items
    assert "Join" not in _plan(late.select("order_item_id", "order_id", "product_id"))
    assert rows(late) == rows(star.order_items)
    twice = _star(spark, tmp_path / "b")  # product 3 has two prices, and its lines are there twice
    lines = star_queries.joined_late(twice, Workspace(spark)).order_items
    assert all("raw_order_items" in name for name in lines.inputFiles())
    assert rows(lines) == rows(twice.order_items)
