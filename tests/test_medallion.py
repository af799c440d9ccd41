"""One small batch of raw files with planted defects, from bronze to the scorecard."""

import json

import pytest

from lakemart.plans import medallion
from lakemart.sources import lake
from lakemart.sources.model import RAW_COLUMNS, stream_schema
from lakemart.streaming.landing import file_topic
from tests.conftest import rows
from tests.test_streaming import event

CUSTOMERS = [f"c{i}" for i in range(1, 31)]
ORDERS = [f"o{i:02d}" for i in range(40)]


def batch(folder):
    def write(name, header, lines):
        (folder / f"{name}.csv").write_text("\n".join([header, *lines]) + "\n")

    customers = [f"{c},{c}@example.com,Giza,email,2024-05-01,gold" for c in CUSTOMERS]
    write(
        "customers",
        "customer_id,email,region,acquisition_channel,signup_date,loyalty_tier",
        [*customers, "c1,duplicate@example.com,Giza,email,2024-05-01,gold"],
    )
    products = [f"p{i},BOO-{i:06d},books,Brand 1,5.00,10.00,True" for i in range(25)]
    write(
        "products",
        "product_id,sku,category,brand,unit_cost,unit_price,active",
        [*products, "prod_bad,BOO-000000,books,Brand 1,-10,10.00,True"],
    )
    write("warehouses", "warehouse_id,region,capacity_units,priority", ["w1,Giza,1000,1"])
    write(
        "inventory",
        "warehouse_id,product_id,snapshot_date,on_hand_units,reorder_point",
        ["w1,p1,2026-05-18,0,5", "w1,p1,2026-05-18,9,5", "w1,p2,2026-05-18,20,5"],
    )
    orders = [
        f"{o},{'missing' if i == 0 else CUSTOMERS[i % 30]},2025-01-{1 + i % 28:02d}T10:00:00+00:00,delivered,Giza,EGP"
        for i, o in enumerate(ORDERS)
    ]
    write("orders", "order_id,customer_id,order_ts,status,region,currency", [*orders, orders[1]])
    items = [f"i{i:02d},{o},p{i % 25},w1,{-2 if i == 0 else 2},10.00,0.1" for i, o in enumerate(ORDERS)]
    write("order_items", "order_item_id,order_id,product_id,warehouse_id,quantity,unit_price,discount_pct", items)
    payments = [
        f"y{i:02d},{o},2025-01-01T11:00:00+00:00,card,{'mystery_status' if i == 0 else 'captured'},18.00"
        for i, o in enumerate(ORDERS)
    ]
    write("payments", "payment_id,order_id,payment_ts,payment_method,payment_status,amount", payments)
    shipments = [
        f"s{i:02d},{o},w1,2025-01-02T00:00:00+00:00,2025-01-05T00:00:00+00:00,2025-01-03T12:00:00+00:00,DHL,25.00"
        for i, o in enumerate(ORDERS)
    ]
    write(
        "shipments",
        "shipment_id,order_id,warehouse_id,ship_ts,promised_delivery_ts,delivered_ts,carrier,shipping_cost",
        shipments,
    )
    write(
        "returns",
        "return_id,order_item_id,return_ts,reason,refund_amount",
        [f"r{i:02d},i{i:02d},2026-01-01T00:00:00+00:00,quality,18.00" for i in range(len(ORDERS))],
    )
    events = [event(i, event_type="purchase") for i in range(40)]
    events[0]["event_ts"] = "2024-12-02T00:00:00+00:00"
    for e in events:
        del e["event_source"]
    (folder / "web_events.jsonl").write_text("\n".join(json.dumps(e) for e in events) + "\n\n")


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    batch(folder)
    topic = tmp_path_factory.mktemp("topic")
    (topic / "1.jsonl").write_text("".join(json.dumps(event(i)) + "\n" for i in range(30, 50)))
    run = medallion.Run(spark, str(tmp_path_factory.mktemp("lake")), "ci", "2026-05-18")
    landing = medallion.land_stream(run, file_topic(spark, str(topic), stream_schema()))
    raw, order = medallion.land_raw(run, str(folder))
    results = medallion.bronze(run, raw, order)
    entities = medallion.build_silver(run, results, order, landing.read(stream_schema()))
    run.close()
    gold = medallion.build_gold(run, entities)
    return run, results, entities, gold, medallion.evaluate(run, gold)


def observed(run, name):
    return run.read("observability", name)


def test_planted_defects_are_logged_with_their_row_numbers(done):
    run, *_ = done
    assert rows(observed(run, "contract_issues")) == [
        ("customers", "customer_id", "duplicate_key", 30, "c1"),
        ("order_items", "order_id", "missing_fk:orders.order_id", 0, "o00"),
        ("order_items", "quantity", "not_positive", 0, "-2"),
        ("orders", "customer_id", "missing_fk:customers.customer_id", 0, "missing"),
        ("orders", "order_id", "duplicate_key", 40, "o01"),
        ("payments", "order_id", "missing_fk:orders.order_id", 0, "o00"),
        ("payments", "payment_status", "invalid_allowed_value", 0, "mystery_status"),
        ("products", "unit_cost", "not_positive", 25, "-10"),
        ("returns", "order_item_id", "missing_fk:order_items.order_item_id", 0, "i00"),
        ("shipments", "order_id", "missing_fk:orders.order_id", 0, "o00"),
    ]


def test_summary_and_rejects(done):
    run, results, *_ = done
    summary = {r.table_name: r for r in observed(run, "contract_summary").collect()}
    assert (summary["orders"].raw_rows, summary["orders"].clean_rows, summary["orders"].quality_score) == (41, 39, 95.12)
    assert (summary["products"].clean_rows, summary["products"].quality_score) == (25, 96.15)
    assert summary["order_items"].validation_issues == 2
    assert summary["web_events"].quality_score == 100.0
    rejected = observed(run, "rejected_rows").groupBy("rejected_from").count()
    assert rows(rejected) == [
        ("customers", 1), ("order_items", 1), ("orders", 2), ("payments", 1), ("products", 1), ("returns", 1),
        ("shipments", 1),
    ]
    bronze = run.read("bronze", "customers")
    assert bronze.where("email = 'duplicate@example.com'").count() == 0
    assert bronze.count() == 30


def test_silver_counts(done):
    run, _, entities, *_ = done
    counts = dict(rows(observed(run, "silver_manifest"), "table_name", "silver_rows"))
    assert counts["customers"] == 30
    assert counts["inventory"] == 2
    assert counts["web_events"] == 50
    assert "email" not in entities["customers"].columns
    assert entities["web_events"].where("is_late_event").count() == 1


def test_gold_exports_agree_with_the_written_marts(done):
    run, _, _, gold, _ = done
    assert observed(run, "gold_manifest").count() == 9
    revenue = gold["mart_revenue_daily"]
    exported = medallion.read_export(run, "mart_revenue_daily")
    assert exported.selectExpr("sum(cast(revenue as decimal(28,2)))").first()[0] == (
        revenue.selectExpr("cast(sum(revenue) as decimal(28,2))").first()[0]
    )
    assert gold["mart_customer_ltv"].count() == 30


def test_all_checks_pass(done):
    *_, quality = done
    assert rows(quality["failed_checks"]) == []
    assert rows(quality["platform_scorecard"]) == [(12, 12, 0, 100.0)]


def test_latest_run_is_found_by_zone(done):
    run, *_ = done
    assert medallion.latest_run(run.spark, run.root, "silver", "ci").run_date == "2026-05-18"
    with pytest.raises(FileNotFoundError):
        medallion.latest_run(run.spark, run.root, "silver", "other")


LABELS = ["ingest_profile", "ingest_run_date"]
SILVER_COLUMNS = {
    "customers": ["customer_id", "email_hash", "region", "acquisition_channel", "signup_date", "loyalty_tier", *LABELS],
    "products": [*RAW_COLUMNS["products"], *LABELS, "gross_margin_pct"],
    "warehouses": [*RAW_COLUMNS["warehouses"], *LABELS],
    "inventory": [*RAW_COLUMNS["inventory"], *LABELS, "inventory_risk"],
    "orders": [*RAW_COLUMNS["orders"], *LABELS, "order_date", "order_month"],
    "order_items": [*RAW_COLUMNS["order_items"], *LABELS, "gross_sales", "net_sales"],
    "payments": [*RAW_COLUMNS["payments"], *LABELS, "is_successful_payment"],
    "shipments": [*RAW_COLUMNS["shipments"], *LABELS, "delivery_hours", "delivered_on_time"],
    "returns": [*RAW_COLUMNS["returns"], *LABELS],
    "web_events": [*RAW_COLUMNS["web_events"], *LABELS, "event_date", "event_month", "is_late_event"],
}


@pytest.mark.parametrize("table", RAW_COLUMNS)
def test_zones_hold_no_internal_columns(done, table):
    run, _, entities, *_ = done
    assert run.read("bronze", table).columns == [*RAW_COLUMNS[table], *LABELS]
    assert entities[table].columns == SILVER_COLUMNS[table]


def test_rejects_have_raw_columns_only(done):
    run, *_ = done
    raw = {name for columns in RAW_COLUMNS.values() for name in columns}
    assert set(observed(run, "rejected_rows").columns) == {"rejected_from", *raw}


def test_streamed_events_carry_the_profile(done):
    _, _, entities, *_ = done
    assert rows(entities["web_events"].groupBy("ingest_profile", "ingest_run_date").count()) == [
        ("ci", "2026-05-18", 40), ("ci", "stream", 10),
    ]


def test_everything_is_exported(done):
    run, *_ = done
    medallion.require_outputs(run)
    for name in ("contract_issues", "rejected_rows", "quality_checks", "streaming_freshness", "mart_returns"):
        assert medallion.read_export(run, name).columns
    with pytest.raises(FileNotFoundError, match="nothing.csv"):
        medallion.require_outputs(run, ["nothing.csv", "gold_manifest.csv"])
    assert medallion.read_export(run, "nothing").columns == []


def test_bronze_leaves_no_key_sets(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    batch(tmp_path / "raw")
    run = medallion.Run(spark, str(tmp_path / "lake"), "ci", "2026-05-18")
    raw, order = medallion.land_raw(run, str(tmp_path / "raw"))
    results = medallion.bronze(run, raw, order)
    spaces = [space.folder for space in run._spaces]
    entities = medallion.build_silver(run, results, order)
    run.close()
    assert len(spaces) == 2
    assert not any(lake.path_exists(spark, folder) for folder in spaces)
    assert entities["customers"].count() == 30


def test_silver_deduplicates_what_the_contract_did_not(spark, tmp_path):
    from lakemart.sources.model import TableContract

    run = medallion.Run(spark, str(tmp_path), "ci", "2026-05-18")
    rows_ = spark.createDataFrame([("w1", "Giza", "5", "1", 0), ("w1", "Giza", "6", "1", 1)], "warehouse_id string, region string, capacity_units string, priority string, n int")
    results = medallion.bronze(run, {"warehouses": rows_}, {"warehouses": ("n",)}, {"warehouses": TableContract("warehouses")})
    assert rows(medallion.build_silver(run, results, {"warehouses": ("n",)})["warehouses"], "capacity_units") == [(5,)]


@pytest.mark.parametrize("size", ["2000", "128m"])
def test_kept_copies_do_not_depend_on_the_splits(spark, tmp_path, size):
    folder = tmp_path / "customers.csv"
    folder.mkdir()
    for part in range(2):
        lines = [f"c{k % 400},{part}-{k:04d}@x,Giza,email,2024-05-01,gold" for k in range(800)]
        (folder / f"part-{part}.csv").write_text("\n".join([",".join(RAW_COLUMNS["customers"]), *lines]) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        raw = lake.Workspace(spark).save(lake.with_position(lake.read_csv(spark, str(folder))), "raw")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    from lakemart.operators.contracts import annotate
    from lakemart.sources.model import CONTRACTS

    kept = annotate(raw, CONTRACTS["customers"], {}, lake.POSITION).clean()
    assert {r.email for r in kept.collect()} == {f"0-{k:04d}@x" for k in range(400)}
