import datetime as dt
import hashlib
from decimal import Decimal, localcontext

import pytest

from lakemart.functions.scalars import PRICE, hours_between, parse_decimal, parse_long, ratio, sku
from lakemart.operators.dedup import keep_first
from lakemart.plans import silver
from tests.conftest import rows


def test_customers_hash_the_email_and_drop_it(spark):
    frame = spark.createDataFrame(
        [("c1", " Ann@Example.com\t\n", "Giza", "email", "2025-01-03", "gold"), ("c2", "b", "x", "y", "soon", "z")],
        "customer_id string, email string, region string, acquisition_channel string, signup_date string,"
        " loyalty_tier string",
    )
    out = silver.customers(frame, ["customer_id"])
    assert out.columns == [
        "customer_id", "email_hash", "region", "acquisition_channel", "signup_date", "loyalty_tier",
    ]
    first, second = sorted(out.collect())
    assert first.email_hash == hashlib.sha256(b"ann@example.com").hexdigest()
    assert first.signup_date == dt.date(2025, 1, 3)
    assert second.signup_date is None


def test_items_round_half_up_from_the_rounded_gross(spark):
    frame = spark.createDataFrame(
        [("a", "1", "2.675", "0.5"), ("b", "3", "1.005", None), ("c", "2.0", "0.125", "x"), ("d", "2", "bad", "0.1")],
        "order_item_id string, quantity string, unit_price string, discount_pct string",
    )
    out = {r.order_item_id: r for r in silver.order_items(frame).collect()}
    assert (out["a"].unit_price, out["a"].gross_sales, out["a"].net_sales) == (
        Decimal("2.68"), Decimal("2.68"), Decimal("1.34"),
    )
    assert (out["b"].unit_price, out["b"].gross_sales, out["b"].net_sales) == (
        Decimal("1.01"), Decimal("3.03"), Decimal("3.03"),
    )
    assert (out["c"].quantity, out["c"].discount_pct, out["c"].net_sales) == (2, Decimal("0.0000"), Decimal("0.26"))
    assert out["d"].unit_price is None and out["d"].net_sales is None


def test_products_margin_and_booleans(spark):
    frame = spark.createDataFrame(
        [("p1", "6", "10", "True"), ("p2", "6", "0", "false"), ("p3", "x", "10", "maybe")],
        "product_id string, unit_cost string, unit_price string, active string",
    )
    assert rows(silver.products(frame), "product_id", "gross_margin_pct", "active") == [
        ("p1", 0.4, True), ("p2", None, False), ("p3", None, None),
    ]


def test_shipments_without_delivery_are_not_on_time(spark):
    frame = spark.createDataFrame(
        [
            ("s1", "2025-01-01T00:00:00+00:00", "2025-01-03T00:00:00+00:00", "2025-01-02T12:00:18+00:00", "25.555"),
            ("s2", "2025-01-01T00:00:00+02:00", "2025-01-03T00:00:00+00:00", None, "1"),
            ("s3", "2025-01-01T00:00:00+00:00", "2025-01-01T01:00:00+00:00", "2025-01-01T02:00:00+00:00", "x"),
        ],
        "shipment_id string, ship_ts string, promised_delivery_ts string, delivered_ts string, shipping_cost string",
    )
    assert rows(silver.shipments(frame), "shipment_id", "delivery_hours", "delivered_on_time", "shipping_cost") == [
        ("s1", Decimal("36.01"), True, Decimal("25.56")),
        ("s2", None, False, Decimal("1.00")),
        ("s3", Decimal("2.00"), False, None),
    ]


def test_orders_use_the_utc_day(spark):
    frame = spark.createDataFrame([("o", "2025-01-31T23:30:00-02:00")], "order_id string, order_ts string")
    row = silver.orders(frame).first()
    assert (row.order_date, row.order_month) == (dt.date(2025, 2, 1), "2025-02")


def test_inventory_keeps_the_first_of_the_composite_key(spark):
    frame = spark.createDataFrame(
        [(2, "w", "p", "d", "7", "5"), (1, "w", "p", "d", "5", "5"), (3, "w", "p", "e", "0", "5")],
        "n int, warehouse_id string, product_id string, snapshot_date string, on_hand_units string,"
        " reorder_point string",
    )
    assert rows(silver.inventory(frame, ["n"]), "n", "on_hand_units", "inventory_risk") == [(1, 5, True), (3, 0, True)]


def test_payments_success(spark):
    frame = spark.createDataFrame(
        [("a", "captured"), ("b", "failed"), ("c", None)], "payment_id string, payment_status string"
    ).selectExpr("*", "'2025-01-01' as payment_ts", "'1' as amount")
    assert rows(silver.payments(frame), "payment_id", "is_successful_payment") == [
        ("a", True), ("b", False), ("c", False),
    ]


EVENT = "event_id string, customer_id string, event_ts string, event_type string, campaign string"


def test_batch_wins_over_stream_and_late_events_stay(spark):
    batch = spark.createDataFrame(
        [("e1", "c", "2024-12-02T00:00:00+00:00", "search", "email"), ("e2", "c", "2025-02-01", "search", "email")],
        EVENT,
    ).selectExpr("*", "'ci' as ingest_profile", "'2026-05-18' as ingest_run_date")
    stream = spark.createDataFrame(
        [("e2", "stream", "2026-01-01", "purchase", "stream"), ("e3", "bad", "2026-01-01", "purchase", "stream"),
         ("e3", "bad", "2026-01-02", "purchase", "stream")],
        "event_id string, customer_id string, event_ts string, event_type string, event_source string",
    )
    out = silver.web_events_with_stream(batch, stream, ["event_ts"])
    assert "event_source" not in out.columns
    assert rows(out, "event_id", "customer_id", "campaign", "ingest_run_date", "is_late_event", "event_month") == [
        ("e1", "c", "email", "2026-05-18", True, "2024-12"),
        ("e2", "c", "email", "2026-05-18", False, "2025-02"),
        ("e3", "bad", None, "stream", False, "2026-01"),
    ]


def test_keep_first_survives_a_hot_key(spark):
    frame = spark.sql("select id as n, if(id % 3 = 0, -1, id) as k from range(9000)")
    out = keep_first(frame, ["k"], ["n"])
    assert out.count() == 6001
    assert rows(out.where("k = -1"), "n") == [(0,)]


def test_parse_helpers(spark):
    frame = spark.createDataFrame([("12.0",), ("1e3",), ("x",), ("",), (None,)], "t string")
    assert [r[0] for r in frame.selectExpr(parse_long(frame, "t")).collect()] == [12, 1000, None, None, None]
    assert frame.selectExpr(parse_decimal("t", PRICE)).first()[0] == Decimal("12.00")
    one = spark.range(1)
    assert one.selectExpr(sku("'electronics'", "42")).first()[0] == "ELE-000042"
    assert one.selectExpr(sku("'toys'", "1234567")).first()[0] == "TOY-1234567"
    assert one.selectExpr(ratio("1", "0", 2)).first()[0] is None
    hours = hours_between("timestamp '2025-01-01 00:00:00'", "timestamp '2025-01-01 01:30:00'")
    assert one.selectExpr(hours).first()[0] == Decimal("1.50")


@pytest.mark.parametrize("value, digits, expected", [(("1", "8"), 2, 0.13), (("-1", "3"), 2, -0.33), (("2", "3"), 4, 0.6667)])
def test_ratio_rounds_half_up(spark, value, digits, expected):
    assert spark.range(1).selectExpr(ratio(*value, digits)).first()[0] == expected


def test_values_beyond_the_usual_survive(spark):
    lines = [("a", "1", "10.00", "15"), ("b", "99999999999", "99999999999.5", None), ("c", "9223372036854775807", "9999999999999999.99", "0")]
    frame = spark.createDataFrame(lines + [("d", "1", "10.00", "1e30")], "order_item_id string, quantity string, unit_price string, discount_pct string")
    out = {r.order_item_id: r for r in silver.order_items(frame).collect()}
    assert (out["a"].discount_pct, out["a"].net_sales) == (Decimal(15), Decimal("-140.00"))
    assert out["b"].net_sales == Decimal("9999999999850000000000.50")
    with localcontext(prec=50):
        assert out["c"].gross_sales == Decimal("9223372036854775807") * Decimal("9999999999999999.99")
    assert (out["d"].discount_pct, out["d"].gross_sales, out["d"].net_sales) == (None, Decimal("10.00"), None)
