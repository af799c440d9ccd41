"""Silver entities: typed, deduplicated, PII-hashed, with derived columns.

Each function takes the clean rows of one table. ``order_by`` turns keep-first deduplication on; leave it out where a
contract has already made the key unique, which saves a shuffle of the whole table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from lakemart.functions.scalars import (
    AMOUNT,
    COUNT,
    PRICE,
    RATE,
    SHARE,
    assign,
    holds,
    hours_between,
    listed,
    literal,
    month_of,
    parse_bool,
    parse_date,
    parse_decimal,
    parse_long,
    parse_or_zero,
    parse_timestamp,
    pii_hash,
    quoted,
    ratio,
    times,
)
from lakemart.operators.dedup import keep_first
from lakemart.sources.model import KEYS, SUCCESSFUL_PAYMENTS

Order = Sequence[str] | None

METADATA = ("ingest_profile", "ingest_run_date")
BATCH, STREAM = 0, 1
# Fixed value: events before this moment count as late.
LATE_BEFORE = "2025-01-01 00:00:00"
_PRIORITY, _OFFSET = "_source_priority", "_stream_offset"
EVENT_ORDER = (_PRIORITY, _OFFSET)  # of the copies of an event, before the order of their table


def _first_copies(frame: DataFrame, table: str, order_by: Order) -> DataFrame:
    return keep_first(frame, KEYS[table], order_by) if order_by else frame


def customers(frame: DataFrame, order_by: Order = None) -> DataFrame:
    """Fixed column list; the e-mail leaves only as a hash."""
    return _first_copies(frame, "customers", order_by).selectExpr(
        "customer_id",
        f"{pii_hash('email')} as email_hash",
        "region",
        "acquisition_channel",
        f"{parse_date('signup_date')} as signup_date",
        "loyalty_tier",
        *[name for name in METADATA if name in frame.columns],
    )


def products(frame: DataFrame, order_by: Order = None) -> DataFrame:
    typed = assign(
        _first_copies(frame, "products", order_by),
        {
            "unit_cost": parse_decimal("unit_cost", PRICE),
            "unit_price": parse_decimal("unit_price", PRICE),
            "active": parse_bool("active"),
        },
    )
    return assign(typed, {"gross_margin_pct": ratio("unit_price - unit_cost", "unit_price", 4)})


def warehouses(frame: DataFrame, order_by: Order = None) -> DataFrame:
    whole = {name: parse_long(frame, name) for name in ("capacity_units", "priority")}
    return assign(_first_copies(frame, "warehouses", order_by), whole)


def inventory(frame: DataFrame, order_by: Order = None) -> DataFrame:
    whole = {name: parse_long(frame, name) for name in ("on_hand_units", "reorder_point")}
    typed = assign(_first_copies(frame, "inventory", order_by), whole)
    return assign(typed, {"inventory_risk": holds("on_hand_units <= reorder_point")})


def orders(frame: DataFrame, order_by: Order = None) -> DataFrame:
    typed = assign(_first_copies(frame, "orders", order_by), {"order_ts": parse_timestamp(frame, "order_ts")})
    return assign(typed, {"order_date": "date(order_ts)", "order_month": month_of("order_ts")})


def order_items(frame: DataFrame, order_by: Order = None) -> DataFrame:
    """Net sales start from the rounded gross sales and the discount, rounded to four digits."""
    typed = assign(
        _first_copies(frame, "order_items", order_by),
        {
            "quantity": parse_long(frame, "quantity"),
            "unit_price": parse_decimal("unit_price", PRICE),
            "discount_pct": f"try_cast({parse_or_zero('discount_pct', SHARE)} as {RATE})",
        },
    )
    gross = assign(typed, {"gross_sales": times(f"cast(quantity as {COUNT})", "unit_price", AMOUNT)})
    return assign(gross, {"net_sales": times("gross_sales", f"(cast(1 as {RATE}) - discount_pct)", AMOUNT)})


def payments(frame: DataFrame, order_by: Order = None) -> DataFrame:
    return assign(
        _first_copies(frame, "payments", order_by),
        {
            "payment_ts": parse_timestamp(frame, "payment_ts"),
            "amount": parse_decimal("amount", AMOUNT),
            "is_successful_payment": holds(f"payment_status in ({listed(SUCCESSFUL_PAYMENTS)})"),
        },
    )


def shipments(frame: DataFrame, order_by: Order = None) -> DataFrame:
    """An undelivered shipment has no hours and is not on time."""
    times = ("ship_ts", "promised_delivery_ts", "delivered_ts")
    typed = assign(
        _first_copies(frame, "shipments", order_by),
        {
            **{name: parse_timestamp(frame, name) for name in times},
            "shipping_cost": parse_decimal("shipping_cost", PRICE),
        },
    )
    return assign(
        typed,
        {
            "delivery_hours": hours_between("ship_ts", "delivered_ts"),
            "delivered_on_time": holds("delivered_ts <= promised_delivery_ts"),
        },
    )


def returns(frame: DataFrame, order_by: Order = None) -> DataFrame:
    return assign(
        _first_copies(frame, "returns", order_by),
        {
            "return_ts": parse_timestamp(frame, "return_ts"),
            "refund_amount": parse_decimal("refund_amount", AMOUNT),
        },
    )


def web_events(frame: DataFrame, late_before: str = LATE_BEFORE, order_by: Order = None) -> DataFrame:
    """Events before ``late_before`` are flagged late and kept."""
    typed = assign(_first_copies(frame, "web_events", order_by), {"event_ts": parse_timestamp(frame, "event_ts")})
    cutoff = f"cast({literal(late_before)} as {typed.schema['event_ts'].dataType.simpleString()})"
    return assign(
        typed,
        {
            "event_date": "date(event_ts)",
            "event_month": month_of("event_ts"),
            "is_late_event": holds(f"event_ts < {cutoff}"),
        },
    )


def union_stream(batch: DataFrame, stream: DataFrame, profile: str | None = None) -> DataFrame:
    """Batch events followed by streamed ones, on the batch columns; absent stream columns are null.

    Stream rows have passed no contract; they carry the profile of the run. The added priority column makes the batch
    copy of an event id come first, the offset column orders the copies within the stream as the topic had them.
    """
    aligned = []
    for field in batch.schema:
        kind, name = field.dataType.simpleString(), quoted(field.name)
        if field.name == "ingest_run_date":
            aligned.append(f"'stream' as {name}")
        elif field.name == "ingest_profile" and profile is not None:
            aligned.append(f"{literal(profile)} as {name}")
        elif field.name in stream.columns:
            aligned.append(f"try_cast({name} as {kind}) as {name}")
        else:
            aligned.append(f"cast(null as {kind}) as {name}")
    offset = "stream_offset" if "stream_offset" in stream.columns else "cast(null as bigint)"
    first = batch.selectExpr("*", f"{BATCH} as {_PRIORITY}", f"cast(null as bigint) as {_OFFSET}")
    return first.unionByName(stream.selectExpr(*aligned, f"{STREAM} as {_PRIORITY}", f"{offset} as {_OFFSET}"))


def web_events_with_stream(
    batch: DataFrame,
    stream: DataFrame,
    row_order: Sequence[str],
    late_before: str = LATE_BEFORE,
    profile: str | None = None,
) -> DataFrame:
    """Union of both sources with exact deduplication by event id; the batch copy wins, then the earlier offset."""
    both = union_stream(batch, stream, profile)
    order = (*EVENT_ORDER, *row_order, "event_ts")
    return web_events(both, late_before, order_by=order).drop(*EVENT_ORDER)


ENTITIES = {
    "customers": customers,
    "products": products,
    "warehouses": warehouses,
    "inventory": inventory,
    "orders": orders,
    "order_items": order_items,
    "payments": payments,
    "shipments": shipments,
    "returns": returns,
    "web_events": web_events,
}


def build_all(
    clean: Mapping[str, DataFrame],
    row_order: Mapping[str, Sequence[str]],
    stream: DataFrame | None = None,
    late_before: str = LATE_BEFORE,
    unique: Mapping[str, Sequence[str]] | None = None,
    profile: str | None = None,
) -> dict[str, DataFrame]:
    """Silver entities from contract-clean tables.

    Every table is deduplicated by its key, except where ``unique`` says that the contract in use has made that key
    unique already.
    """
    built = {}
    for table, frame in clean.items():
        order = None if set(KEYS[table]) <= set((unique or {}).get(table, ())) and len(KEYS[table]) == 1 else row_order[table]
        if table == "web_events" and stream is not None:
            built[table] = web_events_with_stream(frame, stream, row_order[table], late_before, profile)
        elif table == "web_events":
            built[table] = web_events(frame, late_before, order_by=order)
        else:
            built[table] = ENTITIES[table](frame, order_by=order)
    return built
