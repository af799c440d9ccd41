"""DuckDB statements that state the expected result of each query over the star-schema test tables."""

from __future__ import annotations

import re

# Named building blocks; a statement pulls in those it mentions, in this order.
_PARTS: dict[str, str] = {
    "places": """
        select n_nationkey as nation, r_name as region from nation, region where n_regionkey = r_regionkey""",
    "customers": """
        select c_custkey as customer_id, c_name as email, region, c_mktsegment as acquisition_channel,
               cast(date '1994-01-01' + cast(c_custkey % 365 as int) as date) as signup_date,
               case when c_acctbal < 2500 then 'standard' when c_acctbal < 5000 then 'silver'
                    when c_acctbal < 8000 then 'gold' else 'platinum' end as loyalty_tier,
               c_acctbal as account_balance
        from customer, places where c_nationkey = nation""",
    "products": """
        select p_partkey as product_id,
               upper(left(p_type, 3)) || '-' ||
                   case when length(cast(p_partkey as varchar)) < 6 then lpad(cast(p_partkey as varchar), 6, '0')
                        else cast(p_partkey as varchar) end as sku,
               p_type as category, p_brand as brand,
               cast(cast(p_retailprice as decimal(18,2)) * 0.60::decimal(3,2) as decimal(18,2)) as unit_cost,
               cast(p_retailprice as decimal(18,2)) as unit_price,
               p_partkey % 25 <> 0 as active
        from part""",
    "warehouses": """
        select s_suppkey as warehouse_id, region, 1000 + (s_suppkey * 37) % 997 as capacity_units,
               1 + s_suppkey % 5 as priority
        from supplier, places where s_nationkey = nation""",
    "inventory": """
        select l_suppkey as warehouse_id, l_partkey as product_id, cast(max(l_shipdate) as date) as snapshot_date,
               (l_partkey * 3 + l_suppkey * 7) % 211 as on_hand_units,
               10 + (l_partkey * 5 + l_suppkey * 3) % 83 as reorder_point
        from lineitem group by l_suppkey, l_partkey""",
    "raw_orders": """
        select o_orderkey as order_id, o_custkey as customer_id, o_orderdate as order_ts,
               case when o_orderpriority = '4-NOT SPECIFIED' then 'cancelled'
                    when o_orderstatus = 'F' and o_orderpriority = '5-LOW' then 'returned'
                    when o_orderstatus = 'F' then 'delivered'
                    when o_orderstatus = 'O' then 'shipped' else 'paid' end as status,
               region, 'USD' as currency
        from orders left join customers on o_custkey = customer_id""",
    "raw_items": """
        select l_orderkey || '-' || l_linenumber as order_item_id, l_orderkey as order_id, l_partkey as product_id,
               l_suppkey as warehouse_id, cast(l_quantity as bigint) as quantity,
               cast(p_retailprice as decimal(18,2)) as unit_price, cast(l_discount as decimal(18,6)) as discount_pct,
               l_extendedprice as extended_price, l_returnflag as return_flag, l_shipdate as ship_date
        from lineitem left join part on l_partkey = p_partkey""",
    "numbered_items": """
        select *, row_number() over (partition by order_item_id
                      order by ship_date, product_id, warehouse_id, extended_price, quantity) as copy_no
        from raw_items""",
    "items": """
        select * exclude (copy_no), cast(quantity * unit_price as decimal(38,2)) as gross_sales,
               cast(cast(quantity * unit_price as decimal(38,2)) * (1 - discount_pct) as decimal(38,2)) as net_sales
        from numbered_items where copy_no = 1""",
    "payments": """
        select o_orderkey as payment_id, o_orderkey as order_id,
               o_orderdate + to_minutes(cast(5 + o_orderkey % 50 as int)) as payment_ts,
               ['voucher', 'transfer', 'invoice'][1 + o_orderkey % 3] as payment_method,
               case when o_orderkey % 10 < 6 then 'captured' when o_orderkey % 10 < 8 then 'authorized'
                    when o_orderkey % 10 < 9 then 'refunded' else 'failed' end as payment_status,
               cast(o_totalprice as decimal(38,2)) as amount
        from orders""",
    "shipments": """
        select order_id as shipment_id, order_id, order_id % (select count(*) from supplier) as warehouse_id,
               order_ts + to_hours(cast(1 + order_id % 30 as int)) as ship_ts,
               order_ts + to_days(cast(3 + order_id % 3 as int)) as promised_delivery_ts,
               order_ts + to_hours(cast(1 + order_id % 30 + 20 + (order_id * 11) % 79 as int)) as delivered_ts,
               ['north line', 'south line', 'east line'][1 + order_id % 3] as carrier,
               cast(cast(300 + order_id % 1501 as decimal(18,2)) * 0.01::decimal(3,2) as decimal(18,2))
                   as shipping_cost
        from raw_orders where status in ('shipped', 'delivered', 'returned')""",
    "returns": """
        select order_item_id as return_id, order_item_id, ship_date + to_days(10) as return_ts,
               ['broken', 'too small', 'too large', 'other'][1 + product_id % 4] as reason,
               net_sales as refund_amount
        from items where return_flag = 'R'""",
    "web_events": """
        select event_id, user_id as customer_id, user_id || '-' || cast(cast(ts as date) as varchar) as session_id,
               ts as event_ts,
               case event_type when 'view' then 'product_view' when 'click' then 'add_to_cart'
                    when 'signup' then 'checkout_start' when 'error' then 'search' else event_type end as event_type,
               event_id % 200 as product_id, ['phone', 'tablet', 'desktop'][1 + event_id % 3] as device,
               'campaign ' || (cast(json_extract_string(props, '$.k') as bigint) % 7) as campaign
        from events""",
    "silver_events": """
        select *, cast(event_ts as date) as event_date, strftime(event_ts, '%Y-%m') as event_month,
               event_ts < timestamp '2024-01-02' as is_late_event
        from web_events""",
    # Contract results: rows with one flag per rule.
    "flagged_customers": "select *, account_balance < 0 as bad from customers",
    "good_customers": "select * from flagged_customers where not bad",
    "flagged_orders": """
        select *, not exists (select 1 from good_customers g where g.customer_id = o.customer_id) as bad
        from raw_orders o""",
    "good_orders": "select * exclude (bad) from flagged_orders where not bad",
    "flagged_items": """
        select *, copy_no > 1 as repeated, order_id not in (select order_id from good_orders) as orphan
        from numbered_items""",
    "good_items": "select * from flagged_items where not repeated and not orphan",
    "table_counts": """
        select 'customers' as table_name, count(*) as raw_rows, count(*) filter (where not bad) as clean_rows,
               count_if(bad) as validation_issues from flagged_customers
        union all select 'products', count(*), count(*), 0 from products
        union all select 'warehouses', count(*), count(*), 0 from warehouses
        union all select 'inventory', count(*), count(*), 0 from inventory
        union all select 'orders', count(*), count_if(not bad), count_if(bad) from flagged_orders
        union all select 'order_items', count(*), count_if(not repeated and not orphan),
                         count_if(repeated) + count_if(orphan) from flagged_items
        union all select 'payments', count(*), count_if(kept), count_if(not kept)
                  from (select order_id in (select order_id from good_orders) as kept from payments)
        union all select 'shipments', count(*), count_if(kept), count_if(not kept)
                  from (select order_id in (select order_id from good_orders) as kept from shipments)
        union all select 'returns', count(*), count_if(kept), count_if(not kept)
                  from (select order_item_id in (select order_item_id from good_items) as kept from returns)
        union all select 'web_events', count(*), count_if(kept), count_if(not kept)
                  from (select customer_id in (select customer_id from good_customers) as kept from web_events)""",
    "summary": """
        select table_name, raw_rows, cast(clean_rows as bigint) as clean_rows,
               cast(raw_rows - clean_rows as bigint) as rejected_rows,
               cast(validation_issues as bigint) as validation_issues,
               floor(clean_rows / raw_rows::double * 100 * 100 + 0.5) / 100 as quality_score
        from table_counts""",
    # Marts, stated on the joined rows.
    "revenue_daily": """
        select cast(order_ts as date) as order_date, region, count(distinct o.order_id) as total_orders,
               count(distinct customer_id) as active_customers, cast(sum(net_sales) as decimal(38,2)) as revenue,
               cast(sum(net_sales - quantity * unit_cost) as decimal(38,2)) as gross_profit,
               floor(cast(sum(net_sales - quantity * unit_cost) as double)
                     / nullif(cast(sum(net_sales) as double), 0) * 1e4 + 0.5) / 1e4 as gross_margin_pct,
               floor(cast(sum(net_sales) as double) / count(net_sales) * 1e2 + 0.5) / 1e2 as avg_item_revenue
        from raw_orders o join items i on o.order_id = i.order_id join products p on i.product_id = p.product_id
        where status <> 'cancelled' group by 1, 2""",
    "inventory_risk": """
        select snapshot_date, i.warehouse_id, region, i.product_id, category, on_hand_units, reorder_point,
               on_hand_units <= reorder_point as inventory_risk,
               case when on_hand_units = 0 then 'stockout' when on_hand_units <= reorder_point then 'reorder'
                    when on_hand_units < 2 * reorder_point then 'watch' else 'healthy' end as risk_band
        from inventory i join warehouses w on i.warehouse_id = w.warehouse_id
        join products p on i.product_id = p.product_id""",
    "funnel": """
        select event_date, campaign, count(*) as events, count(distinct session_id) as sessions,
               count(*) filter (where event_type = 'product_view') as product_views,
               count(*) filter (where event_type = 'add_to_cart') as add_to_cart,
               count(*) filter (where event_type = 'checkout_start') as checkout_starts,
               count(*) filter (where event_type = 'purchase') as purchase_events,
               floor(count_if(event_type = 'purchase')::double / nullif(count(distinct session_id), 0) * 1e4 + 0.5)
                   / 1e4 as session_purchase_rate,
               count(*) filter (where is_late_event) as late_events
        from silver_events group by event_date, campaign""",
    "sla": """
        select cast(order_ts as date) as order_date, carrier, count(*) as shipments,
               floor(cast(sum(hours) as double) / count(hours) * 1e2 + 0.5) / 1e2 as avg_delivery_hours,
               floor(count_if(delivered_ts <= promised_delivery_ts)::double / count(*) * 1e4 + 0.5) / 1e4
                   as on_time_rate,
               cast(sum(shipping_cost) as decimal(38,2)) as shipping_cost
        from (select *, cast(datediff('second', ship_ts, delivered_ts) / 3600 as decimal(18,2)) as hours
              from shipments) s
        join raw_orders o on s.order_id = o.order_id group by 1, 2""",
    "ltv": """
        select c.customer_id, c.region, acquisition_channel, loyalty_tier, count(distinct o.order_id) as orders,
               cast(coalesce(sum(net_sales), 0) as decimal(38,2)) as lifetime_revenue,
               coalesce(floor(cast(sum(net_sales) as double) / nullif(count(net_sales), 0) * 1e2 + 0.5) / 1e2, 0)
                   as avg_item_revenue,
               cast(max(order_ts) as date) as last_order_date
        from customers c
        left join raw_orders o on c.customer_id = o.customer_id and status <> 'cancelled' {orders_since}
        left join items i on o.order_id = i.order_id
        group by 1, 2, 3, 4""",
    "product_performance": """
        select p.product_id, sku, category, count(distinct i.order_id) as orders,
               cast(sum(quantity) as bigint) as units_sold, cast(sum(net_sales) as decimal(38,2)) as revenue,
               cast(sum(net_sales - quantity * unit_cost) as decimal(38,2)) as gross_profit,
               floor(cast(sum(discount_pct) as double) / nullif(count(discount_pct), 0) * 1e4 + 0.5) / 1e4
                   as avg_discount_pct
        from products p left join {sold_items} i on p.product_id = i.product_id group by 1, 2, 3""",
    "returns_mart": """
        select category, reason, count(*) as returns, cast(sum(refund_amount) as decimal(38,2)) as refunded_amount,
               floor(cast(sum(refund_amount) as double) / count(refund_amount) * 1e2 + 0.5) / 1e2 as avg_refund
        from returns r join items i on r.order_item_id = i.order_item_id
        join products p on i.product_id = p.product_id group by 1, 2""",
    "freshness": """
        select 'star' as profile, 'run_date=2024-02-01' as run_partition, 'orders' as source_name,
               max(o_orderdate) as max_observed_ts, count(*) as rows_loaded from orders
        union all select 'star', 'run_date=2024-02-01', 'payments', max(payment_ts), count(*) from payments
        union all select 'star', 'run_date=2024-02-01', 'web_events', max(ts), count(*) from events""",
    "gold_counts": """
        {gold_counts}""",
    "checks": """
        select 'contract_quality_floor' as check_name, min(quality_score) >= 95 as passed,
               regexp_replace(cast(cast(min(quality_score) as decimal(38,4)) as varchar), '\\.?0+$', '') as observed,
               '>= 95' as expected
        from summary
        union all
        select 'required_export:' || name || '.csv', name <> '{left_out}', name || '.csv', 'present'
        from (select mart_name as name from gold_counts where mart_name in
                  ('mart_revenue_daily', 'mart_customer_ltv', 'mart_funnel_conversion', 'mart_fulfillment_sla')
              union all select unnest(['contract_summary', 'silver_manifest', 'gold_manifest']))
        union all select 'gold_mart_count', count(*) >= 9, cast(count(*) as varchar), '>= 9' from gold_counts
        union all
        select 'late_event_rate', sum(late_events) / sum(events) <= 0.05,
               regexp_replace(cast(cast(floor(sum(late_events)::double / sum(events)::double * 1e4 + 0.5) / 1e4
                                        as decimal(38,4)) as varchar), '\\.?0+$', ''), '<= 0.05'
        from funnel
        union all
        select 'positive_revenue', sum(revenue) > 0,
               regexp_replace(cast(cast(sum(revenue) as decimal(38,4)) as varchar), '\\.?0+$', ''), '> 0'
        from revenue_daily
        union all select 'sla_rate_bounds', bool_and(on_time_rate between 0 and 1), '0..1', 'all rows' from sla""",
}


def _statement(body: str, **choices: str) -> str:
    """``body`` below the building blocks it needs."""
    marts = _counts(
        "mart_name",
        "row_count",
        mart_revenue_daily="revenue_daily",
        mart_product_performance="product_performance",
        mart_inventory_risk="inventory_risk",
        mart_customer_ltv="ltv",
        mart_funnel_conversion="funnel",
        mart_fulfillment_sla="sla",
        mart_returns="returns_mart",
        mart_data_freshness="freshness",
        mart_pipeline_runs="(select 1)",
    )
    fill = {"orders_since": "", "sold_items": "items", "left_out": "", "gold_counts": marts, **choices}
    texts = {name: text.format(**fill) if "{" in text else text for name, text in _PARTS.items()}

    def mentioned(text: str) -> set[str]:
        return set(re.findall(r"[a-z_]+", text)) & set(texts)

    # The table "orders" and the block names never collide, so a plain word match finds the blocks.
    needed: set[str] = set()
    todo = mentioned(body)
    while todo:
        name = todo.pop()
        needed.add(name)
        todo |= mentioned(texts[name]) - needed
    blocks = ",\n".join(f"{name} as ({text})" for name, text in texts.items() if name in needed)
    return f"with {blocks}\n{body}" if blocks else body


def _issue(table: str, column: str, kind: str, keys: str, value: str, source: str, where: str) -> str:
    return (
        f"select '{table}' as table_name, '{column}' as column_name, '{kind}' as issue_type, {keys}, "
        f"{value} as value from {source} where {where}"
    )


_LINE_KEYS = "order_item_id, product_id, warehouse_id, quantity, ship_date, extended_price"
_DUPLICATES = _issue(
    "order_items", "order_item_id", "duplicate_key", _LINE_KEYS, "order_item_id", "numbered_items", "copy_no > 1"
)
_EVENT_COLUMNS = "event_id, customer_id, session_id, event_ts, event_type, product_id, device, campaign"
_MANIFEST = "select 'star' as profile, 'run_date=2024-02-01' as run_partition, "


def _counts(name_column: str, count_column: str, **sources: str) -> str:
    return " union all ".join(
        f"{_MANIFEST} '{name}' as {name_column}, count(*) as {count_column} from {source}"
        for name, source in sources.items()
    )


_RAW = {
    "customers": "customers",
    "products": "products",
    "warehouses": "warehouses",
    "inventory": "inventory",
    "orders": "raw_orders",
    "order_items": "raw_items",
    "payments": "payments",
    "shipments": "shipments",
    "returns": "returns",
    "web_events": "web_events",
}

_BODIES: dict[str, str] = {
    # scans and manifests
    "scan_csv_roundtrip": """
        select *, floor(cast(unit_price - unit_cost as double) / nullif(cast(unit_price as double), 0) * 1e4 + 0.5)
               / 1e4 as gross_margin_pct from products""",
    "scan_jsonl_roundtrip": "select * from web_events",
    "latest_partition": """
        select *, strftime(order_ts, '%Y-%m') as run_date from raw_orders
        where strftime(order_ts, '%Y-%m') = (select max(strftime(order_ts, '%Y-%m')) from raw_orders)""",
    "scan_glob": """
        select o.* exclude (region), strftime(order_ts, '%Y-%m') as run_date from raw_orders o
        where month(order_ts) >= 10""",
    "create_table": "select * from products where active",
    "table_versions": """
        select v.version, status, count(*) as orders, cast(sum(order_id) as bigint) as ids,
               cast(sum(customer_id) as bigint) as customers
        from raw_orders, (values (0), (1), (2), (3)) as v(version)
        where case v.version when 0 then status = 'paid' when 1 then true
                   else status <> 'shipped' or order_id % 2 = 0 end
        group by v.version, status""",
    "bronze_zone": "select *, 'star' as ingest_profile, '2024-02-01' as ingest_run_date from good_orders",
    "silver_zone": """
        select *, 'star' as ingest_profile, '2024-02-01' as ingest_run_date, cast(order_ts as date) as order_date,
               strftime(order_ts, '%Y-%m') as order_month from good_orders""",
    "observability_exports": """
        select 'star' as profile, 'run_date=2024-02-01' as run_partition, * from summary
        where table_name in ('customers', 'orders', 'payments')""",
    "rejects_export": """
        select table_name as rejected_from, rejected_rows as rows from summary
        where table_name in ('customers', 'orders', 'payments') and rejected_rows > 0""",
    "missing_outputs": """
        select unnest(['mart_revenue_daily.csv', 'mart_customer_ltv.csv', 'mart_funnel_conversion.csv',
                       'mart_fulfillment_sla.csv', 'silver_manifest.csv', 'gold_manifest.csv']) as output,
               0::int as export_columns""",
    "gold_zone": "select * from sla",
    "mart_read_order": """
        select product_id, revenue,
               cast(row_number() over (order by revenue desc nulls last, product_id) as int) as place
        from product_performance""",
    "ingest_metadata": "select *, 'star' as ingest_profile, '2024-02-01' as ingest_run_date from products",
    "raw_manifest": _counts("table_name", "raw_rows", **_RAW),
    "silver_manifest": _counts("table_name", "silver_rows", **{**_RAW, "order_items": "items"}),
    "gold_manifest": "select * from gold_counts",
    # contracts
    "contract_missing_column": """
        select 'warehouses' as table_name, count(*) as raw_rows, 0::bigint as clean_rows, count(*) as rejected_rows,
               1::bigint as validation_issues, 0::double as quality_score from warehouses""",
    "contract_missing_column_issue": """
        select 'warehouses' as table_name, 'priority' as column_name, 'missing_required_column' as issue_type,
               null::bigint as warehouse_id, null::varchar as value, count(*) as rejected_rows from warehouses""",
    "contract_many_rules": """
        select 'balance_' || k as column_name, count(*) as issues from customers, range(100) as r(k)
        where account_balance < 100 * k group by k""",
    "contract_required": _issue(
        "orders",
        "currency",
        "missing_required_value",
        "order_id",
        "case when order_id % 97 <> 0 then '' end",
        "raw_orders",
        "order_id % 97 = 0 or order_id % 89 = 0",
    ),
    "contract_unique": _DUPLICATES,
    "contract_positive": _issue(
        "order_items",
        "quantity",
        "not_positive",
        "order_item_id, product_id, ship_date, extended_price",
        "case when order_id % 11 = 0 then '-3' else '0' end",
        "raw_items",
        "order_id % 13 <> 0 and (order_id % 11 = 0 or order_id % 7 = 0)",
    ),
    "contract_non_negative": _issue(
        "customers", "account_balance", "negative_value", "customer_id", "account_balance", "customers",
        "account_balance < 0",
    ),
    "contract_allowed": _issue(
        "web_events", "event_type", "invalid_allowed_value", "event_id",
        "case when event_id % 41 <> 0 then event_type end", "events",
        "event_id % 41 = 0 or event_type <> 'purchase'",
    ),
    "contract_fk": _issue(
        "orders", "customer_id", "missing_fk:customers.customer_id", "order_id", "cast(customer_id as varchar)",
        "flagged_orders", "bad",
    ),
    "contract_clean": "select * from good_orders",
    "contract_rejected": """
        select 'order_items' as rejected_from, * exclude (copy_no, repeated, orphan)
        from flagged_items where repeated or orphan""",
    "contract_issues": _DUPLICATES + " union all " + _issue(
        "order_items", "order_id", "missing_fk:orders.order_id", _LINE_KEYS, "cast(order_id as varchar)",
        "flagged_items", "orphan",
    ),
    "orphan_rows": "select order_id, customer_id, order_ts from flagged_orders where bad",
    "contract_cascade": "select * from returns where order_item_id in (select order_item_id from good_items)",
    "rejected_union": """
        select 'customers' as rejected_from, * exclude (bad) from flagged_customers where bad
        union all by name select 'orders' as rejected_from, * exclude (bad) from flagged_orders where bad
        union all by name select 'order_items' as rejected_from, * exclude (copy_no, repeated, orphan)
            from flagged_items where repeated or orphan
        union all by name select 'payments' as rejected_from, * from payments
            where order_id not in (select order_id from good_orders)
        union all by name select 'shipments' as rejected_from, * from shipments
            where order_id not in (select order_id from good_orders)
        union all by name select 'returns' as rejected_from, * from returns
            where order_item_id not in (select order_item_id from good_items)
        union all by name select 'web_events' as rejected_from, * from web_events
            where customer_id not in (select customer_id from good_customers)
        union all by name select 'products' as rejected_from, * from products where unit_cost <= 0 or unit_price <= 0
        union all by name select 'warehouses' as rejected_from, * from warehouses where capacity_units <= 0
        union all by name select 'inventory' as rejected_from, * from inventory
            where on_hand_units < 0 or reorder_point < 0""",
    "issue_counts": """
        select 'customers' as table_name, 'negative_value' as issue_type, count(*) as issues
            from flagged_customers where bad
        union all select 'orders', 'missing_fk:customers.customer_id', count(*) from flagged_orders where bad
        union all select 'order_items', 'duplicate_key', count(*) from flagged_items where repeated
        union all select 'order_items', 'missing_fk:orders.order_id', count(*) from flagged_items where orphan
        union all select table_name, case table_name when 'returns' then 'missing_fk:order_items.order_item_id'
                      when 'web_events' then 'missing_fk:customers.customer_id' else 'missing_fk:orders.order_id' end,
                  validation_issues
            from summary where table_name in ('payments', 'shipments', 'returns', 'web_events')""",
    "contract_summary": "select * from summary",
    # silver
    "silver_customers": """
        select customer_id, sha256(lower(trim(email))) as email_hash, region, acquisition_channel, signup_date,
               loyalty_tier from customers""",
    "silver_products": """
        select *, floor(cast(unit_price - unit_cost as double) / nullif(cast(unit_price as double), 0) * 1e4 + 0.5)
               / 1e4 as gross_margin_pct from products""",
    "silver_warehouses": "select * from warehouses",
    "silver_inventory": "select *, on_hand_units <= reorder_point as inventory_risk from inventory",
    "silver_orders": """
        select *, cast(order_ts as date) as order_date, strftime(order_ts, '%Y-%m') as order_month from raw_orders""",
    "silver_order_items": "select * from items",
    "silver_wide_values": """
        select * exclude (quantity, unit_price, discount_pct, discount, gross), quantity, unit_price,
               discount as discount_pct, gross as gross_sales,
               cast(gross * (1 - discount) as decimal(38,2)) as net_sales
        from (select * exclude (quantity, unit_price, copy_no), quantity * 4000000000 as quantity,
                     cast(unit_price * 100000000 as decimal(18,2)) as unit_price,
                     cast(quantity * 4000000000 * cast(unit_price * 100000000 as decimal(18,2)) as decimal(38,2)) as gross,
                     cast(case when order_id % 7 = 0 then discount_pct + 15 when order_id % 11 = 0 or order_id % 13 = 0
                               then 0 else cast(discount_pct + cast(order_id % 10000 as decimal(10,0)) * 0.00000001::decimal(9,8)
                                               as decimal(18,4)) end as decimal(18,6)) as discount
              from numbered_items where copy_no = 1) w""",
    "silver_payments": "select *, payment_status in ('authorized', 'captured') as is_successful_payment from payments",
    "silver_shipments": """
        select *, cast(datediff('second', ship_ts, delivered_ts) / 3600 as decimal(18,2)) as delivery_hours,
               delivered_ts <= promised_delivery_ts as delivered_on_time from shipments""",
    "silver_returns": "select * from returns",
    "silver_web_events": "select * from silver_events",
    "silver_events_union": """
        select * exclude (campaign), campaign, 'star' as ingest_profile, '2024-02-01' as ingest_run_date
        from silver_events
        union all by name
        select * exclude (campaign, event_id), 2 * event_id as event_id, null as campaign,
               'star' as ingest_profile, 'stream' as ingest_run_date
        from silver_events where 2 * event_id not in (select event_id from events)""",
    "silver_events_incremental": """
        select * exclude (campaign), campaign, 'star' as ingest_profile, '2024-02-01' as ingest_run_date
        from silver_events
        union all by name
        select * exclude (campaign, event_id), 2 * event_id as event_id, null as campaign,
               'star' as ingest_profile, 'stream' as ingest_run_date
        from silver_events where 2 * event_id not in (select event_id from events)""",
    # scalars and dedup
    "dedup_keep_first": """
        select * from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber
            order by l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity) = 1""",
    "dedup_composite": """
        select l_suppkey, l_partkey, cast(l_shipdate as date) as ship_day, l_orderkey, l_linenumber from lineitem
        qualify row_number() over (partition by l_suppkey, l_partkey, cast(l_shipdate as date)
            order by l_orderkey, l_linenumber) = 1""",
    "fn_try_numeric": """
        select *, try_cast(price_text as decimal(18,2)) as price from (
            select product_id, case when product_id % 5 = 0 then 'n/a' when product_id % 7 = 0 then ''
                   else cast(unit_price as varchar) end as price_text from products)""",
    "fn_try_date": """
        select *, try_cast(signup_text as date) as signup_date from (
            select customer_id, case when customer_id % 5 = 0 then 'soon' when customer_id % 7 = 0 then '2024-13-45'
                   else cast(signup_date as varchar) end as signup_text from customers)""",
    "fn_pii_hash": "select customer_id, sha256(lower(email)) as email_hash from customers",
    "fn_json_field": "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events",
    "fn_ts_add": """
        select o_orderkey, o_orderdate + to_minutes(cast(o_orderkey % 90 as int)) as plus_minutes,
               o_orderdate + to_hours(cast(o_orderkey % 50 as int)) as plus_hours,
               o_orderdate + to_days(cast(o_orderkey % 6 as int)) as plus_days from orders""",
    "fn_sku": "select product_id, sku from products",
    # filters and joins
    "shippable_orders": "select * from raw_orders where status in ('shipped', 'delivered', 'returned')",
    "returned_items_semi": """
        select * from raw_items where order_id in (select order_id from raw_orders where status = 'returned')""",
    "stock_grid_gaps": """
        select w.warehouse_id, (select count(*) from products) as cells, count(i.product_id) as filled,
               (select count(*) from products) - count(i.product_id) as missing
        from warehouses w left join inventory i on w.warehouse_id = i.warehouse_id group by w.warehouse_id""",
    "item_price_lookup": """
        select l_orderkey, l_linenumber, l_partkey, l_shipdate, unit_price, unit_cost
        from lineitem left join products on l_partkey = product_id""",
    "order_net_totals": """
        select order_id, cast(sum(quantity * unit_price * (1 - discount_pct)) as decimal(38,6)) as net_total
        from raw_items group by order_id""",
    # marts
    "mart_revenue_daily": "select * from revenue_daily",
    "mart_product_performance": "select * from product_performance",
    "mart_product_performance_recent": "select * from product_performance",
    "mart_product_performance_dirty": """
        select p.product_id, any_value(sku) as sku, any_value(category) as category,
               count(distinct order_id) as orders, cast(sum(quantity) as bigint) as units_sold,
               cast(sum(net) as decimal(38,2)) as revenue,
               cast(sum(net - quantity * unit_cost) as decimal(38,2)) as gross_profit,
               floor(cast(sum(discount) as double) / nullif(count(discount), 0) * 1e4 + 0.5) / 1e4 as avg_discount_pct
        from products p left join (
            select *, cast(cast(quantity * price as decimal(38,2)) * (1 - discount) as decimal(38,2)) as net
            from (select order_id, product_id, quantity,
                         case when order_id % 5 <> 0 and order_id % 17 <> 0 then unit_price end as price,
                         cast(discount_pct + cast(order_id % 10000 as decimal(10,0)) * 0.00000001::decimal(9,8) as decimal(18,4)) as discount
                  from numbered_items where copy_no = 1) x) i
        on p.product_id = i.product_id group by p.product_id""",
    "mart_inventory_risk": "select * from inventory_risk",
    "mart_customer_ltv": "select * from ltv",
    "mart_customer_ltv_recent": "select * from ltv",
    "mart_funnel_conversion": "select * from funnel",
    "mart_fulfillment_sla": "select * from sla",
    "mart_returns": "select * from returns_mart",
    "mart_data_freshness": "select * from freshness",
    "mart_pipeline_runs": """
        select 'star' as profile, 'run_date=2024-02-01' as run_partition, (select count(*) from orders) as silver_orders,
               (select count(*) from events) as silver_events,
               (select cast(sum(revenue) as decimal(38,2)) from revenue_daily) as gold_revenue,
               (select count(*) from inventory where on_hand_units <= reorder_point) as inventory_risk_items,
               (select count(*) from funnel where late_events > 0) as late_event_partitions""",
    # console reads
    "executive_kpis": """
        select (select cast(sum(revenue) as double) from revenue_daily) as revenue,
               (select cast(sum(total_orders) as double) from revenue_daily) as orders,
               (select cast(count(*) as double) from customers) as customers,
               (select floor(cast(sum(cast(on_time_rate as decimal(9,4))) as double) / count(*) * 1e4 + 0.5) / 1e4
                from sla) as on_time_rate,
               (select floor(count_if(passed) / count(*)::double * 100 * 100 + 0.5) / 100 from checks) as platform_score""",
    "daily_revenue": """
        select order_date, cast(sum(revenue) as decimal(38,2)) as revenue from revenue_daily group by order_date""",
    "funnel_stages": """
        select 'product_views' as stage, cast(sum(product_views) as bigint) as events from funnel
        union all select 'add_to_cart', cast(sum(add_to_cart) as bigint) from funnel
        union all select 'checkout_starts', cast(sum(checkout_starts) as bigint) from funnel
        union all select 'purchase_events', cast(sum(purchase_events) as bigint) from funnel""",
    "risk_band_counts": "select risk_band, count(*) as size from inventory_risk group by risk_band",
    "active_customers_monthly": """
        select strftime(order_ts, '%Y-%m') as order_month, count(distinct customer_id) as active_customers
        from raw_orders group by 1""",
    "sessions_weekly": """
        select cast(date_trunc('week', event_ts) as date) as week, count(distinct session_id) as sessions
        from web_events group by 1""",
    "top_revenue_days": """
        select order_date, region, revenue, gross_margin_pct from revenue_daily
        order by order_date desc, revenue desc, region limit 25""",
    "top50_revenue": "select * from revenue_daily order by revenue desc, order_date, region limit 50",
    "top50_funnel": "select * from funnel order by sessions desc, event_date, campaign limit 50",
    "top75_inventory": """
        select * from inventory_risk order by inventory_risk desc, on_hand_units, warehouse_id, product_id limit 75""",
    "adhoc_sql": """
        select region, count(*) as days, max(total_orders) as most_orders,
               cast(sum(revenue) as decimal(38,2)) as revenue,
               (select count(*) from customers c where c.region = r.region) as customers
        from revenue_daily r group by region""",
    # quality
    "quality_checks": "select * from checks",
    "quality_checks_incomplete": "select * from checks where not passed",
    "platform_scorecard": """
        select count(*) as checks_total, count(*) filter (where passed) as checks_passed, count(*) filter (where not passed) as checks_failed,
               floor(count_if(passed) / count(*)::double * 100 * 100 + 0.5) / 100 as platform_score from checks""",
    "failed_checks": "select * from checks where not passed",
    "check_contract_floor": """
        select 'contract_quality_floor' as check_name, min(quality_score) >= 95 as passed,
               regexp_replace(cast(cast(min(quality_score) as decimal(38,4)) as varchar), '\\.?0+$', '') as observed,
               '>= 95' as expected
        from summary""",
    "check_late_rate": "select * from checks where check_name = 'late_event_rate'",
    "check_sla_bounds": "select * from checks where check_name = 'sla_rate_bounds'",
    "not_null_test": """
        select 'mart_revenue_daily' as table_name, column_name, null_rows, null_rows = 0 as passed
        from (select 'order_date' as column_name, count(*) filter (where order_date is null) as null_rows from revenue_daily
              union all select 'revenue', count(*) filter (where revenue is null) from revenue_daily)""",
    # streaming
    "stream_land": f"select {_EVENT_COLUMNS} from web_events",
    "stream_bronze_scan": f"select {_EVENT_COLUMNS} from web_events",
    "stream_capped": """
        select cast(run as bigint) as run_id, upto - since as events_consumed, since as stream_offset_start,
               upto as stream_offset_end
        from (select run, least(since, n) as since, least(upto, n) as upto
              from (values (0, 0::bigint, 300::bigint), (1, 300, 600), (2, 600, 850), (3, 850, 1000000000000)) as r(run, since, upto),
                   (select count(*) as n from events)) where upto > since""",
    "stream_rejects": """
        select case when event_id % 10 = 3 then 'rejected' else 'landed' end as kind, count(*) as rows,
               cast(sum(event_id) as bigint) as ids from events group by 1""",
    "stream_compacted": """
        select cast(least(place // 300, 2) as bigint) as run_id, count(*) as events, min(place) as first, max(place) as last
        from (select row_number() over (order by event_id) - 1 as place from events) group by 1""",
    "stream_rerun_noop": "select 1::bigint as batches, count(*) as events_consumed from events",
    "stream_offsets": """
        select event_id, place as stream_offset, case when place < 400 then 0 else 400 end::bigint as stream_offset_start,
               case when place < 400 then 400 else n end::bigint as stream_offset_end
        from (select event_id, row_number() over (order by event_id) - 1 as place, count(*) over () as n from events)""",
    "stream_append": """
        select event_id, event_id % 2 as run_id,
               case when event_id % 2 = 0 then count(*) filter (event_id % 2 = 0) over () else count(*) over () end
                   as stream_offset_end from events""",
    "stream_log_capped": """
        select cast(run as bigint) as run_id, upto - since as events_consumed, since as stream_offset_start,
               upto - since as lines_read
        from (select run, least(since, n) as since, least(upto, n) as upto
              from (values (0, 0::bigint, 300::bigint), (1, 300, 600), (2, 600, 850), (3, 850, 1000000000000)) as r(run, since, upto),
                   (select count(*) as n from events)) where upto > since""",
    "stream_missing_topic": """
        select count(*) as consumed, 1::bigint as runs, 0::int as consumed_early, 0::int as traces from events""",
    "stream_freshness": """
        select 'star' as profile, 'commerce.events' as topic, max(ts) as latest_event_ts,
               count(*) as events_consumed, count(*) as checkpoint from events""",
    "stream_dedup": "select * from silver_events",
    "late_events": """
        select event_date, count(*) as events, count(*) filter (where is_late_event) as late_events
        from silver_events group by event_date""",
}

_CHOICES = {
    "quality_checks_incomplete": {"left_out": "mart_funnel_conversion"},
    "mart_customer_ltv_recent": {"orders_since": "and order_ts >= timestamp '2001-01-01'"},
    "mart_product_performance_recent": {
        "sold_items": """(select * from items where order_id in
            (select order_id from raw_orders where order_ts >= timestamp '2001-07-01'))"""
    },
}

ORACLES: dict[str, str] = {name: _statement(body, **_CHOICES.get(name, {})) for name, body in _BODIES.items()}
