"""The expected results as DuckDB SQL over the driver tables.

Every statement carries the chain it needs as CTEs: raw, cleaned and judged
tables, then the curated table. The conditions are written out here a second
time on purpose, so that they check the library's.
Dates are compared as ISO text.
"""

from __future__ import annotations

import re

from orderlake.fixtures import RAW_SQL

DRIVER_TABLES = "region nation customer supplier part orders lineitem".split()

TEXT = {
    "customers": "customer_id customer_name city state customer_segment",
    "products": "product_id product_name category supplier_id",
    "suppliers": "supplier_id supplier_name country",
    "warehouses": "warehouse_id warehouse_name city",
    "inventory": "inventory_id warehouse_id product_id inventory_date",
    "orders": "order_id customer_id warehouse_id order_date order_status",
    "order_items": "order_item_id order_id product_id",
    "shipments": "shipment_id order_id warehouse_id carrier shipment_date delivery_date "
    "shipment_status",
}
NUMBERS = {
    "products": "unit_cost unit_price",
    "suppliers": "supplier_rating",
    "warehouses": "capacity_units",
    "inventory": "quantity_on_hand reorder_level",
    "order_items": "quantity unit_price",
}
DATES = {
    "inventory": ["inventory_date"],
    "orders": ["order_date"],
    "shipments": ["shipment_date", "delivery_date"],
}

# reason: condition, in output order. "copies" is the number of rows with the key.
RULES = {
    "customers": {
        "MISSING_CUSTOMER_ID": "customer_id is null",
        "MISSING_CUSTOMER_NAME": "customer_name is null",
        "DUPLICATE_CUSTOMER_ID": "customer_id is not null and copies > 1",
    },
    "products": {
        "MISSING_PRODUCT_ID": "product_id is null",
        "MISSING_PRODUCT_NAME": "product_name is null",
        "MISSING_SUPPLIER_ID": "supplier_id is null",
        "MISSING_UNIT_COST": "unit_cost is null",
        "NEGATIVE_UNIT_COST": "unit_cost < 0",
        "MISSING_UNIT_PRICE": "unit_price is null",
        "NEGATIVE_UNIT_PRICE": "unit_price < 0",
        "DUPLICATE_PRODUCT_ID": "product_id is not null and copies > 1",
    },
    "suppliers": {
        "MISSING_SUPPLIER_ID": "supplier_id is null",
        "MISSING_SUPPLIER_NAME": "supplier_name is null",
        "MISSING_SUPPLIER_RATING": "supplier_rating is null",
        "SUPPLIER_RATING_BELOW_ZERO": "supplier_rating < 0",
        "SUPPLIER_RATING_ABOVE_FIVE": "supplier_rating > 5",
        "DUPLICATE_SUPPLIER_ID": "supplier_id is not null and copies > 1",
    },
    "warehouses": {
        "MISSING_WAREHOUSE_ID": "warehouse_id is null",
        "MISSING_WAREHOUSE_NAME": "warehouse_name is null",
        "MISSING_CAPACITY": "capacity_units is null",
        "INVALID_CAPACITY": "capacity_units <= 0",
        "DUPLICATE_WAREHOUSE_ID": "warehouse_id is not null and copies > 1",
    },
    "inventory": {
        "MISSING_INVENTORY_ID": "inventory_id is null",
        "MISSING_WAREHOUSE_ID": "warehouse_id is null",
        "MISSING_PRODUCT_ID": "product_id is null",
        "MISSING_QUANTITY_ON_HAND": "quantity_on_hand is null",
        "NEGATIVE_QUANTITY_ON_HAND": "quantity_on_hand < 0",
        "MISSING_REORDER_LEVEL": "reorder_level is null",
        "NEGATIVE_REORDER_LEVEL": "reorder_level < 0",
        "INVALID_INVENTORY_DATE": "inventory_date_d is null",
        "DUPLICATE_INVENTORY_ID": "inventory_id is not null and copies > 1",
    },
    "orders": {
        "MISSING_ORDER_ID": "order_id is null",
        "MISSING_CUSTOMER_ID": "customer_id is null",
        "MISSING_WAREHOUSE_ID": "warehouse_id is null",
        "MISSING_ORDER_STATUS": "order_status is null",
        "MISSING_ORDER_DATE": "order_date is null",
        "INVALID_ORDER_DATE": "order_date is not null and order_date_d is null",
        "DUPLICATE_ORDER_ID": "order_id is not null and copies > 1",
    },
    "order_items": {
        "MISSING_ORDER_ITEM_ID": "order_item_id is null",
        "MISSING_ORDER_ID": "order_id is null",
        "MISSING_PRODUCT_ID": "product_id is null",
        "MISSING_QUANTITY": "quantity is null",
        "INVALID_QUANTITY": "quantity <= 0",
        "MISSING_UNIT_PRICE": "unit_price is null",
        "NEGATIVE_UNIT_PRICE": "unit_price < 0",
        "DUPLICATE_ORDER_ITEM_ID": "order_item_id is not null and copies > 1",
    },
    "shipments": {
        "MISSING_SHIPMENT_ID": "shipment_id is null",
        "MISSING_ORDER_ID": "order_id is null",
        "MISSING_WAREHOUSE_ID": "warehouse_id is null",
        "MISSING_SHIPMENT_DATE": "shipment_date is null",
        "INVALID_SHIPMENT_DATE": "shipment_date is not null and shipment_date_d is null",
        "INVALID_DELIVERY_DATE": "delivery_date is not null and delivery_date_d is null",
        "DELIVERY_BEFORE_SHIPMENT": "delivery_date_d < shipment_date_d",
        "DUPLICATE_SHIPMENT_ID": "shipment_id is not null and copies > 1",
    },
}
TABLES = list(RULES)


def _columns(table: str) -> list[str]:
    return TEXT[table].split() + NUMBERS.get(table, "").split()


def _normal(table: str) -> str:
    clean = [f"nullif(trim({c}), '') as {c}" for c in TEXT[table].split()]
    return f"select {', '.join(clean + NUMBERS.get(table, '').split())} from raw_{table}"


def _parsed(table: str) -> str:
    shape = "regexp_full_match({0}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')"
    parse = "case when " + shape + " then cast(try_strptime({0}, '%Y-%m-%d') as date) end {0}_d"
    extra = "".join(", " + parse.format(c) for c in DATES.get(table, ()))
    return f"select *{extra} from normal_{table}"


def _judged(table: str) -> str:
    key = TEXT[table].split()[0]
    cases = ", ".join(f"case when {c} then '{r}' end" for r, c in RULES[table].items())
    counted = f"select *, count(*) over (partition by {key}) as copies from parsed_{table}"
    return f"select *, concat_ws('; ', {cases}) as rejection_reason from ({counted})"


def _processed(table: str) -> str:
    dates = DATES.get(table, ())
    shown = [f"{c}_d as {c}" if c in dates else c for c in _columns(table)]
    shown = ["upper(state) as state" if c == "state" else c for c in shown]
    return f"select {', '.join(shown)} from judged_{table} where rejection_reason = ''"


def _rejected(table: str) -> str:
    shown = ", ".join(_columns(table))
    return f"select {shown}, rejection_reason from judged_{table} where rejection_reason <> ''"


def _ctes() -> dict[str, str]:
    names = {name: name for name in DRIVER_TABLES}
    chain = {}
    for table in TABLES:
        chain[f"raw_{table}"] = RAW_SQL[table].format(**names)
        chain[f"normal_{table}"] = _normal(table)
        chain[f"parsed_{table}"] = _parsed(table)
        chain[f"judged_{table}"] = _judged(table)
        chain[f"processed_{table}"] = _processed(table)
        chain[f"rejected_{table}"] = _rejected(table)
    chain["oa"] = """
        select o.order_id, o.order_date, o.order_status,
               c.customer_id, c.customer_name, c.customer_segment,
               w.warehouse_id, w.warehouse_name, w.city as warehouse_city,
               p.product_id, p.product_name, p.category, p.supplier_id,
               i.quantity, i.unit_price, round(i.quantity * i.unit_price, 2) as line_revenue,
               s.shipment_id, s.carrier, s.shipment_date, s.delivery_date, s.shipment_status,
               cast(date_diff('day', s.shipment_date, s.delivery_date) as int) as delivery_days
        from processed_order_items i
        join processed_orders o using (order_id)
        left join processed_customers c on c.customer_id = o.customer_id
        left join processed_warehouses w on w.warehouse_id = o.warehouse_id
        left join processed_products p on p.product_id = i.product_id
        left join processed_shipments s on s.order_id = o.order_id"""
    return chain


def _with(ctes: dict[str, str], query: str) -> str:
    """``query`` after the CTEs it uses, directly or through others."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in re.findall(r"\w+", text):
            if name in ctes and name not in needed:
                needed.add(name)
                visit(ctes[name])

    visit(query)
    parts = ", ".join(f"{name} as ({text})" for name, text in ctes.items() if name in needed)
    return f"with {parts} {query}"


def _as_text(columns: list[str], dates: list[str]) -> str:
    return ", ".join(f"cast({c} as varchar) as {c}" if c in dates else c for c in columns)


def _revenue_by(dimension: str) -> str:
    return f"""select {dimension}, round(sum(line_revenue), 2) as total_revenue
               from oa group by {dimension}"""


def _performance_by(dimension: str) -> str:
    return f"""select {dimension}, count(distinct order_id) as total_orders,
                      round(sum(line_revenue), 2) as total_revenue,
                      round(avg(delivery_days), 2) as avg_delivery_days
               from oa group by {dimension}"""


def _kpis(where: str = "true") -> str:
    return f"""
        select round(revenue, 2) as total_revenue, orders as total_orders,
               case when orders = 0 then 0 else round(revenue / orders, 2) end as avg_order_value,
               round(days, 6) as avg_delivery_days, missing as orders_missing_shipment,
               case when orders = 0 then 0 else round(missing / orders, 6) end
                   as missing_shipment_ratio
        from (select sum(line_revenue) as revenue, count(distinct order_id) as orders,
                     avg(delivery_days) as days,
                     count(distinct order_id) filter (where shipment_id is null) as missing
              from oa where {where})"""


CURATED = """order_id order_date order_status customer_id customer_name customer_segment
    warehouse_id warehouse_name warehouse_city product_id product_name category supplier_id
    quantity unit_price line_revenue shipment_id carrier shipment_date delivery_date
    shipment_status delivery_days""".split()
CURATED_DATES = ["order_date", "shipment_date", "delivery_date"]
_WIDE = f"select {_as_text(CURATED, CURATED_DATES)} from oa"

SLICED = """warehouse_city in ('NATION_1', 'NATION_7', 'NATION_12') and
    order_status in ('Delivered', 'Shipped') and category in ('ECONOMY', 'PROMO', 'LARGE') and
    order_date between date '1996-01-01' and date '1999-12-31'"""

_REPORTS = {
    "total_revenue": "select round(sum(line_revenue), 2) as total_revenue from oa",
    "total_orders": "select count(distinct order_id) as total_orders from oa",
    "revenue_by_category": _revenue_by("category"),
    "revenue_by_warehouse": _revenue_by("warehouse_city"),
    "revenue_by_segment": _revenue_by("customer_segment"),
    "orders_by_status": """select order_status, count(distinct order_id) as total_orders
                           from oa group by order_status""",
    "avg_delivery_days": "select round(avg(delivery_days), 6) as avg_delivery_days from oa",
    "category_performance": _performance_by("category"),
    "warehouse_performance": _performance_by("warehouse_city"),
    "segment_performance": """
        select customer_segment, count(distinct customer_id) as total_customers,
               count(distinct order_id) as total_orders,
               round(sum(line_revenue), 2) as total_revenue,
               round(sum(line_revenue) / count(distinct order_id), 2) as avg_order_value
        from oa group by customer_segment""",
    "shipment_completeness": """
        select order_status, orders as total_orders, missing as orders_missing_shipment,
               round(100e0 * missing / orders, 2) as missing_shipment_pct, avg_delivery_days
        from (select order_status, count(distinct order_id) as orders,
                     count(distinct order_id) filter (where shipment_id is null) as missing,
                     round(avg(delivery_days), 2) as avg_delivery_days
              from oa group by order_status)""",
    "revenue_by_month_name": """
        select monthname(order_date) as month_name, round(sum(line_revenue), 2) as total_revenue
        from oa group by monthname(order_date)""",
    "revenue_month_over_month": """
        select cast(month as varchar) as month, round(total, 2) as total_revenue,
               round(before, 2) as previous_revenue, round(total - before, 2) as revenue_change
        from (select month, total,
                     case when lag(month) over (order by month) + interval 1 month = month
                          then lag(total) over (order by month) end as before
              from (select cast(date_trunc('month', order_date) as date) as month,
                           sum(line_revenue) as total from oa group by 1))""",
    "kpi_cards": _kpis(),
    "kpi_cards_sliced": _kpis(SLICED),
    "category_sliced": _performance_by("category").replace("from oa", f"from oa where {SLICED}"),
}
_REPORTS |= {
    f"{name}_sliced": _REPORTS[report].replace("from oa", f"from oa where {SLICED}")
    for name, report in {
        "month": "revenue_by_month_name",
        "status": "orders_by_status",
        "segment": "revenue_by_segment",
    }.items()
}
_REPORTS["preview"] = f"""{_WIDE}
    order by {', '.join(f'{c} nulls first' for c in CURATED)} limit 10"""

_CHECKS = {
    "dq_total_rows": "select count(*) as total_rows from oa",
    "dq_missing_shipment_rows": """
        select count(*) as missing_shipment_rows from oa where shipment_id is null""",
    "dq_missing_shipment_by_status": """
        select order_status, count(*) as missing_shipment_rows from oa
        where shipment_id is null group by order_status""",
    "dq_affected_orders": """
        select order_status, count(*) as affected_rows,
               count(distinct order_id) as affected_orders
        from oa where shipment_id is null group by order_status""",
    "dq_delivered_coverage": """
        select count(*) as delivered_orders,
               count(*) filter (where shipped) as delivered_orders_with_shipment,
               count(*) filter (where not shipped) as delivered_orders_without_shipment
        from (select distinct order_id,
                     order_id in (select order_id from processed_shipments) as shipped
              from processed_orders where order_status = 'Delivered')""",
    "dq_raw_vs_processed": """
        select count(distinct order_id) filter (where zone = 'raw') as raw_shipment_orders,
               count(distinct order_id) filter (where zone = 'done')
                   as processed_shipment_orders
        from (select order_id, 'raw' as zone from raw_shipments
              union all select order_id, 'done' from processed_shipments)""",
    "dq_delivered_missing_raw": """
        select count(distinct order_id) as delivered_orders_missing_raw_shipment
        from raw_orders o
        where trim(order_status) = 'Delivered' and not exists (
            select 1 from raw_shipments s where trim(s.order_id) = trim(o.order_id))""",
    "dq_duplicate_orders": """
        select order_id, count(*) as row_count from oa group by order_id having count(*) > 1""",
    "dq_null_customers": """
        select count(*) as null_customer_ids from oa where customer_id is null""",
    "dq_invalid_revenue": """
        select count(*) as invalid_revenue_rows from oa
        where line_revenue is null or line_revenue < 0""",
    "dq_invalid_delivery": """
        select count(*) as invalid_delivery_dates from oa where delivery_date < shipment_date""",
    "dq_summary": """
        select count(*) as total_rows,
               count(*) filter (where shipment_id is null) as missing_shipment_rows,
               count(*) filter (where customer_id is null) as null_customer_ids,
               count(*) filter (where line_revenue is null or line_revenue < 0)
                   as invalid_revenue_rows,
               count(*) filter (where delivery_date < shipment_date) as invalid_delivery_dates
        from oa""",
    "dq_reconcile_zones": " union all ".join(
        f"""select '{t}' as table_name, (select count(*) from raw_{t}) as raw_rows,
                   (select count(*) from processed_{t}) as processed_rows,
                   (select count(*) from rejected_{t}) as rejected_rows, true as reconciled"""
        for t in TABLES
    ),
}

_JOINS = {
    "join_orders_items": """
        select o.order_id, cast(o.order_date as varchar) as order_date, o.order_status,
               i.order_item_id, i.product_id, i.quantity, i.unit_price
        from processed_orders o join processed_order_items i on i.order_id = o.order_id""",
    "join_customers": """
        select o.order_id, o.customer_id, c.customer_id as known_customer_id,
               c.customer_name, c.customer_segment
        from processed_orders o left join processed_customers c using (customer_id)""",
    "join_products": """
        select i.order_item_id, i.product_id, p.product_id as known_product_id,
               p.product_name, p.category, p.supplier_id
        from processed_order_items i left join processed_products p using (product_id)""",
    "join_warehouses": """
        select o.order_id, o.warehouse_id, w.warehouse_id as known_warehouse_id,
               w.warehouse_name, w.city as warehouse_city
        from processed_orders o left join processed_warehouses w using (warehouse_id)""",
    "join_shipments": """
        select i.order_id, i.order_item_id, s.shipment_id, s.carrier,
               cast(s.shipment_date as varchar) as shipment_date,
               cast(s.delivery_date as varchar) as delivery_date, s.shipment_status
        from processed_order_items i left join processed_shipments s using (order_id)""",
    "order_analytics": _WIDE,
}


def _per_table() -> dict[str, str]:
    queries = {}
    for t in TABLES:
        dates = DATES.get(t, [])
        queries[f"raw_{t}"] = f"select {', '.join(_columns(t))} from raw_{t}"
        queries[f"normalize_{t}"] = f"select {', '.join(_columns(t))} from normal_{t}"
        queries[f"duplicate_count_{t}"] = (
            f"select {', '.join(_columns(t))}, copies as duplicate_count from judged_{t}"
        )
        queries[f"processed_{t}"] = f"select {_as_text(_columns(t), dates)} from processed_{t}"
        queries[f"rejected_{t}"] = (
            f"select {', '.join(_columns(t))}, rejection_reason from rejected_{t}"
        )
        for zone in ("processed", "rejected"):
            queries[f"zone_{zone}_{t}"] = queries[f"{zone}_{t}"]
        # CSV does not tell empty text from none.
        known = TEXT[t].split()
        columns = (f"nullif({c}, '') as {c}" if c in known else c for c in _columns(t))
        queries[f"csv_{t}"] = f"select {', '.join(columns)} from raw_{t}"
        queries[f"reject_summary_{t}"] = f"""
            select rejection_reason, count(*) as rejected_rows from rejected_{t}
            group by rejection_reason"""
    return queries


def statements() -> dict[str, str]:
    ctes = _ctes()
    queries = _per_table() | _JOINS | _REPORTS | _CHECKS
    queries["parse_dates"] = " union all ".join(
        f"""select '{t}.{c}' as source, {t[:-1] if t.endswith('s') else t}_id as id, {c} as text,
                   cast({c}_d as varchar) as parsed from parsed_{t}"""
        for t, dates in DATES.items()
        for c in dates
    )
    queries["safe_division"] = """
        select inventory_id, reorder_level / nullif(quantity_on_hand, 0) as sql_ratio,
               coalesce(reorder_level / nullif(quantity_on_hand, 0), 0) as dax_ratio
        from normal_inventory"""
    for name in SPREAD:
        queries[f"{name}_spread"] = queries[name]
    queries["order_analytics_searched"] = queries["order_analytics"]
    for name in ROLLED:
        queries[f"rollup_{name}"] = queries[name]
    return {name: _with(ctes, text) for name, text in queries.items()}


# Operators registered a second time with their handling of hot keys forced on.
SPREAD = (
    [f"duplicate_count_{t}" for t in ("orders", "order_items", "shipments")]
    + "join_orders_items join_customers join_products join_warehouses join_shipments".split()
    + ["order_analytics"]
)

# Reports over the curated table that its roll-up must answer alike.
ROLLED = """
    total_revenue total_orders revenue_by_category revenue_by_warehouse revenue_by_segment
    orders_by_status avg_delivery_days category_performance warehouse_performance
    segment_performance shipment_completeness revenue_by_month_name revenue_month_over_month
    kpi_cards kpi_cards_sliced dq_summary dq_affected_orders dq_duplicate_orders
""".split()
