import datetime as dt

import pytest
from conftest import rows
from samples import table

from orderlake.operators.quality import split
from orderlake.operators.rules import SPECS
from orderlake.operators.skew import SkewPolicy
from orderlake.plans.curated import build_order_analytics
from orderlake.schemas import CURATED_INPUTS, ORDER_ANALYTICS_COLUMNS

CHANGES = {
    "orders": [
        {},
        dict(order_id="O2", customer_id="nobody", warehouse_id="W9", order_status="Shipped"),
        dict(order_id="O3"),
    ],
    "order_items": [
        {},
        dict(order_item_id="L2", product_id="P9", quantity=3),
        dict(order_item_id="L3", order_id="O2"),
        dict(order_item_id="L4", order_id="unknown"),
    ],
    "customers": [{}],
    "products": [dict(unit_price=99.0)],
    "warehouses": [{}],
    # Two shipments of O1; the second went from another warehouse and is on its way.
    "shipments": [{}, dict(shipment_id="H2", warehouse_id="W9", delivery_date="")],
}


@pytest.fixture(scope="module")
def inputs(spark):
    return [split(table(spark, t, *CHANGES[t]), SPECS[t])[0] for t in CURATED_INPUTS]


POLICIES = {
    "plain": SkewPolicy(),
    "searched": SkewPolicy(lookup_bytes=-1),
    "spread": SkewPolicy(rows_per_slot=1, keys_per_partition=10**6, lookup_bytes=-1),
}


@pytest.fixture(scope="module", params=POLICIES)
def oa(request, inputs):
    return build_order_analytics(*inputs, policy=POLICIES[request.param]).cache()


def test_columns(oa):
    assert oa.columns == [*ORDER_ANALYTICS_COLUMNS, "curated_timestamp"]
    assert len(oa.columns) == 23
    kinds = dict(oa.dtypes)
    assert kinds["order_date"] == kinds["shipment_date"] == kinds["delivery_date"] == "date"
    assert kinds["delivery_days"] == "int"
    assert kinds["curated_timestamp"] == "timestamp"
    assert oa.where("curated_timestamp is null").count() == 0


def test_lines_repeat_per_shipment(oa):
    assert rows(oa, "order_id", "shipment_id", "quantity") == [
        ("O1", "H1", 2),
        ("O1", "H1", 3),
        ("O1", "H2", 2),
        ("O1", "H2", 3),
        ("O2", None, 2),
    ]


def test_unknown_keys_are_null(oa):
    assert rows(oa.where("order_id = 'O2'"), "customer_id", "customer_name", "warehouse_id",
                "warehouse_city", "product_id") == [(None, None, None, None, "P1")]
    unknown = oa.where("quantity = 3 and shipment_id = 'H1'")
    assert rows(unknown, "product_id", "category", "supplier_id", "warehouse_city") == [
        (None, None, None, "Bergen")
    ]


def test_derived_values(oa):
    # The price is the line's, not the product's.
    assert rows(oa.where("order_id = 'O1' and quantity = 2"), "unit_price", "line_revenue",
                "shipment_id", "delivery_days", "delivery_date") == [
        (3.5, 7.0, "H1", 3, dt.date(2024, 2, 5)),
        (3.5, 7.0, "H2", None, None),
    ]
