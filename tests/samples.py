"""One row per table that breaks no rule, and helpers to build tables from variations of it."""

from orderlake.schemas import RAW

GOOD = {
    "customers": dict(
        customer_id="C1", customer_name="Ada", city="Oslo", state="tx", customer_segment="Consumer"
    ),
    "products": dict(
        product_id="P1",
        product_name="Lamp",
        category="Home",
        supplier_id="S1",
        unit_cost=2.0,
        unit_price=3.5,
    ),
    "suppliers": dict(
        supplier_id="S1", supplier_name="Acme", country="Norway", supplier_rating=4.5
    ),
    "warehouses": dict(
        warehouse_id="W1", warehouse_name="North", city="Bergen", capacity_units=100
    ),
    "inventory": dict(
        inventory_id="I1",
        warehouse_id="W1",
        product_id="P1",
        inventory_date="2024-01-15",
        quantity_on_hand=7,
        reorder_level=3,
    ),
    "orders": dict(
        order_id="O1",
        customer_id="C1",
        warehouse_id="W1",
        order_date="2024-02-01",
        order_status="Delivered",
    ),
    "order_items": dict(
        order_item_id="L1", order_id="O1", product_id="P1", quantity=2, unit_price=3.5
    ),
    "shipments": dict(
        shipment_id="H1",
        order_id="O1",
        warehouse_id="W1",
        carrier="Fast",
        shipment_date="2024-02-02",
        delivery_date="2024-02-05",
        shipment_status="Delivered",
    ),
}


def table(spark, name, *changes):
    """One row per change: the good row with the change applied."""
    schema = RAW[name]
    data = [tuple((GOOD[name] | change)[f.name] for f in schema) for change in changes]
    return spark.createDataFrame(data, schema)
