"""Column names and types of the raw tables and of the curated table."""

from __future__ import annotations

from pyspark.sql import types as T


def _table(text: str, **numbers: T.DataType) -> T.StructType:
    fields = [T.StructField(name, T.StringType()) for name in text.split()]
    fields += [T.StructField(name, kind) for name, kind in numbers.items()]
    return T.StructType(fields)


# Dates stay text in the raw zone: an unparsable date must reach the rules.
RAW = {
    "customers": _table("customer_id customer_name city state customer_segment"),
    "products": _table(
        "product_id product_name category supplier_id",
        unit_cost=T.DoubleType(),
        unit_price=T.DoubleType(),
    ),
    "suppliers": _table("supplier_id supplier_name country", supplier_rating=T.DoubleType()),
    "warehouses": _table("warehouse_id warehouse_name city", capacity_units=T.LongType()),
    "inventory": _table(
        "inventory_id warehouse_id product_id inventory_date",
        quantity_on_hand=T.LongType(),
        reorder_level=T.LongType(),
    ),
    "orders": _table("order_id customer_id warehouse_id order_date order_status"),
    "order_items": _table(
        "order_item_id order_id product_id",
        quantity=T.LongType(),
        unit_price=T.DoubleType(),
    ),
    "shipments": _table(
        "shipment_id order_id warehouse_id carrier shipment_date delivery_date shipment_status"
    ),
}

TABLES = tuple(RAW)

# The tables that feed the curated join; suppliers and inventory are cleaned only.
CURATED_INPUTS = ("orders", "order_items", "customers", "products", "warehouses", "shipments")

# Fixed output order of the curated table, without its clock column.
ORDER_ANALYTICS = T.StructType(
    [
        T.StructField(name, kind)
        for kind, names in (
            (T.StringType(), "order_id"),
            (T.DateType(), "order_date"),
            (
                T.StringType(),
                "order_status customer_id customer_name customer_segment "
                "warehouse_id warehouse_name warehouse_city "
                "product_id product_name category supplier_id",
            ),
            (T.LongType(), "quantity"),
            (T.DoubleType(), "unit_price line_revenue"),
            (T.StringType(), "shipment_id carrier"),
            (T.DateType(), "shipment_date delivery_date"),
            (T.StringType(), "shipment_status"),
            (T.IntegerType(), "delivery_days"),
        )
        for name in names.split()
    ]
)
ORDER_ANALYTICS_COLUMNS = ORDER_ANALYTICS.fieldNames()
