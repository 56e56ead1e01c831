"""The 54 quality rules, table by table. Their order is the order of the output."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderlake.functions import parsed_name
from orderlake.operators.duplicates import COUNT
from orderlake.operators.quality import Rule, TableSpec
from orderlake.schemas import RAW


def missing(column: str, reason: str | None = None) -> Rule:
    return Rule(reason or f"MISSING_{column.upper()}", lambda: F.col(column).isNull())


def below_zero(column: str, reason: str | None = None) -> Rule:
    return Rule(reason or f"NEGATIVE_{column.upper()}", lambda: F.col(column) < 0)


def not_positive(column: str, reason: str) -> Rule:
    return Rule(reason, lambda: F.col(column) <= 0)


def above(column: str, limit: float, reason: str) -> Rule:
    return Rule(reason, lambda: F.col(column) > limit)


def unparsable(column: str) -> Rule:
    """Text is there but is no date. Blank text is not this rule's business."""
    return Rule(
        f"INVALID_{column.upper()}",
        lambda: F.col(column).isNotNull() & F.col(parsed_name(column)).isNull(),
    )


def not_a_date(column: str) -> Rule:
    """Blank or unparsable, under one reason."""
    return Rule(f"INVALID_{column.upper()}", lambda: F.col(parsed_name(column)).isNull())


def before(later: str, earlier: str, reason: str) -> Rule:
    """NULL, hence not broken, unless both dates are known."""
    return Rule(reason, lambda: F.col(parsed_name(later)) < F.col(parsed_name(earlier)))


def duplicated(key: str) -> Rule:
    """Condemns every copy. Rows without a key are only missing it."""
    return Rule(
        f"DUPLICATE_{key.upper()}", lambda: F.col(key).isNotNull() & (F.col(COUNT) > 1)
    )


def _spec(name: str, key: str, *rules: Rule, dates=(), upper=()) -> TableSpec:
    return TableSpec(name, key, RAW[name], rules, tuple(dates), tuple(upper))


SPECS: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        _spec(
            "customers",
            "customer_id",
            missing("customer_id"),
            missing("customer_name"),
            duplicated("customer_id"),
            upper=["state"],
        ),
        _spec(
            "products",
            "product_id",
            missing("product_id"),
            missing("product_name"),
            missing("supplier_id"),
            missing("unit_cost"),
            below_zero("unit_cost"),
            missing("unit_price"),
            below_zero("unit_price"),
            duplicated("product_id"),
        ),
        _spec(
            "suppliers",
            "supplier_id",
            missing("supplier_id"),
            missing("supplier_name"),
            missing("supplier_rating"),
            below_zero("supplier_rating", "SUPPLIER_RATING_BELOW_ZERO"),
            above("supplier_rating", 5, "SUPPLIER_RATING_ABOVE_FIVE"),
            duplicated("supplier_id"),
        ),
        _spec(
            "warehouses",
            "warehouse_id",
            missing("warehouse_id"),
            missing("warehouse_name"),
            missing("capacity_units", "MISSING_CAPACITY"),
            not_positive("capacity_units", "INVALID_CAPACITY"),
            duplicated("warehouse_id"),
        ),
        _spec(
            "inventory",
            "inventory_id",
            missing("inventory_id"),
            missing("warehouse_id"),
            missing("product_id"),
            missing("quantity_on_hand"),
            below_zero("quantity_on_hand"),
            missing("reorder_level"),
            below_zero("reorder_level"),
            not_a_date("inventory_date"),
            duplicated("inventory_id"),
            dates=["inventory_date"],
        ),
        _spec(
            "orders",
            "order_id",
            missing("order_id"),
            missing("customer_id"),
            missing("warehouse_id"),
            missing("order_status"),
            missing("order_date"),
            unparsable("order_date"),
            duplicated("order_id"),
            dates=["order_date"],
        ),
        _spec(
            "order_items",
            "order_item_id",
            missing("order_item_id"),
            missing("order_id"),
            missing("product_id"),
            missing("quantity"),
            not_positive("quantity", "INVALID_QUANTITY"),
            missing("unit_price"),
            below_zero("unit_price"),
            duplicated("order_item_id"),
        ),
        _spec(
            "shipments",
            "shipment_id",
            missing("shipment_id"),
            missing("order_id"),
            missing("warehouse_id"),
            missing("shipment_date"),
            unparsable("shipment_date"),
            unparsable("delivery_date"),
            before("delivery_date", "shipment_date", "DELIVERY_BEFORE_SHIPMENT"),
            duplicated("shipment_id"),
            dates=["shipment_date", "delivery_date"],
        ),
    )
}
