"""The curated table rolled up to one row per order and category, and the reports over it.

The roll-up is made of lines, orders and shipments that are each reduced per order first. The rows that an order's lines
make with its shipments are counted by multiplying, not by joining, so an order of a million lines and a million
shipments costs two million rows. All measures are sums over rows of it, or distinct orders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.functions import dax_divide, delivery_days, line_revenue, safe_divide
from orderlake.operators.skew import DEFAULT_POLICY, SkewPolicy
from orderlake.plans.curated import (
    UNKNOWN,
    Facts,
    join_customers,
    join_products,
    join_warehouses,
    met_heads,
    met_lines,
)
from orderlake.plans.dashboard import ALL, Slicers, apply_slicers

# What a row of the roll-up is told apart by.
GRAIN = [
    "order_id",
    "order_date",
    "order_status",
    "customer_id",
    "customer_segment",
    "warehouse_id",
    "warehouse_city",
    "category",
]


def build_rollup(
    orders: DataFrame,
    items: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    warehouses: DataFrame,
    shipments: DataFrame,
    policy: SkewPolicy = DEFAULT_POLICY,
    facts: Facts = UNKNOWN,
) -> DataFrame:
    """One row per order and category with the sums that its rows of the curated table have.

    ``rows``, ``revenue``, ``days`` and ``deliveries`` (sum and count of delivery days), ``unshipped`` (no shipment of the
    order is known), and rows with a bad revenue or a delivery before its shipment. Zones in buckets are not shuffled.
    """
    inputs = [orders, items, shipments]
    heads = orders.select("order_id", "order_date", "order_status", "customer_id", "warehouse_id")
    heads = join_customers(heads, customers, policy, orders, facts)
    heads = join_warehouses(heads, warehouses, policy, orders, facts).drop("customer_id", "warehouse_id")
    heads = heads.withColumnsRenamed(
        {"known_customer_id": "customer_id", "known_warehouse_id": "warehouse_id"}
    )
    heads = met_heads(heads, customers, warehouses, inputs, policy, facts)
    own = items.select("order_item_id", "order_id", "product_id", line_revenue().alias("revenue"))
    bad = F.col("revenue").isNull() | (F.col("revenue") < 0)
    lines = (
        met_lines(join_products(own, products, policy, facts), products, inputs, policy, facts)
        .groupBy("order_id", "category")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.sum("revenue").alias("line_revenue"),
            F.count_if(bad).alias("bad_lines"),
        )
    )
    early = F.col("delivery_date") < F.col("shipment_date")
    sent = shipments.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("shipments"),
        F.sum(delivery_days()).alias("sent_days"),
        F.count(delivery_days()).alias("sent_deliveries"),
        F.count_if(early).alias("early"),
    )
    times = F.coalesce("shipments", F.lit(1))

    def per_line(column: str) -> Column:
        return F.col(column) * F.col("lines")

    return heads.join(lines, "order_id").join(sent, "order_id", "left").select(
        *GRAIN,
        (times * F.col("lines")).alias("rows"),
        (times * F.col("line_revenue")).alias("revenue"),
        per_line("sent_days").alias("days"),
        F.coalesce(per_line("sent_deliveries"), F.lit(0)).alias("deliveries"),
        F.col("shipments").isNull().alias("unshipped"),
        (times * F.col("bad_lines")).alias("bad_revenue_rows"),
        F.coalesce(per_line("early"), F.lit(0)).alias("bad_delivery_rows"),
    )


def _revenue() -> Column:
    return F.sum("revenue").alias("total_revenue")


def _orders() -> Column:
    return F.countDistinct("order_id").alias("total_orders")


def _mean_days() -> Column:
    return safe_divide(F.sum("days"), F.sum("deliveries"))


def total_revenue(rollup: DataFrame) -> DataFrame:
    return rollup.agg(_revenue())


def total_orders(rollup: DataFrame) -> DataFrame:
    return rollup.agg(_orders())


def revenue_by(rollup: DataFrame, dimension: str) -> DataFrame:
    return rollup.groupBy(dimension).agg(_revenue()).orderBy(F.desc("total_revenue"))


def orders_by_status(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy("order_status").agg(_orders()).orderBy(F.desc("total_orders"))


def avg_delivery_days(rollup: DataFrame) -> DataFrame:
    return rollup.agg(_mean_days().alias("avg_delivery_days"))


def performance_by(rollup: DataFrame, dimension: str) -> DataFrame:
    """Orders, revenue and delivery time per value of ``dimension``."""
    return (
        rollup.groupBy(dimension)
        .agg(
            _orders(),
            F.round(F.sum("revenue"), 2).alias("total_revenue"),
            F.round(_mean_days(), 2).alias("avg_delivery_days"),
        )
        .orderBy(F.desc("total_revenue"))
    )


def per_order(rollup: DataFrame, *dimensions: str) -> DataFrame:
    """One row per order: an order has one customer, place, status and date, and one row per category."""
    return rollup.groupBy("order_id", *dimensions).agg(
        F.sum("revenue").alias("revenue"),
        F.sum("days").alias("days"),
        F.sum("deliveries").alias("deliveries"),
        F.bool_or("unshipped").alias("unshipped"),
    )


def segment_performance(rollup: DataFrame) -> DataFrame:
    """Customers, orders, revenue and revenue per order of each segment.

    Orders are reduced to customers, which keep how many orders they have, so one pass gives both distinct counts.
    """
    customers = (
        per_order(rollup, "customer_segment", "customer_id")
        .groupBy("customer_segment", "customer_id")
        .agg(F.sum("revenue").alias("revenue"), F.count("order_id").alias("orders"))
    )
    value = safe_divide(F.sum("revenue"), F.sum("orders"))
    return (
        customers.groupBy("customer_segment")
        .agg(
            F.count("customer_id").alias("total_customers"),
            F.sum("orders").alias("total_orders"),
            F.round(F.sum("revenue"), 2).alias("total_revenue"),
            F.round(value, 2).alias("avg_order_value"),
        )
        .orderBy(F.desc("total_revenue"))
    )


def shipment_completeness(rollup: DataFrame) -> DataFrame:
    """Orders with and without a shipment per status; the share is in percent."""
    counted = (
        per_order(rollup, "order_status")
        .groupBy("order_status")
        .agg(
            F.count("order_id").alias("total_orders"),
            F.count_if("unshipped").alias("orders_missing_shipment"),
            F.round(_mean_days(), 2).alias("avg_delivery_days"),
        )
    )
    percent = safe_divide(F.lit(100.0) * F.col("orders_missing_shipment"), F.col("total_orders"))
    return counted.select(
        "order_status",
        "total_orders",
        "orders_missing_shipment",
        F.round(percent, 2).alias("missing_shipment_pct"),
        "avg_delivery_days",
    ).orderBy(F.desc("total_orders"))


def revenue_by_month_name(rollup: DataFrame) -> DataFrame:
    """Revenue per calendar month, all years together, January first."""
    month = F.month("order_date").alias("month")
    named = rollup.groupBy(month, F.date_format("order_date", "MMMM").alias("month_name"))
    return named.agg(_revenue()).orderBy("month").drop("month")


def kpi_cards(rollup: DataFrame, slicers: Slicers = ALL) -> DataFrame:
    """All six cards in one row, with the slicers of the dashboard."""
    totals = per_order(apply_slicers(rollup, slicers)).agg(
        F.sum("revenue").alias("total_revenue"),
        F.count(F.lit(1)).alias("total_orders"),
        _mean_days().alias("avg_delivery_days"),
        F.count_if("unshipped").alias("orders_missing_shipment"),
    )
    orders = F.col("total_orders")
    return totals.select(
        "total_revenue",
        "total_orders",
        dax_divide(F.col("total_revenue"), orders).alias("avg_order_value"),
        "avg_delivery_days",
        "orders_missing_shipment",
        dax_divide(F.col("orders_missing_shipment"), orders).alias("missing_shipment_ratio"),
    )


def dq_summary(rollup: DataFrame) -> DataFrame:
    """The row-level checks of the curated table, from sums."""

    def rows(condition: Column, column: str = "rows") -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(column))), F.lit(0))

    every = F.lit(True)
    return rollup.agg(
        rows(every).alias("total_rows"),
        rows(F.col("unshipped")).alias("missing_shipment_rows"),
        rows(F.col("customer_id").isNull()).alias("null_customer_ids"),
        rows(every, "bad_revenue_rows").alias("invalid_revenue_rows"),
        rows(every, "bad_delivery_rows").alias("invalid_delivery_dates"),
    )


def affected_orders(rollup: DataFrame) -> DataFrame:
    """Rows and distinct orders without a shipment, per status."""
    return (
        rollup.where("unshipped")
        .groupBy("order_status")
        .agg(F.sum("rows").alias("affected_rows"), F.countDistinct("order_id").alias("affected_orders"))
        .orderBy(F.desc("affected_orders"))
    )


def duplicate_orders(rollup: DataFrame) -> DataFrame:
    """Orders on several rows of the curated table."""
    return (
        rollup.groupBy("order_id")
        .agg(F.sum("rows").alias("row_count"))
        .where("row_count > 1")
        .orderBy(F.desc("row_count"), "order_id")
    )
