"""Reports over the curated order-line table.

Orders are counted distinctly because a line and a shipment each repeat their
order. Reports that need more than one distinct count, or a count of orders
with some property, first reduce the table to one row per group and order:
that row count is far smaller, and the reduction combines on the map side, so
a hot group or order is already small when it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlake.functions import safe_divide

PREVIEW_ROWS = 10


def _revenue():
    return F.sum("line_revenue").alias("total_revenue")


def _orders():
    return F.countDistinct("order_id").alias("total_orders")


def preview(oa: DataFrame, rows: int = PREVIEW_ROWS) -> DataFrame:
    """Some rows, whichever come first; no order is promised."""
    return oa.limit(rows)


def total_revenue(oa: DataFrame) -> DataFrame:
    return oa.agg(_revenue())


def total_orders(oa: DataFrame) -> DataFrame:
    return oa.agg(_orders())


def revenue_by(oa: DataFrame, dimension: str) -> DataFrame:
    return oa.groupBy(dimension).agg(_revenue()).orderBy(F.desc("total_revenue"))


def revenue_by_category(oa: DataFrame) -> DataFrame:
    return revenue_by(oa, "category")


def revenue_by_warehouse(oa: DataFrame) -> DataFrame:
    return revenue_by(oa, "warehouse_city")


def revenue_by_segment(oa: DataFrame) -> DataFrame:
    return revenue_by(oa, "customer_segment")


def orders_by_status(oa: DataFrame) -> DataFrame:
    return oa.groupBy("order_status").agg(_orders()).orderBy(F.desc("total_orders"))


def avg_delivery_days(oa: DataFrame) -> DataFrame:
    """Mean over the rows that were delivered; weighted by lines, not by shipments."""
    return oa.where(F.col("delivery_days").isNotNull()).agg(
        F.avg("delivery_days").alias("avg_delivery_days")
    )


def performance_by(oa: DataFrame, dimension: str) -> DataFrame:
    """Orders, revenue and delivery time per value of ``dimension``."""
    return (
        oa.groupBy(dimension)
        .agg(
            _orders(),
            F.round(F.sum("line_revenue"), 2).alias("total_revenue"),
            F.round(F.avg("delivery_days"), 2).alias("avg_delivery_days"),
        )
        .orderBy(F.desc("total_revenue"))
    )


def category_performance(oa: DataFrame) -> DataFrame:
    return performance_by(oa, "category")


def warehouse_performance(oa: DataFrame) -> DataFrame:
    return performance_by(oa, "warehouse_city")


def segment_performance(oa: DataFrame) -> DataFrame:
    """Customers, orders, revenue and revenue per order of each segment.

    One scan: the table is reduced to orders, which name their customers, and those to customers. An order counts with the first
    customer it names, so it counts once, and without any where it names none.
    """
    per_order = oa.groupBy("customer_segment", "order_id").agg(
        F.sum("line_revenue").alias("revenue"), F.collect_set("customer_id").alias("customers")
    )
    named = per_order.select(
        "customer_segment", "order_id", "revenue", F.posexplode_outer("customers").alias("nth", "customer_id")
    )
    first = F.coalesce("nth", F.lit(0)) == 0
    customers = named.groupBy("customer_segment", "customer_id").agg(
        F.sum(F.when(first, F.col("revenue"))).alias("revenue"),
        F.count(F.when(first, F.col("order_id"))).alias("orders"),
    )
    totals = customers.groupBy("customer_segment").agg(
        F.count("customer_id").alias("total_customers"),
        F.sum("orders").alias("total_orders"),
        F.sum("revenue").alias("revenue"),
    )
    per_order_value = safe_divide(F.col("revenue"), F.col("total_orders"))
    return totals.select(
        "customer_segment",
        "total_customers",
        "total_orders",
        F.round("revenue", 2).alias("total_revenue"),
        F.round(per_order_value, 2).alias("avg_order_value"),
    ).orderBy(F.desc("total_revenue"))


def shipment_facts(oa: DataFrame, *dimensions: str) -> DataFrame:
    """One row per order and dimensions: revenue, delivery time and missing shipment."""
    return oa.groupBy(*dimensions, "order_id").agg(
        F.sum("line_revenue").alias("revenue"),
        F.bool_or(F.col("shipment_id").isNull()).alias("unshipped"),
        F.sum("delivery_days").alias("days"),
        F.count("delivery_days").alias("deliveries"),
    )


def mean_delivery_days():
    return safe_divide(F.sum("days"), F.sum("deliveries"))


def shipment_completeness(oa: DataFrame) -> DataFrame:
    """Orders with and without a shipment per status; the share is in percent."""
    counted = (
        shipment_facts(oa, "order_status")
        .groupBy("order_status")
        .agg(
            F.count("order_id").alias("total_orders"),
            F.count(F.when(F.col("unshipped"), F.col("order_id"))).alias(
                "orders_missing_shipment"
            ),
            F.round(mean_delivery_days(), 2).alias("avg_delivery_days"),
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


def revenue_by_month_name(oa: DataFrame) -> DataFrame:
    """Revenue per calendar month, all years together, January first."""
    named = oa.groupBy(
        F.month("order_date").alias("month"),
        F.date_format("order_date", "MMMM").alias("month_name"),
    )
    return named.agg(_revenue()).orderBy("month").drop("month")


def revenue_month_over_month(oa: DataFrame) -> DataFrame:
    """Revenue per month of each year and its change against the month before it.

    There is no change where the month before has no sales. The window has no partitions; it runs
    over one row per month.
    """
    monthly = oa.groupBy(F.trunc("order_date", "month").alias("month")).agg(_revenue())
    last = F.lag("month").over(Window.orderBy("month"))
    revenue = F.lag("total_revenue").over(Window.orderBy("month"))
    previous = F.when(last == F.add_months("month", -1), revenue)
    return (
        monthly.withColumn("previous_revenue", previous)
        .withColumn("revenue_change", F.col("total_revenue") - F.col("previous_revenue"))
        .orderBy("month")
    )
