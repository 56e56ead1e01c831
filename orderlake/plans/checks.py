"""Data-quality checks of the curated table and reconciliation between zones."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DELIVERED = "Delivered"


def _unshipped() -> Column:
    return F.col("shipment_id").isNull()


def _bad_revenue() -> Column:
    return F.col("line_revenue").isNull() | (F.col("line_revenue") < 0)


def _bad_delivery() -> Column:
    return F.col("delivery_date") < F.col("shipment_date")


def _rows(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def total_rows(oa: DataFrame) -> DataFrame:
    return _rows(oa, "total_rows")


def missing_shipment_rows(oa: DataFrame) -> DataFrame:
    return _rows(oa.where(_unshipped()), "missing_shipment_rows")


def missing_shipment_by_status(oa: DataFrame) -> DataFrame:
    return _rows(oa.where(_unshipped()).groupBy("order_status"), "missing_shipment_rows").orderBy(
        F.desc("missing_shipment_rows")
    )


def affected_orders(oa: DataFrame) -> DataFrame:
    """Rows and distinct orders without a shipment, per status."""
    return (
        oa.where(_unshipped())
        .groupBy("order_status")
        .agg(
            F.count(F.lit(1)).alias("affected_rows"),
            F.countDistinct("order_id").alias("affected_orders"),
        )
        .orderBy(F.desc("affected_orders"))
    )


def delivered_coverage(orders: DataFrame, shipments: DataFrame) -> DataFrame:
    """Delivered orders of the processed zone, with and without a processed shipment.

    Both sides are reduced to distinct order ids first. The join then reuses
    their partitioning, and an order with many shipments is one row in it.
    """
    delivered = orders.where(F.col("order_status") == DELIVERED).select("order_id").distinct()
    shipped = shipments.select("order_id").distinct().withColumn("shipped", F.lit(True))
    without = F.col("shipped").isNull()
    return delivered.join(shipped, "order_id", "left").agg(
        F.count("order_id").alias("delivered_orders"),
        F.count("shipped").alias("delivered_orders_with_shipment"),
        F.count(F.when(without, F.col("order_id"))).alias("delivered_orders_without_shipment"),
    )


def raw_vs_processed(raw_shipments: DataFrame, shipments: DataFrame) -> DataFrame:
    """Distinct orders shipped according to the raw and to the processed zone.

    Raw ids are taken as they are, so one of only spaces counts as an id.
    """
    raw = raw_shipments.select("order_id", F.lit(True).alias("raw"), F.lit(False).alias("done"))
    done = shipments.select("order_id", F.lit(False), F.lit(True))
    seen = raw.unionAll(done).groupBy("order_id").agg(
        F.bool_or("raw").alias("raw"), F.bool_or("done").alias("done")
    )
    return seen.agg(
        F.count(F.when(F.col("raw"), F.col("order_id"))).alias("raw_shipment_orders"),
        F.count(F.when(F.col("done"), F.col("order_id"))).alias("processed_shipment_orders"),
    )


def delivered_missing_raw(raw_orders: DataFrame, raw_shipments: DataFrame) -> DataFrame:
    """Delivered raw orders that no raw shipment names, ids compared without outer spaces."""
    delivered = (
        raw_orders.where(F.trim("order_status") == DELIVERED)
        .select("order_id", F.trim("order_id").alias("trimmed"))
        .distinct()
    )
    shipped = raw_shipments.select(F.trim("order_id").alias("trimmed")).distinct()
    return delivered.join(shipped, "trimmed", "left_anti").agg(
        F.count("order_id").alias("delivered_orders_missing_raw_shipment")
    )


def duplicate_orders(oa: DataFrame) -> DataFrame:
    """Orders on several rows, as every order of several lines or shipments is.

    The id breaks ties, so that the sort can split the many equal counts.
    """
    return (
        oa.groupBy("order_id")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .where("row_count > 1")
        .orderBy(F.desc("row_count"), "order_id")
    )


def null_customers(oa: DataFrame) -> DataFrame:
    """Rows whose order names a customer that is not in the processed zone."""
    return _rows(oa.where(F.col("customer_id").isNull()), "null_customer_ids")


def invalid_revenue(oa: DataFrame) -> DataFrame:
    return _rows(oa.where(_bad_revenue()), "invalid_revenue_rows")


def invalid_delivery(oa: DataFrame) -> DataFrame:
    return _rows(oa.where(_bad_delivery()), "invalid_delivery_dates")


def dq_summary(oa: DataFrame) -> DataFrame:
    """The row-level checks of the curated table in one scan."""
    return oa.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(_unshipped()).alias("missing_shipment_rows"),
        F.count_if(F.col("customer_id").isNull()).alias("null_customer_ids"),
        F.count_if(_bad_revenue()).alias("invalid_revenue_rows"),
        F.count_if(_bad_delivery()).alias("invalid_delivery_dates"),
    )


def reconcile_zones(zones: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """Rows per table in the raw, processed and rejected zone, and whether they add up.

    ``zones`` maps a zone to its tables. No column of theirs is read.
    """
    marks = [
        df.select(F.lit(table).alias("table_name"), F.lit(zone).alias("zone"))
        for zone, tables in zones.items()
        for table, df in tables.items()
    ]
    counted = reduce(DataFrame.unionAll, marks).groupBy("table_name").agg(
        *(F.count_if(F.col("zone") == zone).alias(f"{zone}_rows") for zone in zones)
    )
    adds_up = F.col("raw_rows") == F.col("processed_rows") + F.col("rejected_rows")
    return counted.withColumn("reconciled", adds_up)


def reconcile_record(record: DataFrame) -> DataFrame:
    """The same from the counts that the run kept when it wrote the zones; no table is read."""
    zones = ("raw", "processed", "rejected")
    counted = record.where(F.col("zone").isin(*zones)).groupBy("table_name").agg(
        *(F.sum(F.when(F.col("zone") == zone, F.col("rows"))).alias(f"{zone}_rows") for zone in zones)
    )
    adds_up = F.col("raw_rows") == F.col("processed_rows") + F.col("rejected_rows")
    return counted.withColumn("reconciled", adds_up)
