"""Dashboard measures, and the slicers that filter every one of them alike."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.functions import dax_divide
from orderlake.plans.reports import mean_delivery_days, shipment_facts


@dataclass(frozen=True)
class Slicers:
    """Selections of the dashboard. An empty pick list selects everything.

    None in a pick list picks the rows without a value. Dates are inclusive.
    """

    warehouse_city: Sequence[str | None] = ()
    order_status: Sequence[str | None] = ()
    category: Sequence[str | None] = ()
    date_from: dt.date | None = None
    date_to: dt.date | None = None


ALL = Slicers()


def _picked(column: str, picks: Sequence[str | None]) -> Column:
    named = F.col(column).isin([p for p in picks if p is not None])
    return named | F.col(column).isNull() if None in picks else named


def apply_slicers(oa: DataFrame, slicers: Slicers) -> DataFrame:
    """The rows that every slicer selects; give them to any report or measure.

    Where the table is read with its ``order_month``, folders of other months are not read.
    """
    for column in ("warehouse_city", "order_status", "category"):
        picks = getattr(slicers, column)
        if picks:
            oa = oa.where(_picked(column, picks))
    for date, within in ((slicers.date_from, Column.__ge__), (slicers.date_to, Column.__le__)):
        if date is not None:
            oa = oa.where(within(F.col("order_date"), F.lit(date)))
            if "order_month" in oa.columns:
                oa = oa.where(within(F.col("order_month"), F.lit(date.replace(day=1))))
    return oa


def kpi_cards(oa: DataFrame, slicers: Slicers = ALL) -> DataFrame:
    """All six cards in one row. The missing-shipment share is a ratio, not a percentage."""
    totals = shipment_facts(apply_slicers(oa, slicers)).agg(
        F.sum("revenue").alias("total_revenue"),
        F.count(F.lit(1)).alias("total_orders"),
        mean_delivery_days().alias("avg_delivery_days"),
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
