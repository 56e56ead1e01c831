"""Derived numbers of the curated table and the two kinds of safe division."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def line_revenue(quantity: str = "quantity", unit_price: str = "unit_price") -> Column:
    return F.round(F.col(quantity) * F.col(unit_price), 2)


def delivery_days(shipped: str = "shipment_date", delivered: str = "delivery_date") -> Column:
    return F.datediff(F.col(delivered), F.col(shipped))


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """SQL reports: NULL when the denominator is zero."""
    return F.try_divide(numerator, denominator)


def dax_divide(numerator: Column, denominator: Column, alternate: float = 0.0) -> Column:
    """Dashboard measures: ``alternate`` when the denominator is zero or blank."""
    empty = denominator.isNull() | (denominator == 0)
    return F.when(empty, F.lit(alternate)).otherwise(F.try_divide(numerator, denominator))
