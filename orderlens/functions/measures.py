"""Money, shares and conditional counts used by all reports."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def item_revenue() -> Column:
    """Item price plus freight, exact decimal."""
    return F.col("price") + F.col("freight_value")


def money(column: Column) -> Column:
    """An exact decimal amount, rounded to cents, reported as double."""
    return F.round(column, 2).cast("double")


def percent(part: Column, whole: Column, digits: int) -> Column:
    """100 * part / whole rounded half-up; NULL where the denominator is 0."""
    return F.round(F.try_divide(F.lit(100.0) * part.cast("double"), whole.cast("double")), digits)


def mean(total: Column, count: Column, digits: int) -> Column:
    return F.round(F.try_divide(total.cast("double"), count.cast("double")), digits)


def share(column: Column, digits: int = 1) -> Column:
    """Share of a column in its total. Use on an already aggregated frame of a few rows (states, types, buckets)."""
    return percent(column, F.sum(column).over(Window.partitionBy()), digits)


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def late() -> Column:
    """True for delivered late orders; NULL for undelivered ones."""
    return ~F.col("is_on_time")
