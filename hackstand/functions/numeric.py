"""Rounding and sums whose results do not depend on row order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up(value: Column, digits: int) -> Column:
    """Round half up to ``digits`` decimals in plain double arithmetic."""
    scale = float(10**digits)
    return F.floor(value * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)


def exact_sum(value: Column, digits: int = 4) -> Column:
    """Sum as scaled longs: exact, order-free, and a map-side combinable aggregate.

    A sum of doubles depends on the order in which partial sums meet, which changes
    with the partitioning. Values are taken at ``digits`` decimals.
    """
    scale = float(10**digits)
    units = F.floor(value.cast("double") * F.lit(scale) + F.lit(0.5)).cast("long")
    return F.sum(units).cast("double") / F.lit(scale)


def exact_avg(value: Column, digits: int = 4) -> Column:
    return guarded_ratio(exact_sum(value, digits), F.count(value))


def guarded_ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` where ``bottom`` is positive, else NULL (division by zero raises)."""
    return F.when(bottom > 0, top.cast("double") / bottom.cast("double"))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return half_up(guarded_ratio(part, whole) * F.lit(100.0), digits)


def pass_percent(bad: Column, whole: Column, digits: int = 2) -> Column:
    """Share of rows that pass, in percent; an empty population passes."""
    return F.when(
        whole > 0,
        half_up((F.lit(1.0) - bad.cast("double") / whole.cast("double")) * F.lit(100.0), digits),
    ).otherwise(F.lit(100.0))


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def total(columns) -> Column:
    return reduce(lambda left, right: left + right, columns)
