"""Price arithmetic shared by both drop tests."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def null_if_nan(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def price() -> Column:
    """The price every test looks at; NaN is no price."""
    return null_if_nan(F.col("adj_close"))


def day() -> Column:
    return F.col("trade_date")


def dollar_volume() -> Column:
    return null_if_nan(price() * F.col("volume"))


def percent_of(part: Column, whole: Column) -> Column:
    """``part / whole * 100``; null where ``whole`` is zero, so it is no drop."""
    return F.try_divide(part, whole) * 100


def _keyed(value: Column, at: Column) -> Column:
    # The price is the sort key, the day breaks ties towards the earliest date.
    # A missing price gives a null struct, which min() skips.
    return F.when(value.isNotNull(), F.struct(value.alias("key"), at.alias("day")))


def low_point(value: Column, at: Column) -> Column:
    """Orderable (key, day) whose minimum is the earliest lowest price."""
    return _keyed(value, at)


def high_point(value: Column, at: Column) -> Column:
    """Orderable (key, day) whose *minimum* is the earliest highest price.

    A max() over (price, day) would take the latest of equal prices, so the price
    is negated instead. ``key`` is therefore minus the price.
    """
    return _keyed(-value, at)
