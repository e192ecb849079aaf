"""Trading-day arithmetic as closed-form column expressions.

The rules know weekends but no holidays. Everything is plain date arithmetic on
a column (or a literal, which Catalyst then folds to a constant before planning,
so a window computed from a literal as-of date still prunes files).
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, functions as F

DateLike = datetime.date | str | Column


def as_date(value: DateLike) -> Column:
    """A ``DateType`` column from a date, an ISO string or a column."""
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def latest_trading_day(asof: DateLike) -> Column:
    """Friday when ``asof`` is a Monday, otherwise the calendar day before."""
    day = as_date(asof)
    return F.when(F.weekday(day) == 0, F.date_sub(day, 3)).otherwise(F.date_sub(day, 1))


def weekday_back(day: DateLike, weekdays: int) -> Column:
    """The date reached by stepping back until ``weekdays`` weekdays were met.

    A Saturday or Sunday start behaves like the Saturday, ``w`` below is how many
    weekdays of the week lie before the start. Each further five weekdays, begun
    or complete, cross one weekend of two days.
    """
    start = as_date(day)
    if weekdays == 0:
        return start
    w = F.least(F.weekday(start), F.lit(5))
    is_sunday = (F.weekday(start) == 6).cast("int")
    weekends = F.greatest(F.ceil((F.lit(weekdays) - w) / F.lit(5.0)), F.lit(0)).cast("int")
    return F.date_sub(start, F.lit(weekdays) + is_sunday + weekends * 2)


def crash_period(asof: DateLike, weekdays: int = 5) -> tuple[Column, Column]:
    """First and last day of the look-back window, both inclusive."""
    latest = latest_trading_day(asof)
    return weekday_back(latest, weekdays), latest


def most_days(length: int, unit: str) -> int:
    """A bound of the days that a load from ``load_start`` to the as-of day has."""
    return {"month": 31 * length, "day": length, "weekday": 2 * length + 4}[unit] + 1


def load_start(asof: DateLike, length: int, unit: str) -> Column:
    """First day to load for a history of ``length`` months, days or weekdays.

    Weekdays count trading sessions before the as-of day, as price services do.
    """
    day = as_date(asof)
    if unit == "month":
        return F.add_months(day, -length)
    if unit == "day":
        return F.date_sub(day, length)
    if unit == "weekday":
        return weekday_back(day, length)
    raise ValueError(f"unit must be 'month', 'day' or 'weekday', not {unit!r}")
