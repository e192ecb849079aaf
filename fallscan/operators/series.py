"""The view of a bars table as one time series per ticker.

All analyses of neighbouring bars use these two windows, so a plan sorts each
ticker's bars once, behind one shuffle, no matter how many columns are added.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from fallscan.functions.prices import price
from fallscan.operators.quality import with_dollar_volume

# Days as integers in a column of their own: range frames count in them, and
# windows over one and the same column share their sort.
_DAY = "_day"
_RANK = "_rank"

#: Bars a task sorts after ``spread``, on average.
TASK_BARS = 100_000

SERIES_FIELDS = ["volume_close", "prev_date", "prev_close"]


def by_ticker() -> WindowSpec:
    return Window.partitionBy("ticker")


def series() -> WindowSpec:
    return by_ticker().orderBy(_DAY)


def whole() -> WindowSpec:
    """All bars of the ticker, in the order that the other windows need anyway."""
    return series().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def earlier() -> WindowSpec:
    """All bars before this one."""
    return series().rowsBetween(Window.unboundedPreceding, -1)


def ahead(days: int) -> WindowSpec:
    """This day and the ``days`` calendar days after it."""
    return series().rangeBetween(0, days)


def usable() -> Column:
    return F.col("volume_close").isNotNull()


def rank() -> Column:
    return F.col(_RANK)


def spread(bars: DataFrame, rows: int) -> DataFrame:
    """``bars``, of at most so many rows, partitioned by ticker into parts of bounded size.

    The reducers that a session sets do not grow with the table; these do, so what a task sorts
    stays the same. The analyses need no other shuffle by ticker then.
    """
    cores = bars.sparkSession.sparkContext.defaultParallelism
    return bars.repartition(max(cores, math.ceil(rows / TASK_BARS)), "ticker")


def with_day(bars: DataFrame) -> DataFrame:
    return bars if _DAY in bars.columns else bars.withColumn(_DAY, F.unix_date("trade_date"))


def with_series(bars: DataFrame) -> DataFrame:
    """Add ``SERIES_FIELDS``, and helper columns that start with an underscore.

    Unusable bars (no price or no volume) stay in the table but are never a
    predecessor, which equals a lag over the table without them. ``_rank`` counts
    the usable bars up to and including this one.
    """
    so_far = series().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        with_day(with_dollar_volume(bars)).withColumns(
            {
                "prev_date": F.last(F.when(usable(), F.col("trade_date")), True).over(earlier()),
                "prev_close": F.last(F.when(usable(), price()), True).over(earlier()),
                _RANK: F.count("volume_close").over(so_far),
            }
        )
    )


def with_previous_bar(bars: DataFrame) -> DataFrame:
    """Usable bars with day and price of the preceding one."""
    return with_series(bars).where(usable()).select(*bars.columns, *SERIES_FIELDS)
