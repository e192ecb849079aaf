"""Drop from a peak to a later trough inside one look-back window per ticker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fallscan.functions.calendar import DateLike, as_date
from fallscan.functions.prices import day, high_point, low_point, percent_of, price
from fallscan.operators.spans import listed_extremes, price_series
from fallscan.sources.bars import between_days

# Fixed value: percent a price has to fall.
DROP_PERC = 30.0


def last_traded_day(bars: DataFrame, asof: DateLike) -> Column:
    """The latest day before ``asof`` that has a bar, as a scalar subquery.

    An alternative to the weekday rule that also knows about holidays.
    """
    return bars.where(day() < as_date(asof)).agg(F.max("trade_date")).scalar()


def window_extremes(bars: DataFrame, latest_date: DateLike, period_start: DateLike) -> DataFrame:
    """Per ticker the lowest and highest price of the window and their first days."""
    windowed = between_days(bars, period_start, latest_date)
    points = windowed.groupBy("ticker").agg(
        F.min(low_point(price(), day())).alias("low"), F.min(high_point(price(), day())).alias("high")
    )
    return points.where(F.col("low").isNotNull()).select("ticker", *extremes_of("low", "high"))


def extremes_of(low: str, high: str) -> list[Column]:
    lowest, highest = F.col(f"{low}.key"), -F.col(f"{high}.key")
    return [
        lowest.alias("min_price"),
        F.col(f"{low}.day").alias("min_date"),
        highest.alias("max_price"),
        F.col(f"{high}.day").alias("max_date"),
        percent_of(highest - lowest, highest).alias("diff_perc"),
    ]


def is_window_crash(
    low: Column, high: Column, latest_date: DateLike, drop_perc: float, min_value_today: bool
) -> Column:
    """The decision on the extreme points of a window; null points are no crash."""
    lowest, highest = low["key"], -high["key"]
    fell = percent_of(highest - lowest, highest) >= F.lit(float(drop_perc))
    crash = fell & (high["day"] < low["day"])
    if min_value_today:
        crash = crash & (low["day"] == as_date(latest_date))
    return F.coalesce(crash, F.lit(False))


def window_crashes(
    bars: DataFrame,
    latest_date: DateLike,
    period_start: DateLike,
    drop_perc: float = DROP_PERC,
    min_value_today: bool = True,
) -> DataFrame:
    """The window's bars of every crashed ticker, extremes flagged (all ties).

    The extremes are computed over the ticker's partition rather than by a grouped
    aggregate joined back: one scan, one shuffle and no join. A group holds at most
    one row per day of the window.
    """
    ticker = Window.partitionBy("ticker")
    bars = between_days(bars, period_start, latest_date)
    fields = bars.columns
    points = bars.withColumns(
        {
            "_low": F.min(low_point(price(), day())).over(ticker),
            "_high": F.min(high_point(price(), day())).over(ticker),
        }
    )
    low, high = F.col("_low"), F.col("_high")
    return points.where(is_window_crash(low, high, latest_date, drop_perc, min_value_today)).select(
        *fields,
        (price() == -high["key"]).alias("max_value"),
        (price() == low["key"]).alias("min_value"),
    )


# ---- many as-of days at once ---------------------------------------------------------


def window_drops(
    bars: DataFrame,
    windows: DataFrame,
    longest: int,
    drop_perc: float = DROP_PERC,
    min_value_today: bool = True,
    markets: DataFrame | None = None,
) -> DataFrame:
    """The crashes of ``window_crashes`` for every as-of day of ``windows``, a row each.

    ``windows`` has ``asof_date, first_day, last_day`` of at most ``longest`` days, and ``market``
    if ``markets`` (ticker, market) assigns tickers to markets. All as-of days are judged where a
    ticker's days lie as one array, whatever their number and the windows' length; only windows in which
    a price falls become rows. The list of as-of days is the one thing that is collected;
    a calendar bounds it.
    """
    first, last = F.col("first_day"), F.col("last_day")
    fields = F.collect_set(F.struct("asof_date", "first_day", "last_day")).alias("spans")
    tickers = price_series(bars)
    if markets is None:
        asked = tickers.withColumn("spans", windows.agg(fields).scalar())
    else:
        # a ticker of several markets has the windows of all; equal ones count once
        owned = markets.where(F.col("market").isNotNull()).groupBy("ticker").agg(
            F.array_sort(F.collect_set("market")).alias("markets")
        )
        of_market = owned.select("markets").distinct().withColumn("market", F.explode("markets"))
        listed = of_market.join(windows, "market").groupBy("markets").agg(fields)
        asked = tickers.join(owned, "ticker").join(listed, "markets")
    points = listed_extremes(asked, longest, falling=True)
    low, high = F.col("_low"), F.col("_high")
    crashed = points.where(is_window_crash(low, high, last, drop_perc, min_value_today))
    return crashed.select("ticker", "asof_date", first, last, *extremes_of("_low", "_high"))
