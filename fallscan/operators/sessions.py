"""Trading sessions as the bars show them, instead of a calendar rule.

The weekday rule of ``functions/calendar.py`` knows no holidays. Here a day is a session of a market if
a bar of one of its tickers lies on it. Sessions are numbered per market, and the n-th session
back from an as-of day is a look-up by number. The tables have a row per market and day; bars
are reduced to that on the map side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def sessions(bars: DataFrame, markets: DataFrame | None = None) -> DataFrame:
    """(market, session_date, session_no) from 1; one market if ``markets`` (ticker, market) is
    not given. Bars whose ticker has no market are left out."""
    days = bars.where(F.col("trade_date").isNotNull())
    if markets is None:
        days = days.select(F.lit("").alias("market"), "trade_date")
    else:
        # days per ticker first: the join then moves no more than one row per ticker and day
        days = days.select("ticker", "trade_date").join(markets.select("ticker", "market"), "ticker")
    days = days.select("market", F.col("trade_date").alias("session_date")).distinct()
    number = F.row_number().over(Window.partitionBy("market").orderBy("session_date"))
    return days.select("market", "session_date", number.alias("session_no"))


def session_windows(numbered: DataFrame, asofs: DataFrame, back: int) -> DataFrame:
    """(market, asof_date, first_day, last_day): per market and as-of day its latest session
    before that day, and the session ``back`` sessions earlier.

    As-of days that have fewer sessions before them have no window. Sessions and as-of days are
    sorted together, so the latest one is carried along and no range is joined.
    """
    markets = numbered.select("market").distinct()
    days = asofs.select("asof_date").where(F.col("asof_date").isNotNull()).distinct()
    everyday = days.agg(F.sort_array(F.collect_set("asof_date")).alias("days")).scalar()
    asked = markets.select("market", F.explode(everyday).alias("asof_date"))
    line = numbered.select("market", F.col("session_date").alias("at"), "session_no").unionByName(
        asked.select("market", F.col("asof_date").alias("at"), "asof_date"), allowMissingColumns=True
    )
    # a session on the as-of day itself does not count: as-of days come first
    order = Window.partitionBy("market").orderBy("at", F.col("asof_date").asc_nulls_last())
    latest = F.last("session_no", True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    found = line.withColumn("latest", latest).where(
        F.col("asof_date").isNotNull() & (F.col("latest") > back)
    )
    last = numbered.select("market", F.col("session_no").alias("latest"), F.col("session_date").alias("last_day"))
    first = numbered.select(
        "market", (F.col("session_no") + back).alias("latest"), F.col("session_date").alias("first_day")
    )
    return (
        found.select("market", "asof_date", "latest")
        .join(last, ["market", "latest"])
        .join(first, ["market", "latest"])
        .select("market", "asof_date", "first_day", "last_day")
    )


def longest_window(windows: DataFrame) -> int:
    """The most days from the first to the last day of a window; runs a job over ``windows``."""
    days = F.datediff("last_day", "first_day") + 1
    return windows.agg(F.max(days)).first()[0] or 1
