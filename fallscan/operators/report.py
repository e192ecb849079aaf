"""Tables of a report: step counts, collated bars, chart points, company rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fallscan.functions.calendar import DateLike, as_date
from fallscan.functions.prices import day, high_point, low_point, price
from fallscan.operators.quality import MIN_BARS_OUTLIER, MIN_BARS_WINDOW, priced_bars
from fallscan.operators.series import by_ticker
from fallscan.operators.window_crash import DROP_PERC, is_window_crash

# The names of the steps, of the chart series and of a chart.
DOWNLOAD, ANOMALIES, CRASHES = "data_download", "anomalies_detected", "crashes_detected"
LINE_SERIES, CRASH_SERIES = "Adj Close", "Crash"
TITLE_SUFFIX = " Crash Detection"


# ---- step counts -------------------------------------------------------------------


def _step(stat: str, passed: Column, total: Column) -> Column:
    return F.struct(
        F.lit(stat).alias("stat"),
        passed.alias("passed"),
        (total - passed).alias("failed"),
        total.alias("total"),
    )


def _stack(totals: DataFrame, *steps: Column) -> DataFrame:
    return totals.select(F.inline(F.array(*steps)))


def download_stats(bars: DataFrame, min_bars: int = MIN_BARS_WINDOW) -> DataFrame:
    """The first step alone: delivered tickers, and those with enough prices."""
    per_ticker = bars.groupBy("ticker").agg((priced_bars() >= min_bars).alias("usable"))
    totals = per_ticker.agg(
        F.count(F.lit(1)).alias("delivered"), F.count_if("usable").alias("usable")
    )
    return _stack(totals, _step(DOWNLOAD, F.col("usable"), F.col("delivered")))


def window_step_stats(
    bars: DataFrame,
    latest_date: DateLike,
    period_start: DateLike,
    drop_perc: float = DROP_PERC,
    min_value_today: bool = True,
) -> DataFrame:
    """Step counts of the window test, from one aggregate per ticker.

    ``bars`` is the whole loaded history: its prices decide about usability, the
    days of the window about the drop.
    """
    in_window = F.when(day().between(as_date(period_start), as_date(latest_date)), price())
    per_ticker = bars.groupBy("ticker").agg(
        (priced_bars() >= MIN_BARS_WINDOW).alias("usable"),
        F.min(low_point(in_window, day())).alias("low"),
        F.min(high_point(in_window, day())).alias("high"),
    )
    crashed = is_window_crash(
        F.col("low"), F.col("high"), latest_date, drop_perc, min_value_today
    )
    totals = per_ticker.agg(
        F.count(F.lit(1)).alias("delivered"),
        F.count_if("usable").alias("usable"),
        F.count_if(F.col("usable") & crashed).alias("crashed"),
    )
    return _stack(
        totals,
        _step(DOWNLOAD, F.col("usable"), F.col("delivered")),
        _step(CRASHES, F.col("crashed"), F.col("usable")),
    )


def anomaly_step_stats(flagged: DataFrame) -> DataFrame:
    """Step counts of the outlier test, from the output of ``flag_drops``.

    ``failed`` of the second row counts tickers without an anomaly, not errors.
    """
    per_ticker = flagged.groupBy("ticker").agg(
        (priced_bars() >= MIN_BARS_OUTLIER).alias("usable"),
        F.bool_or("is_anomaly").alias("odd"),
        F.bool_or("is_crash").alias("crashed"),
    )
    totals = per_ticker.agg(
        F.count(F.lit(1)).alias("delivered"),
        *[F.count_if(flag).alias(flag) for flag in ("usable", "odd", "crashed")],
    )
    return _stack(
        totals,
        _step(DOWNLOAD, F.col("usable"), F.col("delivered")),
        _step(ANOMALIES, F.col("odd"), F.col("usable")),
        _step(CRASHES, F.col("crashed"), F.col("usable")),
    )


# ---- crash tables ----------------------------------------------------------------------


def in_report_order(crashes: DataFrame, date_col: str) -> DataFrame:
    """Crash rows by ticker and date, a distributed range sort."""
    return crashes.orderBy("ticker", date_col)


# ---- bars and crashes side by side ---------------------------------------------------


def collate(bars: DataFrame, crashes: DataFrame) -> DataFrame:
    """Every bar, with the crash whose lowest day it is (several if several)."""
    found = crashes.withColumn("trade_date", F.col("min_value_date"))
    return bars.join(found, ["ticker", "trade_date"], "left")


# ---- chart points --------------------------------------------------------------------


def _point(series: str, x: Column, y: Column) -> Column:
    return F.struct(F.lit(series).alias("series"), x.alias("x"), y.alias("y"))


def _titled(points: DataFrame) -> DataFrame:
    title = F.concat(F.col("ticker"), F.lit(TITLE_SUFFIX))
    return points.select("ticker", title.alias("title"), "series", "x", "y")


def window_chart_series(crashes: DataFrame) -> DataFrame:
    """Price line and crash markers from the output of ``window_crashes``.

    Each row is expanded in place to one or two points.
    """
    line, marker = _point(LINE_SERIES, day(), price()), _point(CRASH_SERIES, day(), price())
    points = F.when(F.col("min_value"), F.array(line, marker)).otherwise(F.array(line))
    return _titled(crashes.select("ticker", F.inline(points)))


def anomaly_chart_series(flagged: DataFrame) -> DataFrame:
    """Price line of every crashed ticker and a marker at each crash's lowest day.

    Takes the output of ``flag_drops``, in which bars and crashes still lie side by
    side, partitioned by ticker; no join is needed.
    """
    crashed = F.bool_or("is_crash").over(by_ticker())
    line = _point(LINE_SERIES, day(), price())
    marker = _point(CRASH_SERIES, F.col("min_value_date"), F.col("min_close"))
    points = F.when(F.col("is_crash"), F.array(line, marker)).otherwise(F.array(line))
    shown = flagged.withColumn("_crashed", crashed).where("_crashed")
    return _titled(shown.select("ticker", F.inline(points)))
