"""The two analyses from loaded bars to written report tables.

Each builds all of its tables from one computation: what several tables need is
written once to the shared folder and read back, so neither a second output nor a
lost executor repeats the work. No table passes through the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from fallscan.functions.calendar import DateLike, crash_period, most_days
from fallscan.operators import anomaly_crash, keys, outliers, quality, report, window_crash
from fallscan.sources import companies as company_source
from fallscan.sources.bars import load_window, one_bar
from fallscan.sources.sink import materialise, remove, write_by_month


@dataclass(frozen=True)
class WindowParams:
    """Parameters of the look-back test; fixed values are its defaults."""

    months: int = 1
    weekdays: int = 5
    drop_perc: float = window_crash.DROP_PERC
    min_value_today: bool = True
    sector: str = "Healthcare"


@dataclass(frozen=True)
class OutlierParams:
    """Parameters of the outlier test; fixed values are its defaults."""

    days: int = 5
    unit: str = "weekday"
    contamination: float = outliers.CONTAMINATION
    drop_perc: float = anomaly_crash.DROP_PERC
    days_after: int = anomaly_crash.DAYS_AFTER
    max_days_in_past: int | None = None


def window_report(
    listing: DataFrame,
    companies: DataFrame,
    bars: DataFrame,
    asof: DateLike,
    work: str,
    params: WindowParams = WindowParams(),
) -> dict[str, DataFrame]:
    """Step counts, crashed bars, chart points and companies of crashed tickers.

    Bars after the as-of day do not count, and of several rows per ticker and day one does.
    ``work`` is a folder that all executors share, for what several tables need.
    """
    first, last = crash_period(asof, params.weekdays)
    chosen = company_source.of_sector(
        keys.of_tickers(companies, listing.select("ticker")), params.sector
    )
    loaded = materialise(
        one_bar(keys.of_tickers(load_window(bars, asof, params.months, "month"), chosen)),
        work,
        "window-bars",
    )
    crashes = materialise(
        window_crash.window_crashes(
            quality.usable_bars(loaded), last, first, params.drop_perc, params.min_value_today
        ),
        work,
        "window-crashes",
    )
    return {
        "stats": report.window_step_stats(
            loaded, last, first, params.drop_perc, params.min_value_today
        ),
        "crashes": crashes,
        "chart": report.window_chart_series(crashes),
        "companies": keys.of_tickers(chosen, crashes),
    }


def outlier_report(
    listing: DataFrame,
    bars: DataFrame,
    asof: DateLike,
    work: str,
    params: OutlierParams = OutlierParams(),
) -> dict[str, DataFrame]:
    """Step counts, crashes, chart points and bars collated with crashes.

    As-of day, several rows per day and ``work`` are as in ``window_report``.
    """
    loaded = one_bar(
        keys.of_tickers(
            load_window(bars, asof, params.days, params.unit), listing.select("ticker")
        )
    )
    flagged = materialise(
        anomaly_crash.flag_drops(
            loaded, params.contamination, params.drop_perc, params.days_after,
            longest=most_days(params.days, params.unit),
        ),
        work,
        "flagged-bars",
    )
    if params.max_days_in_past is not None:
        flagged = anomaly_crash.only_recent(flagged, asof, params.max_days_in_past)
    crashes = anomaly_crash.crash_rows(flagged)
    return {
        "stats": report.anomaly_step_stats(flagged),
        "crashes": crashes,
        "chart": report.anomaly_chart_series(flagged),
        "collated": report.collate(flagged.select(*bars.columns), crashes),
    }


#: The date column by which a report table is partitioned; tables without one are
#: small (a row per step, a row per company) and written plainly.
_DAY_OF = {"trade_date", "crash_date", "x"}


def write_report(tables: dict[str, DataFrame], folder: str, work: str | None = None) -> None:
    """Write every table of a report below ``folder``, then remove its ``work`` folder."""
    for name, table in tables.items():
        days = [c for c in table.columns if c in _DAY_OF]
        path = f"{folder.rstrip('/')}/{name}"
        if days:
            write_by_month(table, path, days[0])
        else:
            table.write.mode("error").parquet(path)
    if work is not None and tables:
        remove(next(iter(tables.values())).sparkSession, work)
