"""Every analysis and operator as a named query over the driver tables.

A query takes ``(spark, sf_dir)`` and reads whole tables. The day windows are the
parameters of the analyses, not a restriction of the check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from fallscan.functions.calendar import (
    crash_period, latest_trading_day, load_start, most_days, weekday_back,
)
from fallscan.operators import (
    anomaly_crash, key_filter, keys, outliers, quality, reconcile, report, sessions, window_crash,
)
from fallscan.operators.series import spread, with_previous_bar
from fallscan.plans import inputs, reports
from fallscan.sources import bars as bar_source
from fallscan.sources import companies as company_source
from fallscan.sources import listing as listing_source
from fallscan.sources import sink, wide_panel

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered analyses.
ASOF = "2024-01-31"
ASOF_PAST = "2024-01-20"  # inside the data: later bars must not count
WEEKDAYS = 5
LOAD_DAYS = 5
LOAD_MONTHS = 1
SECTOR = "FURNITURE"
REGION = "ASIA"
MAX_DAYS_IN_PAST = 2
FIRST_N = 10
SLICE_OFFSET, SLICE_LENGTH = 200, 40
EXTRA_TICKER = "TEXTRA"
RUN_A, RUN_B = 29, 30
WIDE_DAYS = 120
SESSIONS_BACK = 5

_REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    _REGISTRY[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


# ---- shared inputs -------------------------------------------------------------------


def _bars(spark, sf_dir):
    return inputs.event_bars(spark, sf_dir)


def _gappy(spark, sf_dir):
    return inputs.event_bars(spark, sf_dir, gappy=True)


def _period_bars(spark, sf_dir, gappy=False):
    first, last = crash_period(ASOF, WEEKDAYS)
    return inputs.event_bars(spark, sf_dir, first, last, gappy)


def _window_crashes(bars, today=False):
    first, last = crash_period(ASOF, WEEKDAYS)
    return window_crash.window_crashes(bars, last, first, min_value_today=today)


def _event_days(spark, sf_dir):
    return inputs.days_spanned(inputs.table(spark, sf_dir, "events"), "ts")


def _ship_days(spark, sf_dir):
    return inputs.days_spanned(inputs.table(spark, sf_dir, "lineitem"), "l_shipdate")


def _flagged(spark, sf_dir, bars):
    return anomaly_crash.flag_drops(bars, longest=_event_days(spark, sf_dir))


def _crashes(spark, sf_dir, bars):
    return anomaly_crash.anomaly_crashes(bars, longest=_event_days(spark, sf_dir))


def _scores(spark, sf_dir):
    return outliers.isolation_scores(_gappy(spark, sf_dir), _event_days(spark, sf_dir))


def _outliers(spark, sf_dir):
    return outliers.anomalies(_bars(spark, sf_dir), longest=_event_days(spark, sf_dir))


def _odd_gappy(spark, sf_dir):
    return outliers.anomalies(_gappy(spark, sf_dir), longest=_event_days(spark, sf_dir))


def _joined(spark, sf_dir):
    return anomaly_crash.window_join(_outliers(spark, sf_dir), _bars(spark, sf_dir))


# ---- sources and sinks ---------------------------------------------------------------


@query
def bars(spark, sf_dir):
    return _bars(spark, sf_dir)


@query
def bars_gappy(spark, sf_dir):
    return _gappy(spark, sf_dir)


@query
def bars_long(spark, sf_dir):
    return inputs.lineitem_bars(spark, sf_dir)


@query
def listing_parse(spark, sf_dir):
    return listing_source.parse_listing(inputs.listing_lines(spark, sf_dir))


@query
def bars_load_window(spark, sf_dir):
    loaded = inputs.event_bars(spark, sf_dir, first=load_start(ASOF, LOAD_DAYS, "day"))
    return bar_source.load_window(loaded, ASOF, LOAD_DAYS, "day")


@query
def bars_load_months(spark, sf_dir):
    loaded = inputs.event_bars(spark, sf_dir, first=load_start(ASOF, LOAD_MONTHS, "month"))
    return bar_source.load_window(loaded, ASOF, LOAD_MONTHS, "month")


@query
def bars_load_asof_past(spark, sf_dir):
    return bar_source.load_window(_bars(spark, sf_dir), ASOF_PAST, LOAD_DAYS, "day")


@query
def bars_load_weekdays(spark, sf_dir):
    return bar_source.load_window(_bars(spark, sf_dir), ASOF_PAST, LOAD_DAYS, "weekday")


@query
def panel_to_long(spark, sf_dir):
    panel = inputs.price_panel(spark, sf_dir)
    return bar_source.panel_to_long(panel, bar_source.panel_tickers(panel))


@query
def panel_wide_to_long(spark, sf_dir):
    """A stored panel of all tickers, read by chunks of columns."""
    path = sink.fresh_path(spark, "panel")
    inputs.ticker_panel(spark, sf_dir).write.parquet(path)
    return wide_panel.read_wide_panel(spark, path)


@query
def company_info(spark, sf_dir):
    return company_source.company_info(inputs.companies(spark, sf_dir))


@query
def bars_latest_batch(spark, sf_dir):
    return bar_source.one_bar_per_day(inputs.batch_bars(spark, sf_dir))


@query
def tickers_latest_batch(spark, sf_dir):
    return bar_source.latest_batch(inputs.batch_bars(spark, sf_dir))


@query
def bars_union_batches(spark, sf_dir):
    return bar_source.union_batches(
        _bars(spark, sf_dir), inputs.batch_bars(spark, sf_dir)
    )


@query
def bars_loaded_in_batches(spark, sf_dir):
    """Batches arrive one after the other, the last one twice."""
    batches = inputs.batch_bars(spark, sf_dir)
    path = sink.fresh_path(spark, "bars")
    names = [r.batch for r in batches.select("batch").distinct().orderBy("batch").collect()]
    for name in [*names, *names[-1:]]:
        sink.merge_batch(batches.where(F.col("batch") == name), path, ["batch"])
    return sink.read_by_month(spark, path, batches)


@query
def write_crash_tables(spark, sf_dir):
    crashes = _window_crashes(_period_bars(spark, sf_dir))
    path = sink.fresh_path(spark, "window_crashes")
    sink.write_by_month(crashes, path, "trade_date")
    return sink.read_by_month(spark, path, crashes)


# ---- projections and filters ---------------------------------------------------------


@query
def dollar_volume(spark, sf_dir):
    return quality.with_dollar_volume(_gappy(spark, sf_dir)).select(
        "ticker", "trade_date", "volume_close"
    )


@query
def bars_complete(spark, sf_dir):
    return quality.complete_bars(_gappy(spark, sf_dir))


@query
def bars_in_window(spark, sf_dir):
    first, last = crash_period(ASOF, WEEKDAYS)
    return bar_source.between_days(_period_bars(spark, sf_dir), first, last)


@query
def anomaly_change(spark, sf_dir):
    return anomaly_crash.with_change(_outliers(spark, sf_dir)).select(
        "ticker", "trade_date", "close", "prev_close", "close_diff", "close_percent_diff"
    )


@query
def anomaly_change_adjusted(spark, sf_dir):
    changed = anomaly_crash.with_change(_odd_gappy(spark, sf_dir), "adj_close")
    return changed.select(
        "ticker", "trade_date", "adj_close", "prev_close", "close_diff", "close_percent_diff"
    )


@query
def company_sector_filter(spark, sf_dir):
    return company_source.of_sector(inputs.companies(spark, sf_dir), SECTOR)


# ---- calendar ------------------------------------------------------------------------


@query
def latest_trading_days(spark, sf_dir):
    return inputs.asof_dates(spark, sf_dir).withColumn(
        "latest_date", latest_trading_day(F.col("asof_date"))
    )


@query
def weekday_back_n(spark, sf_dir):
    latest = latest_trading_day(F.col("asof_date"))
    return inputs.asof_dates(spark, sf_dir).withColumn(
        "period_start", weekday_back(latest, WEEKDAYS)
    )


def _long_sessions(spark, sf_dir):
    markets = inputs.supplier_markets(spark, sf_dir)
    return sessions.sessions(inputs.lineitem_bars(spark, sf_dir), markets)


@query
def market_sessions(spark, sf_dir):
    return _long_sessions(spark, sf_dir)


@query
def session_windows(spark, sf_dir):
    numbered = _long_sessions(spark, sf_dir)
    return sessions.session_windows(numbered, inputs.asof_dates(spark, sf_dir), SESSIONS_BACK)


# ---- quality and step counts -----------------------------------------------------------


@query
def ticker_quality(spark, sf_dir):
    return quality.ticker_quality(_gappy(spark, sf_dir))


@query
def ticker_all_null(spark, sf_dir):
    return quality.all_null_tickers(inputs.null_bars(spark, sf_dir))


@query
def usable_bars(spark, sf_dir):
    return quality.usable_bars(_gappy(spark, sf_dir))


@query
def usable_bars_outlier(spark, sf_dir):
    return quality.usable_bars(inputs.null_bars(spark, sf_dir), quality.MIN_BARS_OUTLIER)


@query
def stat_data_download(spark, sf_dir):
    return report.download_stats(_gappy(spark, sf_dir))


@query
def step_stats(spark, sf_dir):
    first, last = crash_period(ASOF, WEEKDAYS)
    return report.window_step_stats(_gappy(spark, sf_dir), last, first, min_value_today=False)


@query
def step_stats_today(spark, sf_dir):
    first, last = crash_period(ASOF, WEEKDAYS)
    return report.window_step_stats(_gappy(spark, sf_dir), last, first, min_value_today=True)


@query
def step_stats_outlier(spark, sf_dir):
    return report.anomaly_step_stats(_flagged(spark, sf_dir, _gappy(spark, sf_dir)))


# ---- the composed jobs -----------------------------------------------------------------


def _window_report(spark, sf_dir):
    listing = listing_source.parse_listing(inputs.listing_lines(spark, sf_dir))
    return reports.window_report(
        listing, company_source.company_info(inputs.companies(spark, sf_dir)),
        _gappy(spark, sf_dir), ASOF, sink.fresh_path(spark, "work"),
        reports.WindowParams(sector=SECTOR, min_value_today=False),
    )


def _outlier_report(spark, sf_dir):
    listing = listing_source.parse_listing(inputs.listing_lines(spark, sf_dir))
    return reports.outlier_report(
        listing, _gappy(spark, sf_dir), ASOF, sink.fresh_path(spark, "work")
    )


@query
def report_window_stats(spark, sf_dir):
    return _window_report(spark, sf_dir)["stats"]


@query
def report_window_crashes(spark, sf_dir):
    return _window_report(spark, sf_dir)["crashes"]


@query
def report_outlier_stats(spark, sf_dir):
    return _outlier_report(spark, sf_dir)["stats"]


@query
def report_outlier_crashes(spark, sf_dir):
    return _outlier_report(spark, sf_dir)["crashes"]


# ---- drops in one window ---------------------------------------------------------------


@query
def window_extremes(spark, sf_dir):
    first, last = crash_period(ASOF, WEEKDAYS)
    return window_crash.window_extremes(_period_bars(spark, sf_dir, gappy=True), last, first)


@query
def window_crashes(spark, sf_dir):
    return _window_crashes(_period_bars(spark, sf_dir))


@query
def window_crashes_today(spark, sf_dir):
    return _window_crashes(_period_bars(spark, sf_dir), today=True)


@query
def window_crashes_last_traded(spark, sf_dir):
    bars = _gappy(spark, sf_dir)
    last = window_crash.last_traded_day(bars, ASOF)
    return window_crash.window_crashes(bars, last, weekday_back(last, WEEKDAYS))


@query
def window_crashes_gappy(spark, sf_dir):
    return _window_crashes(_period_bars(spark, sf_dir, gappy=True))


@query
def window_crashes_every_day(spark, sf_dir):
    """The look-back test of the longer series for every order date as as-of day."""
    first, last = crash_period(F.col("asof_date"), WEEKDAYS)
    windows = inputs.asof_dates(spark, sf_dir).select(
        "asof_date", first.alias("first_day"), last.alias("last_day")
    )
    bars = inputs.lineitem_bars(spark, sf_dir)
    longest = most_days(WEEKDAYS, "weekday")
    return window_crash.window_drops(bars, windows, longest, min_value_today=False)


@query
def window_crashes_every_session(spark, sf_dir):
    """The same by the sessions of each ticker's market; the lowest day is the latest session."""
    windows = session_windows(spark, sf_dir)
    return window_crash.window_drops(
        inputs.lineitem_bars(spark, sf_dir), windows, sessions.longest_window(windows),
        markets=inputs.supplier_markets(spark, sf_dir),
    )


# ---- outliers --------------------------------------------------------------------------


@query
def bar_lag(spark, sf_dir):
    return with_previous_bar(_gappy(spark, sf_dir)).select(
        "ticker", "trade_date", "prev_date", "prev_close"
    )


@query
def isolation_score(spark, sf_dir):
    return _scores(spark, sf_dir).select(
        "ticker", "trade_date", "volume_close", "isolation_depth"
    )


@query
def isolation_score_long(spark, sf_dir):
    bars = inputs.lineitem_bars(spark, sf_dir)
    return outliers.isolation_scores(bars, _ship_days(spark, sf_dir)).select(
        "ticker", "trade_date", "volume_close", "isolation_depth"
    )


@query
def isolation_score_mixed(spark, sf_dir):
    """Short and long series in one table, of unknown length."""
    bars = _gappy(spark, sf_dir).unionByName(inputs.lineitem_bars(spark, sf_dir))
    return outliers.isolation_scores(bars).select(
        "ticker", "trade_date", "volume_close", "isolation_depth"
    )


@query
def isolation_score_forest(spark, sf_dir):
    scored = outliers.isolation_scores(_gappy(spark, sf_dir), model=outliers.FOREST)
    return scored.select("ticker", "trade_date", "volume_close", "isolation_depth")


@query
def anomalies_forest(spark, sf_dir):
    return outliers.anomalies(_gappy(spark, sf_dir), model=outliers.FOREST)


@query
def anomaly_flag(spark, sf_dir):
    return _scores(spark, sf_dir).select("ticker", "trade_date", "is_anomaly")


@query
def anomalies(spark, sf_dir):
    return _odd_gappy(spark, sf_dir)


@query
def anomaly_counts(spark, sf_dir):
    scored = outliers.score_bars(_gappy(spark, sf_dir), longest=_event_days(spark, sf_dir))
    return outliers.anomaly_counts(scored)


# ---- drops around outliers -------------------------------------------------------------


@query
def anomaly_window_join(spark, sf_dir):
    return _joined(spark, sf_dir).select("ticker", "anomaly_date", "trade_date", "adj_close")


@query
def anomaly_drop(spark, sf_dir):
    return anomaly_crash.joined_drops(_joined(spark, sf_dir))


@query
def window_close_list(spark, sf_dir):
    return anomaly_crash.window_close_list(_joined(spark, sf_dir))


@query
def anomaly_window_range(spark, sf_dir):
    windows = anomaly_crash.with_drop_window(_gappy(spark, sf_dir))
    return windows.where(F.col("min_close").isNotNull()).select(
        "ticker", "trade_date", *anomaly_crash.WINDOW_FIELDS
    )


@query
def anomaly_window_wide(spark, sf_dir):
    rows = inputs.table(spark, sf_dir, "lineitem").count()
    bars = spread(inputs.lineitem_bars(spark, sf_dir), rows)
    windows = anomaly_crash.with_drop_window(bars, WIDE_DAYS)
    return windows.where(F.col("min_close").isNotNull()).select(
        "ticker", "trade_date", *anomaly_crash.WINDOW_FIELDS
    )


@query
def anomaly_crashes(spark, sf_dir):
    return _crashes(spark, sf_dir, _bars(spark, sf_dir))


@query
def anomaly_crashes_gappy(spark, sf_dir):
    return _crashes(spark, sf_dir, _gappy(spark, sf_dir))


@query
def anomaly_crashes_long(spark, sf_dir):
    bars = inputs.lineitem_bars(spark, sf_dir)
    return anomaly_crash.anomaly_crashes(bars, longest=_ship_days(spark, sf_dir))


@query
def crash_recent(spark, sf_dir):
    crashes = _crashes(spark, sf_dir, _bars(spark, sf_dir))
    return anomaly_crash.recent_crashes(crashes, ASOF, MAX_DAYS_IN_PAST)


# ---- reports ---------------------------------------------------------------------------


@query
def crash_company_info(spark, sf_dir):
    crashes = _window_crashes(_period_bars(spark, sf_dir))
    return keys.of_tickers(company_info(spark, sf_dir), crashes)


@query
def report_crash_table(spark, sf_dir):
    crashes = _crashes(spark, sf_dir, _bars(spark, sf_dir))
    return report.in_report_order(crashes, "crash_date")


@query
def bars_of_sector(spark, sf_dir):
    return keys.of_tickers(_bars(spark, sf_dir), company_sector_filter(spark, sf_dir))


@query
def collate_bars_crashes(spark, sf_dir):
    bars = _bars(spark, sf_dir)
    return report.collate(bars, _crashes(spark, sf_dir, bars))


@query
def chart_series(spark, sf_dir):
    return report.window_chart_series(_window_crashes(_period_bars(spark, sf_dir)))


@query
def chart_series_outlier(spark, sf_dir):
    return report.anomaly_chart_series(_flagged(spark, sf_dir, _bars(spark, sf_dir)))


# ---- sets of tickers -------------------------------------------------------------------


@query
def tickers_missing(spark, sf_dir):
    return keys.missing_tickers(inputs.listing(spark, sf_dir), _bars(spark, sf_dir))


@query
def tickers_first_n(spark, sf_dir):
    return keys.first_tickers(inputs.listing(spark, sf_dir), FIRST_N)


@query
def tickers_slice(spark, sf_dir):
    return keys.first_tickers(inputs.listing(spark, sf_dir), SLICE_LENGTH, SLICE_OFFSET)


@query
def tickers_first_n_plus(spark, sf_dir):
    first = keys.first_tickers(inputs.listing(spark, sf_dir), FIRST_N)
    return keys.with_ticker(spark, first, EXTRA_TICKER)


@query
def load_stability(spark, sf_dir):
    return keys.load_stability(inputs.load_runs(spark, sf_dir))


@query
def run_tickers_except(spark, sf_dir):
    return keys.only_in_first(inputs.load_runs(spark, sf_dir), RUN_A, RUN_B)


@query
def run_tickers_intersect(spark, sf_dir):
    return keys.in_both(inputs.load_runs(spark, sf_dir), RUN_A, RUN_B)


@query
def bars_of_region(spark, sf_dir):
    wanted = inputs.region_tickers(spark, sf_dir, REGION)
    return key_filter.semi_join(inputs.lineitem_bars(spark, sf_dir), wanted)


@query
def load_differences(spark, sf_dir):
    """Prices that two loads of the same days do not have in common."""
    return reconcile.changes(
        _bars(spark, sf_dir), _gappy(spark, sf_dir), ["ticker", "trade_date", "adj_close"]
    )
