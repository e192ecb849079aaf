"""Drop from a peak to a later trough in a window around each outlier day.

The window of an outlier runs from its preceding usable bar to a number of
calendar days after it. Two forms are offered and give equal results:

* ``flag_drops`` / ``anomaly_crashes``: window functions over the bars, behind
  the same single shuffle as the outlier score. This is the default.
* ``window_join``: a range join, for outliers that come from elsewhere. It is
  keyed by ticker *and* a bin of calendar days, so each bar meets only the
  outliers nearby, and a long series is spread over many tasks. Bins come in several
  widths, so a window of many years is a few wide bins instead of many narrow ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fallscan.functions.calendar import DateLike, as_date
from fallscan.functions.prices import (
    day, high_point, low_point, null_if_nan, percent_of, price,
)
from fallscan.operators.outliers import ANOMALY_FIELDS, CONTAMINATION, WHOLE, scored_series
from fallscan.operators.series import SERIES_FIELDS, ahead, earlier, rank, usable, with_series
from fallscan.operators.spans import ahead_extremes

# Percent a price has to fall, and days to look ahead.
DROP_PERC = 30.0
DAYS_AFTER = 2

#: Calendar days of the look-ahead up to which a window's frame is read for every bar; wider
#: ones take extremes that run over blocks, at a cost that does not depend on the days.
WIDE_FRAME = 16

#: Calendar days of the smallest bin of the range join, and how many bins of a level make one of
#: the next. They affect speed only.
BLOCK_DAYS = 32
BIN_FACTOR = 8
BIN_LEVELS = 4

WINDOW_FIELDS = [
    "period_end_date", "period_max_diff", "period_percent_max_diff",
    "min_value_date", "min_close", "max_value_date",
]

CRASH_FIELDS = [
    "ticker", "crash_date", "crash_close", "crash_volume", "crash_volume_close",
    "precrash_date", "precrash_close", "precrash_close_diff", "precrash_close_percent_diff",
    "period_end_date", "period_max_diff", "period_percent_max_diff",
    "min_value_date", "min_close",
]


def with_change(scored: DataFrame, price_col: str = "close") -> DataFrame:
    """Add the change of ``price_col`` against the preceding adjusted price.

    The default mixes an unadjusted with an adjusted price, as the analysis this
    library re-expresses does; ``price_col="adj_close"`` compares like with like.
    """
    change = null_if_nan(F.col(price_col)) - F.col("prev_close")
    return scored.withColumns(
        {
            "close_diff": change,
            "close_percent_diff": percent_of(change, F.col("prev_close")),
        }
    )


def _window_columns(low: Column, high: Column) -> dict[str, Column]:
    lowest, highest = low["key"], -high["key"]
    return {
        "period_max_diff": lowest - highest,
        "period_percent_max_diff": percent_of(lowest - highest, highest),
        "min_value_date": low["day"],
        "min_close": lowest,
        "max_value_date": high["day"],
    }


def _with_windows(series: DataFrame, days_after: int) -> DataFrame:
    """Add ``WINDOW_FIELDS`` to the output of ``with_series``.

    The part of a window before its day are the bars since the preceding usable
    one: exactly the earlier bars of the highest rank. Minus the rank in front of
    the price makes a running minimum restart whenever the rank goes up, so the
    sort that is there anyway suffices.
    """
    columns = series.columns
    points = {"_low": low_point(price(), day()), "_high": high_point(price(), day())}

    def since_previous(point: Column) -> Column:
        run = F.min(
            F.when(
                point.isNotNull(),
                F.struct((-rank()).alias("recent"), point["key"].alias("key"), point["day"].alias("day")),
            )
        ).over(earlier())
        before = F.struct(run["key"].alias("key"), run["day"].alias("day"))
        return F.when(run.isNotNull(), before)

    before = {f"_before{p}": since_previous(c) for p, c in points.items()}
    if days_after > WIDE_FRAME:
        placed = ahead_extremes(series.withColumns(before), days_after)
    else:
        after = {p: F.min(c).over(ahead(days_after)) for p, c in points.items()}
        placed = series.withColumns(before | after)
    points = placed.withColumns({p: F.least(f"_before{p}", p) for p in points})
    has_window = usable() & F.col("prev_date").isNotNull()
    measured = _window_columns(F.col("_low"), F.col("_high"))
    return points.select(
        *columns,
        F.date_add("trade_date", days_after).alias("period_end_date"),
        *[F.when(has_window, c).alias(name) for name, c in measured.items()],
    )


def with_drop_window(bars: DataFrame, days_after: int = DAYS_AFTER) -> DataFrame:
    """All bars with their predecessor and window, whether outliers or not."""
    windows = _with_windows(with_series(bars), days_after)
    return windows.select(*bars.columns, *SERIES_FIELDS, *WINDOW_FIELDS)


def is_anomaly_crash(drop_perc: float) -> Column:
    fell = F.col("period_percent_max_diff") <= F.lit(-float(drop_perc))
    return F.coalesce(fell & (F.col("max_value_date") < F.col("min_value_date")), F.lit(False))


def flag_drops(
    bars: DataFrame,
    contamination: float = CONTAMINATION,
    drop_perc: float = DROP_PERC,
    days_after: int = DAYS_AFTER,
    longest: int | None = None,
    model: str = WHOLE,
) -> DataFrame:
    """All bars with outlier score, window and ``is_crash``; see ``scored_series``."""
    scored = scored_series(
        bars, contamination, longest, model, lambda series: _with_windows(series, days_after)
    )
    return scored.select(
        *bars.columns,
        *ANOMALY_FIELDS,
        *WINDOW_FIELDS,
        (F.col("is_anomaly") & is_anomaly_crash(drop_perc)).alias("is_crash"),
    )


def crash_rows(flagged: DataFrame, price_col: str = "close") -> DataFrame:
    """One row per crash in the published layout."""
    source = {
        "crash_date": "trade_date",
        "crash_close": "adj_close",
        "crash_volume": "volume",
        "crash_volume_close": "volume_close",
        "precrash_date": "prev_date",
        "precrash_close": "prev_close",
        "precrash_close_diff": "close_diff",
        "precrash_close_percent_diff": "close_percent_diff",
    }
    changed = with_change(flagged.where("is_crash"), price_col)
    return changed.select(*[F.col(source.get(name, name)).alias(name) for name in CRASH_FIELDS])


def anomaly_crashes(
    bars: DataFrame,
    contamination: float = CONTAMINATION,
    drop_perc: float = DROP_PERC,
    days_after: int = DAYS_AFTER,
    price_col: str = "close",
    longest: int | None = None,
    model: str = WHOLE,
) -> DataFrame:
    """Score, flag and test in one pass over the bars."""
    flagged = flag_drops(bars, contamination, drop_perc, days_after, longest, model)
    return crash_rows(flagged, price_col)


def _is_recent(asof: DateLike, max_days_in_past: int) -> Column:
    last = as_date(asof)
    return F.col("min_value_date").between(F.date_sub(last, max_days_in_past), last)


def recent_crashes(crashes: DataFrame, asof: DateLike, max_days_in_past: int) -> DataFrame:
    """Crashes whose lowest day is at most ``max_days_in_past`` days before ``asof``."""
    return crashes.where(_is_recent(asof, max_days_in_past))


def only_recent(flagged: DataFrame, asof: DateLike, max_days_in_past: int) -> DataFrame:
    """The same condition on the output of ``flag_drops``, which keeps all its bars."""
    recent = F.col("is_crash") & _is_recent(asof, max_days_in_past)
    return flagged.withColumn("is_crash", F.coalesce(recent, F.lit(False)))


# ---- range-join form -------------------------------------------------------------


def _bin(date: Column, level: int, block_days: int) -> Column:
    return F.floor(F.unix_date(date) / F.lit(block_days * BIN_FACTOR**level))


def _bins(first: Column, last: Column, block_days: int = BLOCK_DAYS) -> Column:
    """Bins (level, number) that cover the days from ``first`` to ``last``, each day once.

    At every level the bins left and right of the aligned middle are taken, fewer than
    ``2 * BIN_FACTOR``; the middle goes on to the next level, where a bin is ``BIN_FACTOR`` times as wide.
    """

    def numbered(level: int):
        return lambda number: F.struct(F.lit(level).alias("level"), number.alias("number"))

    low, high = _bin(first, 0, block_days), _bin(last, 0, block_days)
    taken = []
    for level in range(BIN_LEVELS):
        up_low = F.ceil(low / F.lit(BIN_FACTOR))
        up_high = F.floor((high + 1) / F.lit(BIN_FACTOR)) - 1
        whole = F.lit(level == BIN_LEVELS - 1) | (up_low > up_high)
        left = F.when(whole, high).otherwise(up_low * BIN_FACTOR - 1)
        right = F.when(whole, high + 1).otherwise((up_high + 1) * BIN_FACTOR)
        for start, end in ((low, left), (right, high)):
            numbers = F.when(start <= end, F.sequence(start, end)).otherwise(
                F.array().cast("array<bigint>")
            )
            taken.append(F.transform(numbers, numbered(level)))
        low = F.when(~whole, up_low).otherwise(1)
        high = F.when(~whole, up_high).otherwise(0)
    return F.concat(*taken)


def window_join(
    outliers: DataFrame,
    bars: DataFrame,
    days_after: int = DAYS_AFTER,
    block_days: int = BLOCK_DAYS,
) -> DataFrame:
    """Every outlier day with each bar of its window.

    ``outliers`` needs ``ticker, trade_date, prev_date``; further columns are kept.
    An outlier without a preceding bar has no window. A bar lies in one bin of each level, a window
    is cut into few bins of several levels, however long the gap before its day is.
    """
    end = F.date_add("anomaly_date", days_after)
    left = (
        outliers.where(F.col("prev_date").isNotNull())
        .withColumnRenamed("trade_date", "anomaly_date")
        .withColumn("period_end_date", end)
        .withColumn("_bin", F.explode(_bins(F.col("prev_date"), end, block_days)))
    )
    levels = [
        F.struct(F.lit(k).alias("level"), _bin(day(), k, block_days).alias("number"))
        for k in range(BIN_LEVELS)
    ]
    right = bars.select("ticker", "trade_date", "adj_close", F.explode(F.array(*levels)).alias("_bin"))
    in_window = F.col("o.prev_date") <= F.col("b.trade_date")
    in_window &= F.col("b.trade_date") <= F.col("o.period_end_date")
    same_bin = F.col("o.ticker") == F.col("b.ticker")
    same_bin &= F.col("o._bin.number") == F.col("b._bin.number")
    same_bin &= F.col("o._bin.level") == F.col("b._bin.level")
    kept = [c for c in left.columns if c not in ("_bin", "adj_close")]
    return (
        left.alias("o")
        .join(right.alias("b"), same_bin & in_window, "inner")
        .select(*[F.col(f"o.{c}") for c in kept], "b.trade_date", "b.adj_close")
    )


def joined_drops(joined: DataFrame) -> DataFrame:
    """Aggregate ``window_join`` to one row per outlier day."""
    points = joined.groupBy("ticker", "anomaly_date").agg(
        F.min(low_point(price(), day())).alias("low"), F.min(high_point(price(), day())).alias("high")
    )
    columns = _window_columns(F.col("low"), F.col("high"))
    return points.select(
        "ticker", "anomaly_date", *[c.alias(name) for name, c in columns.items()]
    )


def window_close_list(joined: DataFrame) -> DataFrame:
    """The prices of each outlier's window with their position in day order, from 0 (missing
    ones left out)."""
    entry = F.when(price().isNotNull(), F.struct("trade_date", "adj_close"))
    listed = F.array_sort(F.collect_list(entry))
    closes = joined.groupBy("ticker", "anomaly_date").agg(
        F.transform(listed, lambda e: e.adj_close).alias("closes")
    )
    return closes.select(
        "ticker", "anomaly_date", F.posexplode("closes").alias("position", "close")
    )
