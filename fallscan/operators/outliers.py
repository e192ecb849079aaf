"""Days of unusual dollar volume, judged within each ticker's own series.

Scores are added to *all* bars that have a ticker, and every window is partitioned by
ticker, so the bars are shuffled once for scoring, flagging and the drop test that
builds on them. No pairs of bars are formed.

Series are told apart by length. Up to ``SHORT_SERIES`` usable bars a series is scored in
place: its gaps are gathered by a window, and the depth is a column expression, without
join and without Python. Longer series are scored as one array per ticker, whose depths are
looked up by rank. A caller that knows a bound of the length, as after loading a few
weeks, states it as ``longest``; the plan then has one of the two parts only.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, functions as F

from fallscan.functions.isolation import (
    Depths, depth_curves, expected_depth, limited_forest, rounded, whole_series,
)
from fallscan.operators.quality import with_dollar_volume
from fallscan.operators.series import (
    SERIES_FIELDS, by_ticker, usable, whole, with_day, with_series,
)

# Fixed value: expected share of outliers.
CONTAMINATION = 0.1

#: Usable bars up to which a series is scored in place.
SHORT_SERIES = 128

SCORE_FIELDS = ["isolation_depth", "is_anomaly"]
ANOMALY_FIELDS = SERIES_FIELDS + SCORE_FIELDS

#: Models of the score: trees grown to the end over the whole series, or a forest of trees
#: that see a sample and stop at a depth limit.
WHOLE, FOREST = "whole", "forest"

Extend = Callable[[DataFrame], DataFrame]

#: Whether a bar has a depth. Filtering on this instead of on the depth itself
#: keeps the optimizer from evaluating the depth twice.
_SCORED = "_scored"
_TOTAL = "_total"


def _dollars() -> Column:
    return F.col("volume_close")


def _is_scored() -> Column:
    return usable() & (F.col(_TOTAL) >= 2)


def _by_value():
    return by_ticker().orderBy(_dollars().asc_nulls_last())


def _in_place(series: DataFrame) -> tuple[DataFrame, Column]:
    """Short series and the depth of each bar, from the gaps of its ticker."""
    lo, hi = _dollars(), F.col("_hi")
    gap = F.struct(lo.alias("lo"), hi.alias("hi"), (hi - lo).alias("width"))
    gaps = F.collect_list(F.when(hi > lo, gap)).over(by_ticker())
    paired = series.withColumn("_hi", F.lead(lo).over(_by_value()))
    return paired.withColumn("_gaps", gaps), expected_depth(lo, F.col("_gaps"))


def _by_curve(series: DataFrame, depths: Depths) -> tuple[DataFrame, Column]:
    """Series of any length and the depth of each bar, looked up by rank."""
    usable_rows = series.where(usable()).select("ticker", "volume_close")
    curves = depth_curves(usable_rows, "ticker", "volume_close", depths)
    placed = series.withColumn("_place", F.dense_rank().over(_by_value()))
    return placed.join(curves, "ticker", "left"), F.get("depths", F.col("_place") - 1)


def _flagged(placed: DataFrame, depth: Column, columns: list[str], contamination: float) -> DataFrame:
    scored = placed.select(
        *columns,
        _is_scored().alias(_SCORED),
        F.when(_is_scored(), rounded(depth)).alias("isolation_depth"),
    )
    threshold = F.percentile("isolation_depth", F.lit(float(contamination))).over(by_ticker())
    is_anomaly = F.coalesce(F.col("isolation_depth") < F.col("_threshold"), F.lit(False))
    return (
        scored.withColumn("_threshold", threshold)
        .withColumn("is_anomaly", is_anomaly)
        .drop("_threshold")
    )


def scored_series(
    bars: DataFrame,
    contamination: float = CONTAMINATION,
    longest: int | None = None,
    model: str = WHOLE,
    extend: Extend = lambda series: series,
) -> DataFrame:
    """Bars as series (see ``with_series``), after ``extend``, with ``SCORE_FIELDS``.

    A bar is an anomaly if its depth lies strictly below the ``contamination`` percentile of
    its ticker's depths. A ticker with a single usable bar gets no depth and hence no
    anomaly. Bars without a ticker belong to no series and are left out. ``longest`` is a bound
    of a ticker's usable bars if the caller knows one (any range of days is one): all series then
    take the way that suits it. A wrong one costs time, not correctness.
    """
    owned = with_day(with_dollar_volume(bars.where(F.col("ticker").isNotNull())))
    counted = owned.withColumn(_TOTAL, F.count("volume_close").over(whole()))

    def part(rows: DataFrame, place) -> DataFrame:
        series = extend(with_series(rows))
        return _flagged(*place(series), series.columns, contamination)

    if model == FOREST:
        return part(counted, partial(_by_curve, depths=limited_forest()))
    if model != WHOLE:
        raise ValueError(f"model must be {WHOLE!r} or {FOREST!r}, not {model!r}")
    by_curve = partial(_by_curve, depths=whole_series())
    if longest is not None:
        return part(counted, _in_place if longest <= SHORT_SERIES else by_curve)
    is_short = F.col(_TOTAL) <= SHORT_SERIES
    short = part(counted.where(is_short), _in_place)
    long = part(counted.where(~is_short), by_curve)
    return short.unionByName(long)


def score_bars(
    bars: DataFrame,
    contamination: float = CONTAMINATION,
    longest: int | None = None,
    model: str = WHOLE,
) -> DataFrame:
    """All bars of a ticker plus ``ANOMALY_FIELDS``."""
    scored = scored_series(bars, contamination, longest, model)
    return scored.select(*bars.columns, *ANOMALY_FIELDS)


def isolation_scores(bars: DataFrame, longest: int | None = None, model: str = WHOLE) -> DataFrame:
    """Usable bars with their depth; tickers with fewer than two give no rows."""
    scored = scored_series(bars, CONTAMINATION, longest, model)
    return scored.where(_SCORED).select(*bars.columns, *ANOMALY_FIELDS)


def anomalies(
    bars: DataFrame,
    contamination: float = CONTAMINATION,
    longest: int | None = None,
    model: str = WHOLE,
) -> DataFrame:
    """Only the flagged bars."""
    return score_bars(bars, contamination, longest, model).where("is_anomaly")


def anomaly_counts(scored: DataFrame) -> DataFrame:
    """Anomalies and usable bars per ticker, of tickers with any usable bar."""
    return (
        scored.where(usable())
        .groupBy("ticker")
        .agg(F.count_if("is_anomaly").alias("n_anomalies"), F.count(F.lit(1)).alias("n_rows"))
    )
