"""Lowest and highest prices of many day spans per ticker, at a cost independent of their length.

A frame of a range window is read anew for every row, so a look-ahead of 500 days costs 500 times
one of a day. ``ahead_extremes`` cuts days into blocks, and extremes run forward from each block's first
day and backward from its last one. A span that crosses one boundary is made of two such runs: from
its first day to the end of that block, and from the start of the next to its last day (van Herk,
Pattern Recognition Letters 1992). Spans of one length n take blocks of n days: they cross
one boundary, or are a whole block. That happens behind one shuffle by ticker and two sorts. A running
minimum over (block, price, day) restarts at each block by itself, since the block leads the comparison.

Spans of several lengths are looked up in a ticker's days as one array, which its range of days
bounds (``functions/span_kernels.py``).
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from fallscan.functions import span_kernels
from fallscan.functions.prices import day, high_point, low_point, price

# Workers get the kernels with the task, so they need no installed package.
cloudpickle.register_pickle_by_value(span_kernels)

_DATA, _QUERY = 0, 1  # at one day, data comes before what asks for it

_POINTS = ("_low", "_high")


def _with_runs(rows: DataFrame, sizes: list[int], forward: bool) -> DataFrame:
    """Add to each row the extremes from its block's edge up to it, in blocks of its level.

    Forward runs need the block to lead in descending order, backward ones in ascending order:
    the block entered last must compare least.
    """
    at = F.col("_pos")
    spec = Window.partitionBy("ticker").orderBy(at.asc() if forward else at.desc(), "_kind")
    spec = spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def lead(size: int) -> Column:
        block = F.floor(at / F.lit(size))
        return -block if forward else block

    runs = {}
    for p in _POINTS:
        for k, size in enumerate(sizes):
            entry = F.struct(lead(size).alias("lead"), F.col(f"{p}.key"), F.col(f"{p}.day"))
            runs[f"_run{p}{k}"] = F.min(F.when(F.col(p).isNotNull(), entry)).over(spec)
    found = {}
    for p in _POINTS:
        at_level = []
        for k, size in enumerate(sizes):
            run = F.col(f"_run{p}{k}")
            point = F.struct(run["key"].alias("key"), run["day"].alias("day"))
            at_level.append(F.when((F.col("_level") == k) & (run["lead"] == lead(size)), point))
        found[("_to" if forward else "_from") + p] = F.coalesce(*at_level)
    return rows.withColumns(runs).withColumns(found).drop(*runs)


def _extremes(rows: DataFrame, sizes: list[int]) -> DataFrame:
    """(ticker, _id, _row, _low, _high) of spans, from bars, starts and ends in one table."""
    points = rows.withColumns(
        {"_low": low_point(price(), day()), "_high": high_point(price(), day())}
    )
    run = _with_runs(_with_runs(points, sizes, forward=True), sizes, forward=False)
    merged = [
        F.min(F.when(F.col("_is_end"), F.col(f"_to{p}")).otherwise(F.col(f"_from{p}"))).alias(p)
        for p in _POINTS
    ]
    return (
        run.where(F.col("_id").isNotNull())
        .groupBy("ticker", "_id")
        .agg(F.any_value("_row", True).alias("_row"), *merged)
    )


def ahead_extremes(bars: DataFrame, days: int) -> DataFrame:
    """All columns of ``bars`` with ``_low`` and ``_high``, the (key, day) points (see
    ``low_point``) of the bar's day and the ``days`` calendar days after it.

    A bar is data and the start of its own span; a second, narrow row marks the span's end. Both
    come from one row where it lies, so bars that are partitioned by ticker stay so.
    """
    is_end = F.col("_is_end")
    numbered = bars.select(
        "ticker",  # as it is, so that its partitioning is known
        F.struct(*[F.col(c) for c in bars.columns]).alias("_row"),
        F.monotonically_increasing_id().alias("_id"),
    )
    twice = numbered.select("*", F.explode(F.array(F.lit(False), F.lit(True))).alias("_is_end"))
    rows = twice.select(
        "ticker",
        F.when(~is_end, F.col("_row.trade_date")).alias("trade_date"),
        F.when(~is_end, F.col("_row.adj_close")).alias("adj_close"),
        (F.unix_date("_row.trade_date") + F.when(is_end, days).otherwise(0)).alias("_pos"),
        F.when(is_end, _QUERY).otherwise(_DATA).alias("_kind"),
        F.lit(0).alias("_level"),
        "_id",
        "_is_end",
        F.when(~is_end, F.col("_row")).alias("_row"),
    )
    return _extremes(rows, [days + 1]).select("_row.*", "_low", "_high")


def price_series(bars: DataFrame) -> DataFrame:
    """(ticker, series): the days that have a price, with their lowest and highest one.

    Days are reduced to one row each first, on the map side, so a series is as long as its range
    of days however often a bar is repeated.
    """
    priced = bars.where(price().isNotNull() & day().isNotNull())
    daily = priced.groupBy("ticker", "trade_date").agg(
        F.min("adj_close").alias("low"), F.max("adj_close").alias("high")
    )
    bar = F.struct(F.col("trade_date").alias("day"), "low", "high")
    return daily.groupBy("ticker").agg(F.collect_list(bar).alias("series"))


def listed_extremes(asked: DataFrame, longest: int, falling: bool = False) -> DataFrame:
    """(ticker, ..., _low, _high) with a row per span of (ticker, series, spans).

    ``series`` comes from ``price_series``; ``spans`` is an array of structs with ``first_day`` and
    ``last_day``, whose fields are kept. Both travel as they are, so spans become rows only
    behind the shuffle. With ``falling`` only spans whose highest day is before the lowest come back.
    """
    span = asked.schema["spans"].dataType.elementType.simpleString()
    point = "struct<key:double,day:date>"
    found = asked.select("ticker", "series", "spans").mapInArrow(
        span_kernels.extremes_of_lists(longest, falling),
        f"ticker string, span {span}, _low {point}, _high {point}",
    )
    return found.select("ticker", "span.*", "_low", "_high")


def span_extremes(bars: DataFrame, spans: DataFrame, longest: int) -> DataFrame:
    """``spans`` with ``_low`` and ``_high`` of the days ``first_day`` to ``last_day``.

    ``spans`` needs ``ticker``, ``first_day`` and ``last_day``; a ticker's spans travel as one row.
    ``longest`` is the most days a span has. Spans that end before they begin, and spans without
    a price, have null points.
    """
    fields = [c for c in spans.columns if c != "ticker"]
    listed = spans.groupBy("ticker").agg(F.collect_list(F.struct(*fields)).alias("spans")).alias("l")
    series = price_series(bars).alias("s")
    asked = listed.join(series, F.col("l.ticker").eqNullSafe(F.col("s.ticker")), "left").select(
        "l.ticker", "spans", F.coalesce("series", F.array().cast(series.schema["series"].dataType)).alias("series")
    )
    return listed_extremes(asked, longest).select(*spans.columns, "_low", "_high")
