"""Daily bars: loading, reshaping and merging.

Contract of a bars table: at most one row per ``(ticker, trade_date)``. A series
therefore has no more rows than its date range has days (about 25,000 for a
century), however large the table gets: a large table means many tickers. That
bound is what allows the analyses to keep one ticker's series inside one task.
``one_bar_per_day`` establishes the contract and does so by map-side aggregation,
so a ticker or day with very many raw rows is reduced before anything is
shuffled. ``latest_batch`` keeps all rows of a batch and does not establish it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fallscan.functions.calendar import DateLike, as_date, load_start
from fallscan.functions.prices import null_if_nan
from fallscan.schemas import BAR_FIELDS, BARS, PRICE_FIELDS


def read_bars(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Bars from files in the declared schema, NaN prices turned into nulls."""
    reader = spark.read.schema(BARS).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    return clean_prices(reader.load(path))


def clean_prices(bars: DataFrame) -> DataFrame:
    return bars.withColumns({f: null_if_nan(F.col(f)) for f in PRICE_FIELDS})


def load_window(bars: DataFrame, asof: DateLike, length: int, unit: str = "day") -> DataFrame:
    """Bars of the last ``length`` days, weekdays or months up to the as-of day, which counts.

    Both bounds prune a date-partitioned folder.
    """
    return between_days(bars, load_start(asof, length, unit), asof)


def between_days(bars: DataFrame, first: DateLike, last: DateLike) -> DataFrame:
    """Bars with ``first <= trade_date <= last``."""
    return bars.where(F.col("trade_date").between(as_date(first), as_date(last)))


def panel_to_long(
    panel: DataFrame, tickers: Sequence[str], separator: str = "__",
    named: Callable[[str], Column] = F.lit,
) -> DataFrame:
    """Turn columns named ``<field>__<ticker>`` into one row per ticker and day.

    Each panel row is expanded where it lies, so nothing is shuffled. A field the
    panel lacks for a ticker becomes null. ``named`` gives the ticker of a row where
    the columns are named by something else.
    """
    present = set(panel.columns)
    kinds = {f.name: f.dataType for f in BARS.fields}

    def field(name: str, ticker: str) -> Column:
        column = f"{name}{separator}{ticker}"
        value = F.col(f"`{column}`") if column in present else F.lit(None)
        return value.cast(kinds[name]).alias(name)

    rows = F.array(
        *[
            F.struct(named(t).alias("ticker"), *[field(name, t) for name in BAR_FIELDS])
            for t in tickers
        ]
    )
    expanded = panel.select("trade_date", F.explode(rows).alias("bar"))
    return expanded.select("bar.ticker", "trade_date", *[f"bar.{name}" for name in BAR_FIELDS])


def panel_tickers(panel: DataFrame, field: str = "adj_close", separator: str = "__") -> list[str]:
    """The tickers a wide panel holds, read off its column names."""
    prefix = field + separator
    return [c[len(prefix):] for c in panel.columns if c.startswith(prefix)]


def union_batches(*batches: DataFrame) -> DataFrame:
    """Bag union of batches by column name; absent columns become null."""
    merged, *rest = batches
    for batch in rest:
        merged = merged.unionByName(batch, allowMissingColumns=True)
    return merged


def one_bar_per_day(bars: DataFrame, order: str = "batch") -> DataFrame:
    """For every ``(ticker, trade_date)`` the bar of the latest batch."""
    fields = [c for c in bars.columns if c not in ("ticker", "trade_date", order)]
    newest = F.max(F.struct(order, *fields)).alias("newest")
    return (
        bars.groupBy("ticker", "trade_date")
        .agg(newest)
        .select("ticker", "trade_date", *[f"newest.{c}" for c in fields], f"newest.{order}")
    )


def one_bar(bars: DataFrame) -> DataFrame:
    """One row per ``(ticker, trade_date)``, where several loads left more: the greatest."""
    fields = [c for c in bars.columns if c not in ("ticker", "trade_date")]
    return (
        bars.groupBy("ticker", "trade_date")
        .agg(F.max(F.struct(*fields)).alias("_bar"))
        .select("ticker", "trade_date", *[f"_bar.{c}" for c in fields])
        .select(*bars.columns)
    )


def latest_batch(bars: DataFrame, order: str = "batch") -> DataFrame:
    """For every ticker all bars of its latest batch, which replaces earlier ones.

    Only one row per ticker travels back to the bars. The join is left to
    adaptive execution: a broadcast if the key side is measured to be small, a
    sort-merge join with skew splitting otherwise.
    """
    newest = bars.groupBy("ticker").agg(F.max(order).alias(order))
    return bars.join(newest, ["ticker", order], "left_semi")
