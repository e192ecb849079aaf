"""Which tickers were delivered, and which of them are usable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fallscan.functions.prices import dollar_volume, price

#: Priced bars a ticker needs: two for the window test (a single price cannot
#: fall), one for the outlier test.
MIN_BARS_WINDOW = 2
MIN_BARS_OUTLIER = 1


def priced_bars() -> Column:
    return F.count(price())


def ticker_quality(bars: DataFrame, min_bars: int = MIN_BARS_WINDOW) -> DataFrame:
    """Bars and priced bars per ticker, and whether the ticker is usable."""
    return bars.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n_bars"),
        priced_bars().alias("n_valid"),
        (priced_bars() >= min_bars).alias("is_usable"),
    )


def all_null_tickers(bars: DataFrame) -> DataFrame:
    """Tickers delivered without a single price."""
    return bars.groupBy("ticker").agg(priced_bars().alias("n")).where("n = 0").select("ticker")


def usable_bars(bars: DataFrame, min_bars: int = MIN_BARS_WINDOW) -> DataFrame:
    """All bars of the tickers with at least ``min_bars`` prices.

    Counting over the ticker's partition needs one shuffle and no join; analyses
    of the same ticker that follow reuse that partitioning.
    """
    count = priced_bars().over(Window.partitionBy("ticker"))
    return bars.withColumn("_n_valid", count).where(F.col("_n_valid") >= min_bars).drop("_n_valid")


def with_dollar_volume(bars: DataFrame) -> DataFrame:
    return bars.withColumn("volume_close", dollar_volume())


def complete_bars(bars: DataFrame) -> DataFrame:
    """Bars whose dollar volume is known."""
    return with_dollar_volume(bars).dropna(subset=["volume_close"])
