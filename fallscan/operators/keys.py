"""Work on sets of tickers: selections, slices, missing and unstable ones.

Semi and anti joins carry no broadcast hint: both key sides grow with the data,
so adaptive execution decides by their measured size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def of_tickers(table: DataFrame, tickers: DataFrame) -> DataFrame:
    """Rows of ``table`` whose ticker occurs in ``tickers``."""
    return table.join(tickers.select("ticker"), "ticker", "left_semi")


def missing_tickers(requested: DataFrame, delivered: DataFrame) -> DataFrame:
    """Requested tickers for which nothing was delivered."""
    return requested.select("ticker").join(delivered.select("ticker"), "ticker", "left_anti")


def first_tickers(listing: DataFrame, n: int, offset: int = 0) -> DataFrame:
    """``n`` tickers in ticker order, after skipping ``offset`` of them."""
    ordered = listing.select("ticker").orderBy("ticker")
    return (ordered.offset(offset) if offset else ordered).limit(n)


def with_ticker(spark: SparkSession, tickers: DataFrame, ticker: str) -> DataFrame:
    """Add one ticker unless it is there already."""
    extra = spark.range(1).select(F.lit(ticker).alias("ticker"))
    return tickers.select("ticker").union(extra).distinct()


def load_stability(runs: DataFrame) -> DataFrame:
    """In how many of all repeated loads (``run_id, ticker``) a ticker was delivered."""
    total = runs.agg(F.count_distinct("run_id").alias("n")).scalar()
    per_ticker = runs.groupBy("ticker").agg(F.count_distinct("run_id").alias("n_runs"))
    return per_ticker.withColumn("is_stable", F.col("n_runs") == total)


def run_tickers(runs: DataFrame, run_id: int) -> DataFrame:
    return runs.where(F.col("run_id") == run_id).select("ticker")


def only_in_first(runs: DataFrame, first: int, second: int) -> DataFrame:
    """Tickers delivered in one run but not in another."""
    return run_tickers(runs, first).exceptAll(run_tickers(runs, second))


def in_both(runs: DataFrame, first: int, second: int) -> DataFrame:
    """Tickers delivered in both runs."""
    return run_tickers(runs, first).intersect(run_tickers(runs, second))
