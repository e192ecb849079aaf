import math

import pytest
from pyspark.sql import functions as F

from conftest import day
from fallscan.functions.prices import null_if_nan
from fallscan.operators.report import window_step_stats
from fallscan.operators.window_crash import last_traded_day, window_crashes, window_extremes
from fallscan.sources.bars import clean_prices

CASES = {
    "drop_exact": [100.0, 70.0],
    "drop_below": [100.0, 70.01],
    "rise": [70.0, 100.0],
    "tie_min": [100.0, 60.0, 60.0],
    "tie_max": [100.0, 50.0, 100.0],
    "tie_max_late": [50.0, 100.0, 100.0],
    "flat": [50.0, 50.0, 50.0],
    "nulls": [100.0, None, 60.0],
    "nan": [100.0, math.nan, 60.0],
    "all_null": [None, None],
    "one_bar": [100.0],
    "zero": [0.0, 0.0],
    "later": [100.0, 60.0, 80.0],
}
CRASHED = {"drop_exact", "tie_min", "tie_max", "nulls", "nan", "later"}


@pytest.fixture(scope="module")
def bars(prices):
    return clean_prices(prices(CASES))


def crashed(bars, last=5, first=1, **kwargs):
    found = window_crashes(bars, day(last), day(first), **kwargs)
    return {r.ticker for r in found.select("ticker").distinct().collect()}


def test_which_series_crash(bars):
    assert crashed(bars, min_value_today=False) == CRASHED


def test_minimum_on_the_latest_day_only(bars):
    # the lowest day is day 3 for exactly these; an earlier tie does not count
    assert crashed(bars, last=3) == {"nulls", "nan"}
    assert crashed(bars, last=2) == {"drop_exact", "tie_min", "tie_max", "later"}


def test_today_is_a_subset(bars):
    for last in range(1, 6):
        assert crashed(bars, last) <= crashed(bars, last, min_value_today=False)


def test_all_ties_are_flagged(bars):
    rows = window_crashes(bars, day(5), day(1), min_value_today=False).collect()
    flags = {t: [(r.max_value, r.min_value) for r in rows if r.ticker == t] for t in CRASHED}
    assert sorted(flags["tie_min"]) == [(False, True), (False, True), (True, False)]
    assert sorted(flags["tie_max"]) == [(False, True), (True, False), (True, False)]
    assert sum(f == (None, None) for f in flags["nulls"]) == 1


def test_extremes_take_the_earliest_day(bars):
    rows = {r.ticker: r for r in window_extremes(bars, day(5), day(1)).collect()}
    assert rows["tie_min"].min_date == day(2)
    assert rows["tie_max"].max_date == day(1)
    assert rows["tie_max_late"].max_date == day(2)
    assert rows["drop_exact"].diff_perc == 30.0
    assert rows["zero"].diff_perc is None
    assert "all_null" not in rows


def test_empty_window_gives_no_rows(bars):
    assert crashed(bars, last=40, first=30, min_value_today=False) == set()


def test_percentages_do_not_depend_on_scale(bars):
    doubled = bars.withColumn("adj_close", F.col("adj_close") * 4)
    assert crashed(doubled, min_value_today=False) == CRASHED


@pytest.mark.parametrize("partitions", [1, 7])
def test_order_and_partitioning_do_not_matter(bars, partitions):
    shuffled = bars.repartition(partitions).orderBy(F.desc("trade_date"))
    assert crashed(shuffled, min_value_today=False) == CRASHED


def test_last_traded_day_knows_holidays(make_bars):
    # day 3 is traded, day 4 is a holiday, asof is day 5: the rule would say day 4
    bars = make_bars({"T": [(1, 100.0, 1), (2, 90.0, 1), (3, 50.0, 1), (9, 500.0, 1)]})
    last = last_traded_day(bars, day(5))
    assert window_crashes(bars, last, day(1)).count() == 3
    assert window_crashes(bars, day(4), day(1)).isEmpty()


def test_step_counts(bars):
    rows = {r.stat: r for r in window_step_stats(bars, day(5), day(1), 30, False).collect()}
    assert rows["data_download"][1:] == (11, 2, 13)
    assert rows["crashes_detected"][1:] == (6, 5, 11)


def test_nan_becomes_null(spark):
    frame = spark.createDataFrame([(math.nan,), (1.0,), (None,)], "x double")
    assert [r[0] for r in frame.select(null_if_nan(F.col("x"))).collect()] == [None, 1.0, None]
