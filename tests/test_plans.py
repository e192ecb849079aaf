"""The plans that matter at scale: what is read, shuffled and joined."""

import re

import pytest

from conftest import day
from fallscan.operators import anomaly_crash, outliers
from fallscan.plans.registry import all_queries
from fallscan.sources.bars import read_bars
from fallscan.sources.sink import save_bucketed_bars

# The depths of long series are the one step in Python, over whole arrays.
ANY_PYTHON = re.compile(r"Python|ArrowEval|InPandas|InArrow")
PYTHON = re.compile(r"Python|ArrowEval|InPandas|(?<!Map)InArrow")
PAIRS = re.compile(r"NestedLoop|CartesianProduct")


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module", autouse=True)
def untruncated(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture(scope="module")
def bars_path(spark, prices, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bars") / "bars")
    series = {f"T{k}": [float(10 + (k * i) % 7) for i in range(1, 20)] for k in range(8)}
    prices(series).write.parquet(path)
    return path


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_python_no_pairs(spark, sf_dir, name):
    if name == "write_crash_tables":
        pytest.skip("its plan is a plain read of what it wrote")
    plan = plan_of(all_queries()[name](spark, sf_dir))
    assert not PYTHON.search(plan) and not PAIRS.search(plan)


def test_short_series_need_one_shuffle_no_join_and_no_python(spark, bars_path):
    bars = read_bars(spark, bars_path)
    plan = plan_of(anomaly_crash.anomaly_crashes(bars, longest=30))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 2
    assert "Join" not in plan and not ANY_PYTHON.search(plan)


def test_series_of_unknown_length_shuffle_the_bars_once(spark, bars_path):
    crashes = anomaly_crash.anomaly_crashes(read_bars(spark, bars_path))
    assert crashes.count() >= 0
    crashes.collect()
    plan = plan_of(crashes)
    final = plan[: plan.index("Initial Plan")]
    # bars for short series, reused for long ones (twice), and the curves of long ones
    assert final.count("Exchange hashpartitioning(ticker") - final.count("ReusedExchange") <= 2


def test_report_of_outliers_adds_no_shuffle(spark, bars_path):
    from fallscan.operators.report import anomaly_chart_series

    flagged = anomaly_crash.flag_drops(read_bars(spark, bars_path), longest=30)
    assert plan_of(anomaly_chart_series(flagged)).count("Exchange hashpartitioning") == 1


def test_window_crashes_need_one_shuffle_and_read_the_window_only(spark, bars_path):
    from fallscan.operators.window_crash import window_crashes

    plan = plan_of(window_crashes(read_bars(spark, bars_path), day(9), day(3)))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Join" not in plan
    assert "GreaterThanOrEqual(trade_date,2024-01-03)" in plan
    assert "LessThanOrEqual(trade_date,2024-01-09)" in plan


def test_scores_read_the_needed_columns_only(spark, bars_path):
    scores = outliers.isolation_scores(read_bars(spark, bars_path))
    plan = plan_of(scores.select("ticker", "trade_date", "isolation_depth"))
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {c.split(":")[0] for c in read.split(",")} == {
        "ticker", "trade_date", "adj_close", "volume",
    }


def test_time_window_reaches_the_event_scan(spark, sf_dir):
    plan = plan_of(all_queries()["window_crashes"](spark, sf_dir))
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", plan).group(1)
    assert "GreaterThanOrEqual(ts,2024-01-23T00:00)" in pushed
    assert "LessThan(ts,2024-01-31T00:00)" in pushed


def test_raw_events_are_reduced_before_the_shuffle(spark, sf_dir):
    plan = plan_of(all_queries()["bars"](spark, sf_dir))
    assert plan.index("partial_max") > plan.index("Exchange hashpartitioning")


def test_bucketed_bars_need_no_shuffle(spark, bars_path, tmp_path):
    save_bucketed_bars(read_bars(spark, bars_path), "bucketed_bars", 4, str(tmp_path / "b"))
    try:
        plan = plan_of(anomaly_crash.anomaly_crashes(spark.table("bucketed_bars"), longest=30))
        assert "Exchange hashpartitioning" not in plan
        from_files = anomaly_crash.anomaly_crashes(read_bars(spark, bars_path))
        from_table = anomaly_crash.anomaly_crashes(spark.table("bucketed_bars"))
        assert from_files.exceptAll(from_table).isEmpty()
        assert from_table.exceptAll(from_files).isEmpty()
    finally:
        spark.sql("DROP TABLE bucketed_bars")


def test_range_join_is_spread_over_blocks(spark, bars_path):
    bars = read_bars(spark, bars_path)
    odd = outliers.anomalies(bars)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(anomaly_crash.window_join(odd, bars))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert re.search(r"SortMergeJoin \[ticker#\d+, _bin#\d+.number, _bin#\d+.level\]", plan)
    assert not PAIRS.search(plan)
