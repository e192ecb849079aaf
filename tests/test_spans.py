"""Extremes over many spans, as-of days and sessions, against brute force."""

import datetime
import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import day
from fallscan.functions.calendar import crash_period, most_days
from fallscan.operators import anomaly_crash as ac
from fallscan.operators import sessions as se
from fallscan.operators.outliers import score_bars
from fallscan.operators.series import TASK_BARS, spread
from fallscan.operators.spans import ahead_extremes, span_extremes
from fallscan.operators.window_crash import window_crashes, window_drops


@pytest.fixture(scope="module")
def gappy(make_bars):
    """Several years with long gaps, missing prices and equal prices."""
    rng, series = random.Random(11), {}
    for k in range(6):
        at, points = rng.randint(-800, 0), []
        while at < 900:
            at += rng.choice((1, 1, 1, 2, 3, 40, 300) if k % 2 else (1, 2, 3))
            points.append((at, rng.choice((None, 1.0, 2.0, 3.0, 5.0, 8.0, 13.0)), 1))
        series[f"T{k}"] = points
    return make_bars(series)


def prices_of(bars):
    found = {}
    for r in bars.collect():
        found.setdefault(r.ticker, []).append((r.trade_date, r.adj_close))
    return found


def extremes(prices, first, last):
    inside = [(p, d) for d, p in prices if p is not None and first <= d <= last]
    if not inside:
        return None, None
    return min(inside), min((-p, d) for p, d in inside)


def point(p):
    return None if p is None else (p.key, p.day)


@pytest.mark.parametrize("days", [0, 1, 2, 17, 90, 500])
def test_look_ahead_equals_brute_force(gappy, days):
    prices = prices_of(gappy)
    rows = ahead_extremes(gappy.repartition(3), days).collect()
    assert len(rows) == gappy.count()
    for r in rows:
        end = r.trade_date + datetime.timedelta(days=days)
        assert (point(r._low), point(r._high)) == extremes(prices[r.ticker], r.trade_date, end)


@pytest.mark.parametrize("longest", [1, 2, 9, 64, 1000])
def test_spans_equal_brute_force(spark, gappy, longest):
    rng, prices, asked = random.Random(longest), prices_of(gappy), set()
    for ticker in [*prices, "absent"]:
        for _ in range(150):
            first = day(rng.randint(-20_000 if rng.random() < 0.1 else -900, 950))
            asked.add((ticker, first, first + datetime.timedelta(days=rng.randint(-1, longest - 1))))
    spans = spark.createDataFrame(sorted(asked), "ticker string, first_day date, last_day date")
    rows = span_extremes(gappy, spans, longest).collect()
    assert {(r.ticker, r.first_day, r.last_day) for r in rows} == asked and len(rows) == len(asked)
    for r in rows:
        expected = extremes(prices.get(r.ticker, []), r.first_day, r.last_day)
        assert (point(r._low), point(r._high)) == expected


def test_a_span_beyond_the_bound_is_refused(spark, gappy):
    spans = spark.createDataFrame([("T0", day(1), day(10))], "ticker string, first_day date, last_day date")
    with pytest.raises(Exception, match="more than 9 days"):
        span_extremes(gappy, spans, 9).collect()


@pytest.mark.parametrize("days", [2, 17, 500])
def test_wide_and_narrow_frames_agree(gappy, monkeypatch, days):
    found = []
    for wide in (0, 10_000):
        monkeypatch.setattr(ac, "WIDE_FRAME", wide)
        found.append(sorted(map(str, ac.with_drop_window(gappy, days).collect())))
        found.append(sorted(map(str, ac.flag_drops(gappy, days_after=days).collect())))
    assert found[0] == found[2] and found[1] == found[3]


def test_wide_frames_add_no_shuffle(spark, gappy, tmp_path):
    gappy.write.parquet(str(tmp_path / "b"))
    plan = ac.with_drop_window(spark.read.parquet(str(tmp_path / "b")), 500)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    assert "RangeFrame, currentrow" not in plan


@pytest.mark.parametrize("today", [True, False])
def test_every_day_equals_one_day_at_a_time(spark, gappy, today):
    asofs = spark.createDataFrame([(day(k),) for k in range(100, 140)], "asof_date date")
    first, last = crash_period(F.col("asof_date"), 5)
    windows = asofs.select("asof_date", first.alias("first_day"), last.alias("last_day"))
    found = window_drops(gappy, windows, most_days(5, "weekday"), min_value_today=today).collect()
    expected = set()
    for k in range(100, 140):
        first, last = crash_period(day(k), 5)
        for r in window_crashes(gappy, last, first, min_value_today=today).collect():
            expected.add((r.ticker, day(k)))
            if r.min_value or r.max_value:
                (own,) = [x for x in found if (x.ticker, x.asof_date) == (r.ticker, day(k))]
                assert (r.adj_close == own.min_price) == r.min_value
                assert (r.adj_close == own.max_price) == r.max_value
    assert {(r.ticker, r.asof_date) for r in found} == expected and len(found) == len(expected)
    assert expected or today


def test_every_day_shuffles_the_bars_once(spark, gappy, tmp_path):
    gappy.write.parquet(str(tmp_path / "b"))
    windows = spark.createDataFrame([(day(5), day(1), day(4))], "asof_date date, first_day date, last_day date")
    drops = window_drops(spark.read.parquet(str(tmp_path / "b")), windows, 9)
    plan = drops._jdf.queryExecution().executedPlan().toString()
    # the bars with the spans, and one row per task for a ticker's first and last day
    assert plan.count("Exchange hashpartitioning(ticker") == 2 and "Join" not in plan


def test_spans_become_rows_only_behind_the_shuffle(spark, gappy, tmp_path):
    """Every ticker with every as-of day was a row of the shuffle, sorted twice."""
    gappy.write.parquet(str(tmp_path / "b"))
    windows = spark.createDataFrame([(day(5), day(1), day(4), "A")], "asof_date date, first_day date, last_day date, market string")
    markets = spark.createDataFrame([("T0", "A")], "ticker string, market string")
    for m in (None, markets):
        drops = window_drops(spark.read.parquet(str(tmp_path / "b")), windows, 9, markets=m)
        plan = drops._jdf.queryExecution().executedPlan().toString()
        assert "explode(spans" not in plan and "explode(filter" not in plan and "Window" not in plan
        assert "MapInArrow" in plan


def test_days_repeat_or_lack_and_tickers_have_two_markets(spark, make_bars):
    bars = make_bars({"T": [(1, 10.0, 1), (2, 4.0, 1), (2, 5.0, 1), (2, 4.0, 2), (3, None, 1)], "U": [(1, 3.0, 1)]})
    bars = bars.unionByName(bars.where("ticker = 'T'").withColumn("trade_date", F.lit(None).cast("date")))
    windows = spark.createDataFrame(
        [(day(4), day(1), day(3), m) for m in ("A", "B")] + [(day(5), day(1), day(2), "B"), (None, None, None, "A")],
        "asof_date date, first_day date, last_day date, market string",
    )
    pairs = [("T", "A"), ("T", "B"), ("T", "B"), ("T", None), ("U", "A"), ("V", "A")]
    markets = spark.createDataFrame(pairs, "ticker string, market string")
    found = window_drops(bars, windows, 9, min_value_today=False, markets=markets).collect()
    assert sorted((r.ticker, r.asof_date, r.min_price, r.min_date, r.max_date, r.diff_perc) for r in found) == [
        ("T", day(4), 4.0, day(2), day(1), 60.0), ("T", day(5), 4.0, day(2), day(1), 60.0),
    ]


# ---- bins ----------------------------------------------------------------------------------


def test_bins_are_few_and_meet_each_day_once(spark):
    rng = random.Random(5)
    spans = [(0, 0), (0, 40_000), (-700, 3), (31, 32)]
    for _ in range(300):
        first = rng.randint(-9_000, 30_000)
        spans.append((first, first + rng.choice((0, 1, 5, 31, 64, 400, 4_000, 12_000))))
    epoch = datetime.date(1970, 1, 1)
    rows = [(epoch + datetime.timedelta(a), epoch + datetime.timedelta(b)) for a, b in spans]
    frame = spark.createDataFrame(rows, "a date, b date")
    found = frame.select(ac._bins(F.col("a"), F.col("b")).alias("bins")).collect()
    for (a, b), row in zip(spans, found):
        bins = [(x.level, x.number) for x in row.bins]
        assert len(bins) <= 2 * ac.BIN_FACTOR * 3 + 4 and len(bins) == len(set(bins))
        for d in {a, b, (a + b) // 2, *(rng.randint(a, b) for _ in range(20))}:
            of_day = {(k, d // (ac.BLOCK_DAYS * ac.BIN_FACTOR**k)) for k in range(ac.BIN_LEVELS)}
            assert len(of_day & set(bins)) == 1


def test_long_gaps_make_few_copies(make_bars):
    bars = make_bars({"T": [(k, 10.0, 1) for k in (1, 2, 3, 4, 5)] + [(4000, 10.0, 900), (8001, 9.0, 1)]})
    odd = score_bars(bars).where("trade_date > '2024-06-01'")
    joined = ac.window_join(odd, bars)
    assert {(r.anomaly_date, r.trade_date) for r in joined.collect()} == {
        (day(4000), day(5)), (day(4000), day(4000)), (day(8001), day(4000)), (day(8001), day(8001)),
    }
    copies = odd.where("prev_date is not null").select(
        F.size(ac._bins(F.col("prev_date"), F.date_add("trade_date", 2))).alias("n")
    )
    assert max(r.n for r in copies.collect()) < 32  # a bin for every 32 days would make 126


# ---- sessions ------------------------------------------------------------------------------


def test_sessions_know_holidays(spark, make_bars):
    # 2024-01-01 is a Monday; the 4th is a holiday of market A, and B trades on Saturdays
    a = {f"A{k}": [(d, 10.0, 1) for d in (1, 2, 3, 5, 8)] for k in range(2)}
    b = {"B0": [(d, 10.0, 1) for d in (1, 2, 3, 4, 5, 6)], "none": [(20, 1.0, 1)]}
    bars = make_bars({**a, **b})
    markets = spark.createDataFrame([("A0", "A"), ("A1", "A"), ("B0", "B")], "ticker string, market string")
    numbered = se.sessions(bars, markets)
    found = {(r.market, r.session_date): r.session_no for r in numbered.collect()}
    assert found == {
        **{("A", day(d)): k for k, d in enumerate((1, 2, 3, 5, 8), 1)},
        **{("B", day(d)): k for k, d in enumerate((1, 2, 3, 4, 5, 6), 1)},
    }
    asofs = spark.createDataFrame([(day(d),) for d in (1, 3, 5, 6, 9, 9, 30)] + [(None,)], "asof_date date")
    windows = {(r.market, r.asof_date): (r.first_day, r.last_day) for r in se.session_windows(numbered, asofs, 1).collect()}
    assert windows == {
        ("A", day(3)): (day(1), day(2)), ("A", day(5)): (day(2), day(3)), ("A", day(6)): (day(3), day(5)),
        ("A", day(9)): (day(5), day(8)), ("A", day(30)): (day(5), day(8)),
        ("B", day(3)): (day(1), day(2)), ("B", day(5)): (day(3), day(4)), ("B", day(6)): (day(4), day(5)),
        ("B", day(9)): (day(5), day(6)), ("B", day(30)): (day(5), day(6)),
    }
    assert se.session_windows(numbered.limit(0), asofs, 1).isEmpty()
    assert se.sessions(bars.limit(0)).isEmpty()
    assert [r.session_date for r in se.sessions(bars).orderBy("session_no").collect()] == [
        day(d) for d in (1, 2, 3, 4, 5, 6, 8, 20)
    ]


def test_lowest_day_may_be_the_day_before_a_holiday(spark, make_bars):
    """On the 5th the latest session is the 3rd; the weekday rule would look for the 4th."""
    bars = make_bars({"T": [(1, 10.0, 1), (2, 9.0, 1), (3, 5.0, 1), (8, 6.0, 1)]})
    asofs = spark.createDataFrame([(day(5),)], "asof_date date")
    windows = se.session_windows(se.sessions(bars), asofs, 2)
    found = window_drops(bars, windows, se.longest_window(windows)).collect()
    assert [(r.ticker, r.min_date, r.max_date, r.diff_perc) for r in found] == [("T", day(3), day(1), 50.0)]
    first, last = crash_period(day(5), 2)
    assert window_crashes(bars, last, first).isEmpty()
    assert re.match(r"\d+", str(se.longest_window(windows)))


def test_spread_bounds_what_a_task_sorts(spark, gappy, tmp_path):
    """The parts were as many as the session's reducers, however many bars there were."""
    gappy.write.parquet(str(tmp_path / "b"))
    bars = spread(spark.read.parquet(str(tmp_path / "b")), 50 * TASK_BARS)
    wide = ac.with_drop_window(bars, 120)
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    assert wide.rdd.getNumPartitions() == 50
    assert spread(bars, 0).count() == gappy.count()
