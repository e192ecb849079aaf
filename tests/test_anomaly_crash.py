import datetime
import random

import pytest
from pyspark.sql import functions as F

from conftest import day
from fallscan.operators import anomaly_crash as ac
from fallscan.operators.outliers import score_bars
from fallscan.operators.report import anomaly_chart_series, anomaly_step_stats, collate

# A volume spike on the given day makes it the one outlier of a five-day series.
ODD = 1000


def crashes(bars, **kwargs):
    return {(r.ticker, r.crash_date): r for r in ac.anomaly_crashes(bars, **kwargs).collect()}


def spiked(values, odd, start=1):
    return [(start + i, p, ODD if i + 1 == odd else 10 + i) for i, p in enumerate(values)]


def test_published_layout(make_bars):
    bars = make_bars({"T": spiked([100.0, 99.0, 98.0, 50.0, 55.0], odd=4)})
    frame = ac.anomaly_crashes(bars)
    assert frame.columns == ac.CRASH_FIELDS
    (row,) = frame.collect()
    assert row.crash_date == day(4) and row.crash_volume == ODD
    assert row.crash_volume_close == 50.0 * ODD
    assert (row.precrash_date, row.precrash_close) == (day(3), 98.0)
    assert row.precrash_close_diff == -48.0
    assert row.period_end_date == day(6)
    assert row.period_percent_max_diff == (50.0 - 98.0) / 98.0 * 100
    assert (row.min_value_date, row.min_close) == (day(4), 50.0)


def test_outlier_on_the_first_bar_is_dropped(make_bars):
    assert crashes(make_bars({"T": spiked([100.0, 10.0, 10.0, 10.0, 10.0], odd=1)})) == {}


def test_outlier_on_the_last_bar_is_kept(make_bars):
    found = crashes(make_bars({"T": spiked([100.0, 100.0, 100.0, 100.0, 60.0], odd=5)}))
    assert set(found) == {("T", day(5))}


def test_weekend_hides_a_later_fall(make_bars):
    # day 5 is a Friday, day 8 the Monday after
    points = [(1, 100.0, 10), (2, 100.0, 11), (3, 100.0, 12), (5, 100.0, ODD), (8, 50.0, 14)]
    assert crashes(make_bars({"T": points})) == {}
    assert set(crashes(make_bars({"T": points}), days_after=3)) == {("T", day(5))}


def test_rise_is_no_crash(make_bars):
    assert crashes(make_bars({"T": spiked([50.0, 60.0, 70.0, 100.0, 110.0], odd=4)})) == {}


def test_exactly_at_the_threshold(make_bars):
    assert crashes(make_bars({"T": spiked([100.0, 100.0, 100.0, 70.0, 80.0], odd=4)}))
    assert not crashes(make_bars({"T": spiked([100.0, 100.0, 100.0, 70.01, 80.0], odd=4)}))


def test_ties_take_the_earliest_day(make_bars):
    found = crashes(make_bars({"T": spiked([90.0, 90.0, 90.0, 50.0, 50.0], odd=4)}))
    assert found["T", day(4)].min_value_date == day(4)


def test_mixed_price_bases(make_bars):
    points = [(1, 99.0, 9), (2, 99.0, 10), (3, 100.0, 11), (4, 60.0, ODD, 90.0), (5, 61.0, 13)]
    mixed = crashes(make_bars({"T": points}))["T", day(4)]
    assert mixed.precrash_close_diff == 90.0 - 100.0
    same = crashes(make_bars({"T": points}), price_col="adj_close")["T", day(4)]
    assert same.precrash_close_diff == 60.0 - 100.0


def test_zero_prices_do_not_fail(make_bars):
    assert crashes(make_bars({"T": spiked([0.0] * 5, odd=4)})) == {}


def test_recent(make_bars):
    bars = make_bars({"T": spiked([100.0, 99.0, 98.0, 50.0, 55.0], odd=4)})
    found = ac.anomaly_crashes(bars)
    assert ac.recent_crashes(found, day(6), 2).count() == 1
    assert ac.recent_crashes(found, day(7), 2).count() == 0
    assert ac.recent_crashes(found, day(3), 2).count() == 0
    flagged = ac.only_recent(ac.flag_drops(bars), day(7), 2)
    assert flagged.count() == bars.count() and ac.crash_rows(flagged).isEmpty()


@pytest.fixture(scope="module")
def ragged(make_bars):
    """Series with missing days, prices and volumes, and long pauses."""
    rng = random.Random(3)
    series = {}
    for k in range(25):
        n, points = rng.choice([1, 500]), []
        for _ in range(rng.randint(1, 40)):
            n += rng.choice([1, 1, 1, 2, 3, 70])
            price = rng.choice([None, 10.0, 20.0, 30.0, rng.uniform(1, 100)])
            points.append((n, price, rng.choice([None, None, 1, 5, 50])))
        series[f"R{k}"] = points
    return make_bars(series), series


def brute_windows(points, days_after):
    """Windows of the usable bars of one series, by looking at every bar."""
    usable = [(n, p) for n, p, v in points if p is not None and v is not None]
    found = {}
    for (before, _), (n, _) in zip(usable, usable[1:]):
        inside = [(p, m) for m, p, _ in points if p is not None and before <= m <= n + days_after]
        low = min(inside)
        high = min((-p, m) for p, m in inside)
        found[day(n)] = (day(low[1]), low[0], day(high[1]), low[0] + high[0])
    return found


@pytest.mark.parametrize("days_after", [0, 2, 9])
def test_windows_equal_brute_force_and_join(ragged, days_after):
    bars, series = ragged
    windows = ac.with_drop_window(bars, days_after).where("min_close is not null")
    joined = ac.joined_drops(
        ac.window_join(score_bars(bars).where("volume_close is not null"), bars, days_after)
    )
    fields = ["min_value_date", "min_close", "max_value_date", "period_max_diff"]
    by_window = {(r.ticker, r.trade_date): tuple(r[f] for f in fields) for r in windows.collect()}
    by_join = {(r.ticker, r.anomaly_date): tuple(r[f] for f in fields) for r in joined.collect()}
    brute = {
        (t, d): v for t, points in series.items() for d, v in brute_windows(points, days_after).items()
    }
    assert by_window == brute
    assert by_join == brute


@pytest.mark.parametrize("block_days", [1, 7, 4000])
def test_block_size_does_not_change_the_join(ragged, block_days):
    bars, _ = ragged
    odd = score_bars(bars).where("is_anomaly")
    default = ac.window_join(odd, bars)
    other = ac.window_join(odd, bars, block_days=block_days)
    assert default.exceptAll(other).isEmpty() and other.exceptAll(default).isEmpty()


def test_close_list(make_bars):
    bars = make_bars({"T": spiked([100.0, 99.0, 98.0, 50.0, 55.0], odd=4)})
    joined = ac.window_join(score_bars(bars).where("is_anomaly"), bars)
    rows = sorted((r.position, r.anomaly_date, r.close) for r in ac.window_close_list(joined).collect())
    assert rows == [(0, day(4), 98.0), (1, day(4), 50.0), (2, day(4), 55.0)]


def test_report_tables(make_bars):
    bars = make_bars(
        {
            "T": spiked([100.0, 99.0, 98.0, 50.0, 55.0], odd=4),
            "calm": spiked([10.0, 10.0, 10.0, 10.0, 10.0], odd=2),
            "flat": [(i, 1.0, 1) for i in range(1, 6)],
            "none": [(1, None, 1)],
        }
    )
    flagged = ac.flag_drops(bars)
    stats = {r.stat: tuple(r)[1:] for r in anomaly_step_stats(flagged).collect()}
    assert stats == {
        "data_download": (3, 1, 4), "anomalies_detected": (2, 1, 3), "crashes_detected": (1, 2, 3),
    }
    points = anomaly_chart_series(flagged).collect()
    assert {p.title for p in points} == {"T Crash Detection"}
    assert [(p.x, p.y) for p in points if p.series == "Crash"] == [(day(4), 50.0)]
    assert sum(p.series == "Adj Close" for p in points) == 5
    collated = collate(bars, ac.crash_rows(flagged))
    assert collated.count() == bars.count()
    assert [r.trade_date for r in collated.where("crash_date is not null").collect()] == [day(4)]


def test_bars_before_1970(make_bars, spark):
    old = make_bars({"T": spiked([100.0, 99.0, 98.0, 50.0, 55.0], odd=4)}).withColumn(
        "trade_date", F.date_sub("trade_date", 366 * 60)
    )
    odd = score_bars(old).where("is_anomaly")
    assert ac.window_join(odd, old).count() == 3
    assert ac.anomaly_crashes(old).first().crash_date < datetime.date(1970, 1, 1)
