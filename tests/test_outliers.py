import itertools
import math
import os
import random
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import day
from fallscan.functions import depth_kernels
from fallscan.functions.isolation import depth_curves, whole_series
from fallscan.operators.outliers import (
    FOREST, SHORT_SERIES, anomalies, anomaly_counts, isolation_scores, score_bars,
)
from fallscan.operators.series import with_previous_bar


def brute_depth(values):
    """Expected cuts per value, pair by pair, against the distinct values."""
    points = sorted(set(values))
    depths = []
    for x in values:
        i = points.index(x)
        right = sum((points[k + 1] - points[k]) / (points[k + 1] - x) for k in range(i, len(points) - 1))
        left = sum((points[k + 1] - points[k]) / (x - points[k]) for k in range(i))
        depths.append(round(right + left, 6))
    return depths


def brute_depth_by_sample(values, sample):
    points = sorted(set(sample))
    return np.interp(values, points, brute_depth(points))


def simulated_depth(values, trees, seed):
    """Mean depth at which random trees isolate each value."""
    rng = np.random.default_rng(seed)
    total = np.zeros(len(values))
    for _ in range(trees):
        nodes = [np.arange(len(values))]
        while nodes:
            node = nodes.pop()
            if len(node) < 2:
                continue
            total[node] += 1
            x = values[node]
            cut = rng.uniform(x.min(), x.max())
            nodes += [node[x < cut], node[x >= cut]]
    return total / trees


def series_of(values):
    return [(i + 1, 1.0, v) for i, v in enumerate(values)]


@pytest.fixture(scope="module")
def random_series():
    rng = random.Random(7)
    return {f"R{k}": [rng.randint(1, 12) for _ in range(rng.randint(2, 30))] for k in range(12)}


@pytest.fixture(scope="module")
def scored(make_bars, random_series):
    bars = make_bars({t: series_of(v) for t, v in random_series.items()})
    return isolation_scores(bars).orderBy("ticker", "trade_date").toPandas()


def test_depth_equals_brute_force(scored, random_series):
    for ticker, values in random_series.items():
        found = scored[scored.ticker == ticker].isolation_depth.tolist()
        assert found == pytest.approx(brute_depth(values), abs=2e-6)


def test_flag_is_strictly_below_the_percentile(scored, random_series):
    for ticker in random_series:
        rows = scored[scored.ticker == ticker]
        limit = np.percentile(rows.isolation_depth, 10)
        assert rows.is_anomaly.tolist() == [bool(d < limit) for d in rows.isolation_depth]


def test_depth_equals_random_trees():
    values = np.array([1.0, 2.0, 2.5, 4.0, 9.0, 9.5, 10.0, 30.0])
    assert simulated_depth(values, 6000, 3) == pytest.approx(brute_depth(values.tolist()), abs=0.08)


@pytest.mark.parametrize("n", [255, 256, 257, 700])
def test_every_value_counts_at_any_length(make_bars, n):
    rng = random.Random(n)
    values = [rng.randint(1, 100_000) for _ in range(n)]
    bars = make_bars({"L": series_of(values)})
    found = [r.isolation_depth for r in isolation_scores(bars).orderBy("trade_date").collect()]
    assert found == pytest.approx(brute_depth(values), abs=2e-6)


@pytest.mark.parametrize("n", [SHORT_SERIES, SHORT_SERIES + 1])
def test_short_and_long_series_agree(make_bars, n):
    values = [(7919 * k) % 1009 for k in range(1, n + 1)]
    bars = make_bars({"L": series_of(values), "S": series_of(values[:20])})
    split = isolation_scores(bars).orderBy("ticker", "trade_date").collect()
    in_place = isolation_scores(bars, longest=SHORT_SERIES).orderBy("ticker", "trade_date").collect()
    assert split == in_place


@pytest.mark.parametrize(
    "values",
    [
        np.arange(1.0, 3000.0), np.arange(1.0, 3000.0) ** 3, 2.0 ** np.arange(-400, 400),
        np.exp(np.random.default_rng(1).uniform(0, 40, 4000)),
        np.concatenate([np.arange(700.0), 1e12 + np.arange(700.0), [1e300]]),
        np.arange(4097.0), np.arange(8193.0),  # much padding
        -1.0 / np.arange(1.0, 1500.0),
    ],
)
def test_hierarchical_sums_equal_direct_ones(values):
    values = np.unique(values)
    direct = depth_kernels.isolation_depths(values, direct=len(values))
    fast = depth_kernels.isolation_depths(values, direct=1)
    assert np.abs(fast - direct).max() < 1e-9


def test_a_million_values_in_one_series():
    values = np.unique(np.random.default_rng(2).lognormal(10, 2, 1_000_000))
    depths = depth_kernels.isolation_depths(values)
    for k in (0, 1234, 500_000, len(values) - 1):
        x, lo, hi = values[k], values[:-1], values[1:]
        exact = ((hi - lo)[k:] / (hi[k:] - x)).sum() + ((hi - lo)[:k] / (x - lo[:k])).sum()
        assert depths[k] == pytest.approx(exact, abs=1e-9)


def test_a_century_of_days_is_one_array(spark):
    values = spark.range(25_000).selectExpr("'L' AS ticker", "cast(id * id AS double) AS v")
    (row,) = depth_curves(values, "ticker", "v", whole_series()).collect()
    assert len(row.depths) == 25_000


def test_nan_counts_as_null(make_bars):
    values = [10.0, 11.0, None, 12.0, 13.0, 500.0]
    with_null = make_bars({"T": [(k + 1, v, 1) for k, v in enumerate(values)]})
    nan = [(k + 1, math.nan if v is None else v, 1) for k, v in enumerate(values)]
    with_nan = make_bars({"T": nan})
    assert anomalies(with_nan).select("ticker", "trade_date", "isolation_depth").collect() == (
        anomalies(with_null).select("ticker", "trade_date", "isolation_depth").collect()
    )
    scored = [r.isolation_depth for r in score_bars(with_nan).orderBy("trade_date").collect()]
    assert scored[2] is None and None not in scored[:2] + scored[3:]


def test_bars_without_ticker_belong_to_no_series(make_bars):
    bars = make_bars({"T": series_of([1, 2, 3]), None: series_of([1, 2, 3])})
    long = make_bars({None: series_of(range(1, 300)), "L": series_of(range(1, 300))})
    assert {r.ticker for r in score_bars(bars).collect()} == {"T"}
    assert {r.ticker for r in score_bars(long).collect()} == {"L"}


def test_workers_need_no_package(tmp_path):
    """Long series are scored from another folder, without the package on the workers' path."""
    code = f"""
import sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from fallscan.session import local_session
from fallscan.operators.outliers import isolation_scores
spark = local_session("elsewhere", 1, memory="1g")
bars = spark.range(300).selectExpr(
    "'L' AS ticker", "date_add(date'2020-01-01', cast(id AS int)) AS trade_date",
    "cast(id * id AS double) AS adj_close", "1L AS volume")
print("scored", isolation_scores(bars).where("isolation_depth > 0").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "scored 300" in done.stdout, done.stderr[-2000:]


# ---- the forest ----------------------------------------------------------------------------


def brute_path(values, counts, limit, x):
    """Expected path length by recursion over all cuts of one tree."""
    if limit == 0 or len(values) == 1:
        return float(depth_kernels.leaf_correction(sum(counts)))
    total, width = 1.0, values[-1] - values[0]
    for u in range(len(values) - 1):
        lo, hi = values[u], values[u + 1]
        share = (hi - lo) / width
        left = brute_path(values[: u + 1], counts[: u + 1], limit - 1, x)
        right = brute_path(values[u + 1 :], counts[u + 1 :], limit - 1, x)
        goes_left = min(max((hi - x) / (hi - lo), 0.0), 1.0)
        total += share * (goes_left * left + (1 - goes_left) * right)
    return total


@pytest.mark.parametrize("limit", [1, 2, 3, 5])
def test_tree_depths_equal_recursion(limit):
    values, counts = [1.0, 2.0, 2.5, 7.0, 9.0, 9.1, 20.0], [1, 2, 1, 1, 3, 1, 1]
    found = depth_kernels.tree_depths(np.array(values), np.array(counts), limit)
    assert found == pytest.approx([brute_path(values, counts, limit, x) for x in values])


@pytest.mark.parametrize("n, size", [(5, 5), (6, 2), (8, 3), (8, 5), (10, 1), (12, 9)])
def test_forest_equals_average_over_all_samples(n, size):
    rng = random.Random(n * size)
    rows = sorted(float(rng.randint(1, 3 * n)) for _ in range(n))
    limit, total, taken = math.ceil(math.log2(max(size, 2))), np.zeros(len(set(rows))), 0
    for sample in itertools.combinations(rows, size):
        seen = sorted(set(sample))
        counts = [sample.count(v) for v in seen]
        total += [brute_path(seen, counts, limit, x) for x in sorted(set(rows))]
        taken += 1
    found = depth_kernels.forest_depths(np.array(rows), size, math.comb(n, size), 1)
    assert found == pytest.approx(total / taken)


def test_drawn_samples_come_close_to_all():
    rows = np.sort(np.random.default_rng(4).lognormal(0, 1, 14))
    exact = depth_kernels.forest_depths(rows, 7, 10_000, 1)
    drawn = depth_kernels.forest_depths(rows, 7, 400, 1)
    assert np.abs(drawn - exact).max() < 0.15


def test_forest_flags_and_scores(make_bars, random_series):
    bars = make_bars({t: series_of(v) for t, v in random_series.items()})
    rows = isolation_scores(bars, model=FOREST).orderBy("ticker", "trade_date").collect()
    for ticker, values in random_series.items():
        own = [r for r in rows if r.ticker == ticker]
        seen = sorted(set(map(float, values)))
        counts = [values.count(v) for v in seen]
        depth = dict(zip(seen, depth_kernels.tree_depths(np.array(seen), np.array(counts), math.ceil(math.log2(len(values))))))
        assert [r.isolation_depth for r in own] == pytest.approx([depth[v] for v in values], abs=2e-6)
        limit = np.percentile([r.isolation_depth for r in own], 10)
        assert [r.is_anomaly for r in own] == [bool(r.isolation_depth < limit) for r in own]
    with pytest.raises(ValueError):
        score_bars(bars, model="trees")


def test_flat_single_and_empty_series(make_bars):
    bars = make_bars(
        {"flat": series_of([5, 5, 5, 5]), "one": series_of([3]), "none": [(1, None, 4), (2, 1.0, None)]}
    )
    assert anomalies(bars).isEmpty()
    assert {r.ticker for r in isolation_scores(bars).collect()} == {"flat"}
    counts = {r.ticker: (r.n_anomalies, r.n_rows) for r in anomaly_counts(score_bars(bars)).collect()}
    assert counts == {"flat": (0, 4), "one": (0, 1)}


def test_five_distinct_days_have_exactly_one_anomaly(make_bars):
    bars = make_bars({"T": series_of([10, 11, 12, 13, 500])})
    assert [r.trade_date for r in anomalies(bars).collect()] == [day(5)]


def test_previous_bar_skips_unusable_ones(make_bars):
    bars = make_bars({"T": [(1, 10.0, 1), (2, None, 1), (3, 12.0, None), (4, 13.0, 2)]})
    rows = {r.trade_date: r for r in with_previous_bar(bars).collect()}
    assert set(rows) == {day(1), day(4)}
    assert (rows[day(4)].prev_date, rows[day(4)].prev_close) == (day(1), 10.0)
    assert rows[day(1)].prev_date is None


def test_scores_keep_every_bar(make_bars, random_series):
    bars = make_bars({t: series_of(v) for t, v in random_series.items()})
    scored = score_bars(bars.repartition(5).orderBy(F.rand(1)))
    assert scored.select(*bars.columns).exceptAll(bars).isEmpty()
    assert scored.count() == bars.count()
