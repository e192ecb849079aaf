import pytest

from fallscan.operators import keys, quality


@pytest.fixture(scope="module")
def listing(spark):
    return spark.createDataFrame([(f"K{i:03d}",) for i in reversed(range(300))], "ticker string")


def names(frame):
    return [r.ticker for r in frame.collect()]


def test_first_and_slice(listing):
    assert names(keys.first_tickers(listing, 3)) == ["K000", "K001", "K002"]
    assert names(keys.first_tickers(listing, 40, 200)) == [f"K{i}" for i in range(200, 240)]
    assert names(keys.first_tickers(listing, 40, 290)) == [f"K{i}" for i in range(290, 300)]


def test_extra_ticker(spark, listing):
    first = keys.first_tickers(listing, 2)
    assert sorted(names(keys.with_ticker(spark, first, "X"))) == ["K000", "K001", "X"]
    assert sorted(names(keys.with_ticker(spark, first, "K001"))) == ["K000", "K001"]


def test_missing(listing, prices):
    bars = prices({"K001": [1.0, 2.0], "K007": [None]})
    missing = names(keys.missing_tickers(listing, bars))
    assert len(missing) == 298 and "K007" not in missing
    assert sorted(names(keys.of_tickers(listing, bars))) == ["K001", "K007"]


def test_runs(spark):
    runs = spark.createDataFrame(
        [(0, "A"), (1, "A"), (2, "A"), (0, "B"), (2, "B"), (1, "C")], "run_id int, ticker string"
    )
    found = {r.ticker: (r.n_runs, r.is_stable) for r in keys.load_stability(runs).collect()}
    assert found == {"A": (3, True), "B": (2, False), "C": (1, False)}
    assert names(keys.only_in_first(runs, 0, 1)) == ["B"]
    assert sorted(names(keys.in_both(runs, 0, 2))) == ["A", "B"]


def test_quality(prices):
    bars = prices({"ok": [1.0, None, 2.0], "one": [1.0, None], "none": [None, None]})
    found = {r.ticker: (r.n_bars, r.n_valid, r.is_usable) for r in quality.ticker_quality(bars).collect()}
    assert found == {"ok": (3, 2, True), "one": (2, 1, False), "none": (2, 0, False)}
    assert names(quality.all_null_tickers(bars)) == ["none"]
    assert set(names(quality.usable_bars(bars))) == {"ok"}
    assert set(names(quality.usable_bars(bars, quality.MIN_BARS_OUTLIER))) == {"ok", "one"}
    assert quality.usable_bars(bars).count() == 3
    assert quality.complete_bars(bars).count() == 3
