import pytest
from pyspark.sql import functions as F

from conftest import day
from fallscan import schemas
from fallscan.plans.reports import (
    OutlierParams, WindowParams, outlier_report, window_report, write_report,
)

ASOF = day(10)  # a Wednesday; the window is days 2 to 9


@pytest.fixture(scope="module")
def market(spark, prices):
    bars = prices(
        {
            "A": [100.0] * 8 + [50.0],
            "B": [100.0] * 8 + [90.0],
            "C": [100.0] * 8 + [40.0],
            "D": [None] * 9,
        }
    )
    # the last day carries the unusual volume
    bars = bars.withColumn(
        "volume", F.when(F.col("trade_date") == day(9), 900).otherwise(F.day("trade_date")).cast("bigint")
    )
    companies = spark.createDataFrame(
        [("A", "Alpha", "Healthcare", "Drugs"), ("B", "Beta", "Healthcare", None),
         ("C", "Gamma", "Energy", "Oil"), ("D", "Delta", "Healthcare", "Drugs"),
         ("E", "Epsilon", "Healthcare", "Drugs")],
        schemas.COMPANIES,
    )
    return companies.select("ticker"), companies, bars


def test_window_report(market, spark, tmp_path):
    tables = window_report(*market, ASOF, str(tmp_path / "work"))
    stats = {r.stat: tuple(r)[1:] for r in tables["stats"].collect()}
    assert stats == {"data_download": (2, 1, 3), "crashes_detected": (1, 1, 2)}
    assert {r.ticker for r in tables["crashes"].collect()} == {"A"}
    assert [r.ticker for r in tables["companies"].collect()] == ["A"]
    assert [(r.x, r.y) for r in tables["chart"].where("series = 'Crash'").collect()] == [(day(9), 50.0)]
    n_crashes = tables["crashes"].count()
    write_report(tables, str(tmp_path / "report"), str(tmp_path / "work"))
    assert not (tmp_path / "work").exists()
    assert sorted(p.name for p in (tmp_path / "report").iterdir()) == sorted(tables)
    assert spark.read.parquet(str(tmp_path / "report" / "crashes")).count() == n_crashes


def test_window_report_of_a_sector_and_some_tickers(market, tmp_path):
    tables = window_report(*market, ASOF, str(tmp_path / "a"), WindowParams(sector="Energy"))
    assert {r.ticker for r in tables["crashes"].collect()} == {"C"}
    some = market[0].where("ticker = 'A'")
    tables = window_report(some, *market[1:], ASOF, str(tmp_path / "b"), WindowParams(sector="Energy"))
    assert tables["crashes"].isEmpty() and tables["companies"].isEmpty()


def rows_of(table):
    return sorted(map(repr, table.collect()))


def test_bars_after_the_as_of_day_and_repeats_change_nothing(market, tmp_path):
    listing, companies, bars = market
    later = bars.withColumn("trade_date", F.date_add("trade_date", 30)).withColumn(
        "adj_close", F.lit(1.0)
    )
    more = bars.union(later).union(bars)
    for k, make in enumerate(
        (
            lambda b, w: window_report(listing, companies, b, ASOF, w),
            lambda b, w: outlier_report(listing, b, ASOF, w),
        )
    ):
        plain, other = make(bars, str(tmp_path / f"{k}a")), make(more, str(tmp_path / f"{k}b"))
        for name in plain:
            assert rows_of(plain[name]) == rows_of(other[name]), name


def test_outlier_report(market, tmp_path):
    listing, _, bars = market
    tables = outlier_report(listing, bars, ASOF, str(tmp_path / "a"))
    assert {r.ticker for r in tables["crashes"].collect()} == {"A", "C"}
    stats = {r.stat: tuple(r)[1:] for r in tables["stats"].collect()}
    assert stats["data_download"] == (3, 1, 4)
    assert stats["crashes_detected"] == (2, 1, 3)
    assert tables["collated"].where("crash_date is not null").count() == 2
    old = outlier_report(
        listing, bars, day(12), str(tmp_path / "b"), OutlierParams(max_days_in_past=2)
    )
    assert old["crashes"].isEmpty()
    assert {r.stat: r.passed for r in old["stats"].collect()}["crashes_detected"] == 0
