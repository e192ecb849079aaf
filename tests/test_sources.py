import math
import pathlib

import pytest
from pyspark.sql import functions as F

from conftest import day
from fallscan import schemas
from fallscan.sources import bars as bs
from fallscan.sources import companies as cs
from fallscan.sources import listing as ls
from fallscan.sources import sink

HEADER = "Symbol|Security Name|Market Category|Test Issue|Financial Status|Round Lot Size|ETF|NextShares"
LINES = [
    HEADER,
    "AAAA|First Corp|Q|N|N|100|N|N",
    "BBBB|Second Corp|S|Y|D|100|N|N",
    "",
    "broken|line",
    "File Creation Time: 1231202321:30|||||||",
]


def test_listing_file(spark, tmp_path):
    path = tmp_path / "listing.txt"
    path.write_text("\n".join(LINES) + "\n")
    found = ls.read_listing(spark, str(path))
    assert found.schema == schemas.LISTING
    assert [r.ticker for r in found.orderBy("ticker").collect()] == ["AAAA", "BBBB"]
    first = found.orderBy("ticker").first()
    assert (first.security_name, first.financial_status) == ("First Corp", "100")


def test_listing_file_keeps_what_a_plain_split_keeps(spark, tmp_path):
    path = tmp_path / "listing.txt"
    lines = ["CCCC|No Status|Q|N|N||N|N", 'DDDD|"Quoted" Corp|S|N|N|100|N|N', "EEEE|Six Fields|Q|N|N|100"]
    path.write_text("\n".join([*LINES, *lines]) + "\n")
    found = {r.ticker: r for r in ls.read_listing(spark, str(path)).collect()}
    assert set(found) == {"AAAA", "BBBB", "CCCC", "DDDD", "EEEE"}
    assert found["CCCC"].financial_status == ""
    assert found["DDDD"].security_name == '"Quoted" Corp'
    parsed = spark.createDataFrame([(line,) for line in [*LINES, *lines]], "line string")
    assert {r.ticker for r in ls.parse_listing(parsed, header=HEADER).collect()} == set(found)


def test_load_window_ends_at_the_as_of_day(spark, prices):
    bars = prices({"A": [float(i) for i in range(1, 29)]})
    days = lambda f: sorted(r.trade_date for r in f.collect())
    assert days(bs.load_window(bars, day(10), 3)) == [day(n) for n in (7, 8, 9, 10)]
    # day 15 is a Monday: five weekdays back is the Monday before
    assert days(bs.load_window(bars, day(15), 5, "weekday")) == [day(n) for n in range(8, 16)]
    with pytest.raises(ValueError):
        bs.load_window(bars, day(10), 3, "hour")


def test_one_bar_drops_repeats(spark, prices):
    bars = prices({"A": [1.0, 2.0]})
    other = bars.withColumn("close", bars["close"] - 0.5)
    one = bs.one_bar(bars.union(bars).union(other))
    assert one.exceptAll(bars).isEmpty() and one.count() == 2


def test_listing_lines(spark):
    lines = spark.createDataFrame([(line,) for line in LINES], "line string")
    found = ls.parse_listing(lines, header=HEADER)
    assert found.columns == schemas.LISTING.fieldNames()
    assert sorted(r.ticker for r in found.collect()) == ["AAAA", "BBBB"]


def test_companies(spark):
    raw = spark.createDataFrame(
        [("A", "Alpha", "Healthcare", None), ("B", None, None, "Banks"), ("C", "Gamma", "Energy", "Oil")],
        schemas.COMPANIES,
    )
    info = {r.ticker: tuple(r)[1:] for r in cs.company_info(raw).collect()}
    assert info["A"] == ("Alpha", "Healthcare", "N/A") and info["B"] == ("N/A", "N/A", "Banks")
    assert [r.ticker for r in cs.of_sector(raw, "Healthcare").collect()] == ["A"]
    nothing = cs.of_sector(raw, "Utilities")
    assert nothing.isEmpty() and nothing.columns == schemas.COMPANIES.fieldNames()
    assert cs.of_sector(raw, "N/A").isEmpty()


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_bars_files(spark, prices, tmp_path, fmt):
    bars = prices({"A": [1.0, math.nan, 3.0], "B": [None, 2.0]})
    path = str(tmp_path / fmt)
    bars.write.format(fmt).option("header", True).save(path)
    found = bs.read_bars(spark, path, fmt)
    assert found.columns == schemas.BARS.fieldNames()
    assert found.count() == 5
    assert found.where("adj_close is null").count() == 2
    assert found.where(F.isnan("adj_close")).isEmpty()


def test_load_windows(prices):
    bars = prices({"A": [float(i) for i in range(1, 61)]})
    assert bs.load_window(bars, day(60), 5, "day").count() == 6
    assert bs.load_window(bars, "2024-02-15", 1, "month").agg(F.min("trade_date")).first()[0] == day(15)
    assert bs.between_days(bars, day(3), day(7)).count() == 5


def test_panel(spark):
    panel = spark.createDataFrame(
        [(day(1), 1.0, 10, 5.0), (day(2), 2.0, 20, None)],
        "trade_date date, adj_close__A double, volume__A bigint, `adj_close__B.X` double",
    )
    tickers = bs.panel_tickers(panel)
    assert tickers == ["A", "B.X"]
    rows = {(r.ticker, r.trade_date): r for r in bs.panel_to_long(panel, tickers).collect()}
    assert len(rows) == 4
    assert (rows["A", day(2)].adj_close, rows["A", day(2)].volume) == (2.0, 20)
    assert rows["B.X", day(1)].adj_close == 5.0 and rows["B.X", day(1)].volume is None
    assert rows["B.X", day(2)].adj_close is None and rows["A", day(1)].open is None


def test_batches(prices):
    first = prices({"A": [1.0, 2.0, 3.0], "B": [5.0]}).withColumn("batch", F.lit(1))
    second = prices({"A": [7.0, 8.0]}).withColumn("batch", F.lit(2))
    union = bs.union_batches(second, first)
    assert union.count() == 6
    per_day = {(r.ticker, r.trade_date): r.adj_close for r in bs.one_bar_per_day(union).collect()}
    assert per_day == {
        ("A", day(1)): 7.0, ("A", day(2)): 8.0, ("A", day(3)): 3.0, ("B", day(1)): 5.0,
    }
    per_ticker = {(r.ticker, r.trade_date): r.adj_close for r in bs.latest_batch(union).collect()}
    assert per_ticker == {("A", day(1)): 7.0, ("A", day(2)): 8.0, ("B", day(1)): 5.0}
    widened = bs.union_batches(second.drop("open"), first)
    assert widened.where("open is null").count() == 2


def test_sink_round_trip(spark, prices, tmp_path):
    bars = prices({"A": [float(i) for i in range(1, 61)]})
    path = str(tmp_path / "out")
    sink.write_by_month(bars, path, "trade_date")
    assert sorted(p.name for p in (tmp_path / "out").glob("month=*")) == ["month=2024-01", "month=2024-02"]
    back = sink.read_by_month(spark, path, bars)
    assert back.schema == bars.schema
    assert back.exceptAll(bars).isEmpty() and back.count() == 60


def test_shared_folder_follows_the_session(spark, prices, tmp_path):
    class Session:
        class conf:
            @staticmethod
            def get(key, default=None):
                return {"spark.checkpoint.dir": "/shared/place"}.get(key, default)

    class Unset:
        class conf:
            @staticmethod
            def get(key, default=None):
                return {"spark.sql.warehouse.dir": "/warehouse"}.get(key, default)

    assert sink.shared_folder(Session) == "/shared/place"
    assert sink.fresh_path(Session, "t").startswith("/shared/place/fallscan/t-")
    assert sink.shared_folder(Unset) == "/warehouse/_shared"
    bars = prices({"A": [1.0, 2.0]})
    cut = sink.materialise(bars, str(tmp_path / "work"), "cut")
    assert cut.exceptAll(bars).isEmpty() and cut.count() == 2
    assert cut.inputFiles()
    sink.remove(spark, str(tmp_path / "work"))
    assert not (tmp_path / "work").exists()


# ---- batches that arrive over time ---------------------------------------------------------


def files_of(path):
    return {str(f.relative_to(path)) for f in pathlib.Path(path).rglob("*.parquet")}


def stored(spark, path, like):
    rows = sink.read_by_month(spark, path, like).collect()
    return sorted((r.ticker, r.trade_date, r.adj_close, r.batch) for r in rows)


def test_merge_touches_only_changed_months(spark, make_bars, tmp_path):
    path = str(tmp_path / "bars")

    def batch(name, series):
        return make_bars(series).withColumn("batch", F.lit(name))

    first = batch("1", {"T": [(d, float(d), 1) for d in (1, 2, 40, 70)], "U": [(2, 5.0, 1)]})
    sink.merge_batch(first, path, ["batch"])
    before = files_of(path)
    assert {f.split("/")[0] for f in before} == {"month=2024-01", "month=2024-02", "month=2024-03"}
    sink.merge_batch(first, path, ["batch"])
    assert files_of(path) == before
    second = batch("2", {"T": [(40, 99.0, 1), (41, 1.0, 1)], "V": [(100, 7.0, 1)]})
    sink.merge_batch(second, path, ["batch"])
    after = files_of(path)
    for month in ("month=2024-01", "month=2024-03"):
        assert {f for f in after if f.startswith(month)} == {f for f in before if f.startswith(month)}
    assert not {f for f in after if f.startswith("month=2024-02")} & before
    expected = sorted([
        ("T", day(1), 1.0, "1"), ("T", day(2), 2.0, "1"), ("U", day(2), 5.0, "1"), ("T", day(40), 99.0, "2"),
        ("T", day(41), 1.0, "2"), ("T", day(70), 70.0, "1"), ("V", day(100), 7.0, "2"),
    ])
    assert stored(spark, path, first) == expected
    sink.merge_batch(second, path, ["batch"])
    sink.merge_batch(first, path, ["batch"])  # an older batch that comes again changes nothing
    assert files_of(path) == after and stored(spark, path, first) == expected


def test_merge_without_order_replaces(spark, make_bars, tmp_path):
    path = str(tmp_path / "bars")
    rows = make_bars({"T": [(1, 9.0, 1), (2, 3.0, 1)]}).withColumn("batch", F.lit("x"))
    lower = make_bars({"T": [(1, 1.0, 1)]}).withColumn("batch", F.lit("x"))
    for table in (rows, lower, lower.limit(0), lower.withColumn("trade_date", F.lit(None).cast("date"))):
        sink.merge_batch(table, path)
    assert [r[2] for r in stored(spark, path, rows)] == [1.0, 3.0]
