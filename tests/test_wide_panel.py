"""Wide panels read by chunks of columns."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from conftest import day
from fallscan.schemas import BAR_FIELDS, BARS
from fallscan.sources import wide_panel
from fallscan.sources.bars import panel_tickers, panel_to_long


def stored(folder, columns, days=2):
    """A panel of one file; ``columns`` maps names to a value per day."""
    table = {"trade_date": pa.array([day(n + 1) for n in range(days)], pa.date32())}
    for name, values in columns.items():
        kind = pa.int64() if name.startswith("volume") else pa.float64()
        table[name] = pa.array(values, kind)
    folder.mkdir()
    pq.write_table(pa.table(table), folder / "panel.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def thousands(tmp_path_factory):
    names = [f"K{k:04d}" for k in range(5_000)]
    columns = {
        f"{field}__{name}": [k, k + 1] if field == "volume" else [k + n / 8, None]
        for k, name in enumerate(names)
        for n, field in enumerate(BAR_FIELDS)
    }
    return stored(tmp_path_factory.mktemp("wide") / "panel", columns)


def test_thousands_of_tickers_stay_in_generated_code(spark, thousands):
    bars = wide_panel.read_wide_panel(spark, thousands)
    assert [f.dataType for f in bars.schema] == [f.dataType for f in BARS]
    plan = bars._jdf.queryExecution().executedPlan().toString().splitlines()
    work = [line for line in plan if "Generate explode" in line or "Project [" in line]
    assert len(work) >= 5_000 // wide_panel.CHUNK and all("*(" in line for line in work)
    assert not any("Exchange" in line for line in plan)
    n, volumes, prices = bars.selectExpr("count(*)", "sum(volume)", "sum(adj_close)").first()
    total = sum(range(5_000))
    assert (n, volumes, prices) == (10_000, 2 * total + 5_000, total + 5_000 * 4 / 8)


def test_chunks_read_their_columns_only(spark, thousands):
    columns = wide_panel.stored_columns(spark, thousands)
    widths = [len(schema) for _, schema in wide_panel.chunks(columns)]
    assert max(widths) < wide_panel.MAX_FIELDS
    assert sum(widths) - len(widths) == 5_000 * len(BAR_FIELDS)


@pytest.mark.parametrize("per_chunk", [1, 2, 16])
def test_equals_one_projection(spark, tmp_path, per_chunk):
    path = stored(tmp_path / "panel", {
        "adj_close__A": [1.0, 2.0], "volume__A": [10, None], "adj_close__B.X": [5.0, None],
        "close__C__D": [7.0, 8.0], "adj_close__C__D": [7.5, None], "adj_close__E": [None, None],
        "note": [0.0, 0.0],
    })
    panel = spark.read.parquet(path)
    plain = panel_to_long(panel, panel_tickers(panel))
    found = wide_panel.read_wide_panel(spark, path, per_chunk)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, plain.collect()))
    assert found.count() == 8


def test_volume_alone_and_no_ticker(spark, tmp_path):
    one = wide_panel.read_wide_panel(spark, stored(tmp_path / "one", {"volume__Z": [3, 4]}))
    assert [(r.ticker, r.volume, r.close) for r in one.orderBy("trade_date").collect()] == [
        ("Z", 3, None), ("Z", 4, None),
    ]
    none = wide_panel.read_wide_panel(spark, stored(tmp_path / "none", {"note": [1.0, 2.0]}))
    assert none.isEmpty() and none.columns == BARS.fieldNames()
    empty = wide_panel.read_wide_panel(spark, stored(tmp_path / "empty", {"open__A": []}, 0))
    assert empty.isEmpty()


def test_more_tickers_are_more_rows_not_more_columns(spark, tmp_path):
    names = [f"T{k:05d}" for k in range(1, 1_001)]
    rows = [
        (t, day(d), float(d), float(d), float(d), float(d), k + d / 8, k * d)
        for k, t in enumerate(names) for d in (1, 2, 3) if (k + d) % 3
    ]
    rows += [("lone", day(9), None, None, None, None, None, None), (names[0], None, *[1.0] * 5, 1)]
    bars = spark.createDataFrame(rows, BARS)
    panel = wide_panel.panel_blocks(bars)
    assert len(panel.columns) == 2 + wide_panel.CHUNK * len(BAR_FIELDS)
    assert 1_001 / wide_panel.CHUNK <= panel.count() / 5 <= 2 * 1_001 / wide_panel.CHUNK
    path = str(tmp_path / "blocks")
    panel.write.parquet(path)
    found = wide_panel.read_wide_panel(spark, path)
    assert [f.dataType for f in found.schema] == [f.dataType for f in BARS]
    known = {r[:2]: r for r in rows}
    days = [day(1), day(2), day(3), day(9), None]
    expected = [known.get((t, d), (t, d, *[None] * 6)) for t in [*names, "lone"] for d in days]
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, expected))


def test_blocks_of_no_bars_and_of_few_places(spark, tmp_path, prices):
    wide_panel.panel_blocks(prices({"A": [1.0]}).limit(0)).write.parquet(str(tmp_path / "none"))
    assert wide_panel.read_wide_panel(spark, str(tmp_path / "none")).isEmpty()
    bars = prices({t: [1.0, 2.0] for t in "ABCDE"})
    wide_panel.panel_blocks(bars, per_chunk=2).write.parquet(str(tmp_path / "two"))
    found = wide_panel.read_wide_panel(spark, str(tmp_path / "two"))
    assert sorted(map(repr, found.collect())) == sorted(map(repr, bars.collect()))
