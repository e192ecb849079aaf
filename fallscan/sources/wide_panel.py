"""Stored wide panels of thousands of tickers, turned into bars by chunks of columns.

A panel comes in one of two layouts. The first has a column ``<field>__<ticker>`` for every field and ticker and a row per day. A single
projection over all of them has tens of thousands of expressions and falls out of code
generation. Here the tickers are cut into chunks whose columns fit generated code. Each chunk is
a scan of its own with its own schema, so it reads its columns and no others, no plan node
ever holds the whole width, and chunks run side by side. Nothing is shuffled. Every chunk reads
the footers of the whole width, though, so its cost grows with the square of the tickers.

The second layout (``panel_blocks``) has no such growth: the panel is cut into blocks of 16 tickers,
a row per block and day. Its columns are ``<field>__<place>`` for the places of a block, and
``_tickers`` names who has them. More tickers are more rows, never more columns, and
the whole panel is one scan.

Defined cases: a field the panel lacks for a ticker is null; a ticker needs one field only; no
ticker gives no rows; a ticker may contain the separator, since fields are matched by name;
columns that are no field of a ticker are ignored. Column names are compared as they are
written, so the session must not fold their case where tickers differ by case alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import DateType, StructField, StructType

from fallscan.schemas import BAR_FIELDS, BARS
from fallscan.sources.bars import panel_to_long

#: Fields a generated stage may have; the session's ``spark.sql.codegen.maxFields`` is 100.
MAX_FIELDS = 100

#: Six fields of so many tickers and the day stay below it.
CHUNK = (MAX_FIELDS - 1) // len(BAR_FIELDS)

#: Names the tickers of a block by place; only panels in blocks have it.
PLACES = "_tickers"

#: Tickers that are numbered in one group, on average. It affects speed only.
GROUP = 16 * CHUNK


def panel_blocks(bars: DataFrame, per_chunk: int = CHUNK, separator: str = "__") -> DataFrame:
    """The wide panel of ``bars`` in blocks: all tickers, for every day that any of them has.

    ``bars`` has at most one row per ticker and day, and every row has a ticker. Counts the
    tickers in a job of its own. The list of days is the one thing that is collected; a calendar
    bounds it.
    """
    tickers = bars.select("ticker").distinct()
    groups = math.ceil(tickers.count() / GROUP) or 1
    numbered = Window.partitionBy("_group").orderBy("ticker")
    number = F.row_number().over(numbered) - 1
    placed = tickers.withColumn("_group", F.pmod(F.hash("ticker"), F.lit(groups))).select(
        "ticker", "_group", F.floor(number / per_chunk).alias("_block"),
        (number % per_chunk).alias("_place"),
    )
    names = F.transform(
        F.array_sort(F.collect_list(F.struct("_place", "ticker"))), lambda e: e.ticker
    )
    # a struct around the day, since a set keeps no null
    days = bars.agg(F.collect_set(F.struct("trade_date")).alias("days")).scalar()
    blocks = placed.groupBy("_group", "_block").agg(names.alias(PLACES))
    rows = blocks.withColumn("_day", F.explode(days)).select(
        "_group", "_block", PLACES, "_day.trade_date"
    )
    cells = [
        F.max(F.when(F.col("_place") == k, F.col(f))).alias(f"{f}{separator}{k}")
        for k in range(per_chunk)
        for f in BAR_FIELDS
    ]
    filled = bars.join(placed, "ticker").groupBy("_group", "_block", "trade_date").agg(*cells)
    same = F.col("r._group") == F.col("f._group")
    same &= F.col("r._block") == F.col("f._block")
    same &= F.col("r.trade_date").eqNullSafe(F.col("f.trade_date"))
    kept = [F.col(f"f.{f}{separator}{k}") for k in range(per_chunk) for f in BAR_FIELDS]
    joined = rows.alias("r").join(filled.alias("f"), same, "left")
    return joined.select("r.trade_date", f"r.{PLACES}", *kept)


def stored_columns(spark: SparkSession, path: str) -> dict[str, StructField]:
    """The panel's columns by name, from its files' footers."""
    return {field.name: field for field in spark.read.parquet(path).schema.fields}


def tickers_of(columns: dict[str, StructField], separator: str = "__") -> list[str]:
    """All tickers that have a column of any field, in order."""
    found = set()
    for field in BAR_FIELDS:
        prefix = field + separator
        found |= {name[len(prefix):] for name in columns if name.startswith(prefix)}
    return sorted(found)


def chunks(
    columns: dict[str, StructField], per_chunk: int = CHUNK, separator: str = "__"
) -> Iterator[tuple[list[str], StructType]]:
    """Tickers and the schema that reads them, a chunk after the other."""
    tickers = tickers_of(columns, separator)
    for start in range(0, len(tickers), per_chunk):
        some = tickers[start : start + per_chunk]
        names = [f"{field}{separator}{t}" for t in some for field in BAR_FIELDS]
        fields = [columns[name] for name in names if name in columns]
        yield some, StructType([StructField("trade_date", DateType()), *fields])


def read_wide_panel(
    spark: SparkSession, path: str, per_chunk: int = CHUNK, separator: str = "__"
) -> DataFrame:
    """Bars of the panel below ``path`` (Parquet), a row per ticker and stored day."""
    columns = stored_columns(spark, path)
    if PLACES in columns:
        return _read_blocks(spark, path, columns, separator)
    parts = [
        panel_to_long(spark.read.schema(schema).parquet(path), some, separator)
        for some, schema in chunks(columns, per_chunk, separator)
    ]
    if not parts:
        return spark.createDataFrame([], BARS)
    while len(parts) > 1:  # pairs, so that the plan stays shallow however many chunks there are
        parts = [_union(*parts[k : k + 2]) for k in range(0, len(parts), 2)]
    return parts[0]


def _read_blocks(
    spark: SparkSession, path: str, columns: dict[str, StructField], separator: str
) -> DataFrame:
    panel = spark.read.schema(StructType(list(columns.values()))).parquet(path)
    bars = panel_to_long(
        panel, tickers_of(columns, separator), separator, lambda place: F.get(PLACES, F.lit(int(place)))
    )
    return bars.where(F.col("ticker").isNotNull())  # places of a block that nobody has


def _union(first: DataFrame, second: DataFrame | None = None) -> DataFrame:
    return first if second is None else first.union(second)
