"""Shards along a Hilbert curve through the metadata of documents.

Four dimensions of a document (language, source, size, id) are quantised to ``BITS`` bits each,
the first three by equal shares of the rows, the id by equal intervals. The
index of the cell on the Hilbert curve (Skilling: Programming the Hilbert curve, 2004) orders
the documents, and the order is cut into runs of equal length. A run covers a compact region in
all dimensions, so files written per shard can be skipped by the minima and maxima of any of
them. Copies of a text from one source lie side by side.

The law is ``rows``: shards differ by one document at most. Positions are exact: documents are
range-partitioned by (index, size, text hash, id), so a cell of any size is spread over tasks,
and the rows before a partition are summed from one count per partition.

Defined cases: null texts have size 1 and hash 0; null metadata sorts first; rows that repeat
are placed one by one; an empty table gives an empty result; with fewer documents than shards
the last shards stay empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from fallscan.llm.common import parts_for, settle, small_side

SHARDS = 16

#: Bits per dimension.
BITS = 5
DIMENSIONS = ("lang", "source", "size", "doc_id")

#: Rows that one sorted partition is sized for.
PART_ROWS = 50_000


def hilbert_index(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Positions on the curve of cells, a row of coordinates below 2^bits for each."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the rotations of the levels above
        p = q - 1
        for k in range(n):
            set_bit = (x[k] & q) != 0
            t = np.where(set_bit, 0, (x[0] ^ x[k]) & p)
            x[0] = np.where(set_bit, x[0] ^ p, x[0] ^ t)
            x[k] = np.where(set_bit & (k == 0), x[k], x[k] ^ t)
        q >>= 1
    for k in range(1, n):  # Gray code
        x[k] ^= x[k - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    index = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for k in range(n):
            index = (index << 1) | ((x[k] >> bit) & 1)
    return index


def described(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, lang, source) of every document, settled."""
    text = F.coalesce("text", F.lit(""))
    columns = {name.lower() for name in docs.columns}
    named = [
        (F.col(name) if name in columns else F.lit(None)).cast("string").alias(name)
        for name in ("lang", "source")
    ]
    return settle(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            *named,
        )
    )


def _shares(rows: DataFrame, value, bits: int) -> DataFrame:
    """(value, coordinate): equal shares of the rows, cut between the distinct values in order.

    The table has a row per distinct value; summing up in order needs them in one task, the
    values alone.
    """
    counts = rows.groupBy(value.alias("_value")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy(F.col("_value").asc_nulls_first())) - F.col("n")
    share = before / F.sum("n").over(Window.partitionBy(F.lit(1)))
    top = 1 << bits
    coordinate = F.least(F.floor(share * top), F.lit(top - 1)).cast("long")
    return settle(counts.select("_value", coordinate.alias("_c")))


def quantised(rows: DataFrame, bits: int = BITS) -> DataFrame:
    """``rows`` with a coordinate c0, c1, ... for each of DIMENSIONS.

    Strings are cut by their order, sizes by eighths of an octave, both into equal shares of the
    rows; ids into equal intervals between their least and largest.
    """
    values = (F.col("lang"), F.col("source"), F.floor(8 * F.log2("size")))
    out = rows
    for k, value in enumerate(values):
        ranks = _shares(rows, value, bits)
        out = (
            out.join(small_side(ranks), value.eqNullSafe(F.col("_value")), "left")
            .withColumnRenamed("_c", f"c{k}")
            .drop("_value")
        )
    least, most = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    span = max((most or 0) - (least or 0) + 1, 1)
    place = F.floor((F.col("doc_id") - (least or 0)).cast("double") * (1 << bits) / float(span))
    return out.withColumn("c3", F.least(F.coalesce(place, F.lit(0)), F.lit((1 << bits) - 1)))


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cells = np.stack(
            [batch.column(f"c{k}").to_numpy() for k in range(len(DIMENSIONS))], axis=1
        )
        kept = batch.select(["doc_id", "size", "text_crc32"])
        yield kept.append_column("position", pa.array(hilbert_index(cells), pa.int64()))


def with_position(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, position): the place of each document on the curve."""
    cells = quantised(described(docs)).drop("lang", "source")
    return cells.mapInArrow(_indexed, "doc_id long, size long, text_crc32 long, position long")


def shards(docs: DataFrame, n_shards: int = SHARDS) -> DataFrame:
    """Per document: doc_id, size, text_crc32, law, shard, slot, grown_shard, position."""
    keys = ["position", "size", "text_crc32", "doc_id"]
    placed = settle(with_position(docs))
    parts = parts_for(docs.sparkSession, placed.count(), PART_ROWS)
    ordered = settle(
        placed.repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("at", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("at", 33))
        .withColumn("inside", F.col("at").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("at")
    )
    # one row per partition
    counts = ordered.groupBy("part").agg(F.count("*").alias("n"))
    total = Window.partitionBy(F.lit(1))
    offsets = settle(
        counts.select(
            F.col("part").alias("of"),
            (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"),
            F.sum("n").over(total).alias("total"),
        )
    )
    rank = F.col("before") + F.col("inside")
    short, longer = F.floor(F.col("total") / n_shards), F.col("total") % n_shards
    split = longer * (short + 1)  # the first shards have a row more
    in_longer = rank < split
    shard = F.when(in_longer, F.floor(rank / (short + 1))).otherwise(
        longer + F.floor((rank - split) / F.greatest(short, F.lit(1)))
    )
    slot = F.when(in_longer, rank % (short + 1)).otherwise(
        (rank - split) % F.greatest(short, F.lit(1))
    )
    return ordered.join(small_side(offsets), F.col("part") == F.col("of")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        shard.cast("int").alias("shard"),
        slot.cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "position",
    )


def write_shards(docs: DataFrame, path: str, n_shards: int = SHARDS) -> None:
    """One folder of Parquet files per shard, each sorted along the curve; doc_id must be unique."""
    placed = shards(docs, n_shards).select(F.col("doc_id").alias("__id"), "shard", "slot")
    mine = docs["doc_id"].cast("long").eqNullSafe(F.col("__id"))
    (
        docs.join(placed, mine)
        .drop("__id")
        .repartition("shard", F.floor(F.col("slot") / PART_ROWS))
        .sortWithinPartitions("shard", "slot")
        .drop("slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
