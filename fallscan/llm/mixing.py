"""Mixing sources to target weights by entropy balancing.

Every document gets a rate: how many times the mix takes it on average. Among all rates between
0 and ``MAX_REPEAT`` that meet the token constraints, sum of rate * size = target of the source,
entropy balancing takes those with the least relative entropy to one copy of each document
(Hainmueller: Entropy Balancing for Causal Effects, 2012). Its convex dual has one multiplier
per source, and the rates are exponential tilts ``min(MAX_REPEAT, exp(lambda * size / mean))``.
Newton iterations, safeguarded by bisection, solve it; each is one aggregation over a table of
(source, size) counts, not over documents.

Rates depend on source and size alone, hence documents of one source and size form a *cell*.
The tokens owed by rounding are carried from cell to cell, from large sizes to small ones, and
each cell gets a whole number of copies, which its documents share by the hash of their ids. A
source so misses its target by about half its smallest size at most, unless its few documents
leave nothing to correct with. Cells are cut into parts by a hash, and each part gets its share
of the cell's copies, so that no source, size or group of copies meets in one task; what meets
is a source's distinct sizes, which the longest text bounds, and a cell's parts.

Targets: the sources by code point, null last, weigh 3, 1, 2 and so on; they share ``SHARE``
times all tokens, a target stops at ``MAX_REPEAT`` times its source's tokens, and the excess is
shared again by weight.

Defined cases: null texts and texts without words have size 0 and are never taken; null is a
source of its own; rows that repeat a doc_id are rows of their own here and alike in ``mixed``;
an empty table gives an empty result. The result depends on the rows only, not on their order.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from fallscan.llm.common import WORD, free_names, settle, small_side

# Fixed values of the mixture: weights in turn, share of all tokens, most copies of a document.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_REPEAT = 2

#: Rows that one part of a cell is sized for.
PART_ROWS = 20_000

#: Relative miss of a target at which the iterations end, and their largest number.
TOLERANCE = 1e-9
MAX_STEPS = 60


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, row_no, source, size, part) of every document, settled."""
    rows = settle(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.monotonically_increasing_id().alias("row_no"),
            F.col("source").cast("string").alias("source"),
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        )
    )
    parts = math.ceil(rows.count() / PART_ROWS) or 1
    return rows.withColumn(
        "part", F.pmod(F.xxhash64("doc_id", "row_no"), F.lit(parts)).cast("int")
    )


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE) -> DataFrame:
    """(source, source_size, target) from rows with (source, size), settled.

    The table has a row per source; ranking it needs them in one task, the sources alone.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    table = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("rank", F.row_number().over(order) - 1)
        .withColumn("weight", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int")))
        .withColumn("cap", MAX_REPEAT * F.col("source_size").cast("double"))
    )
    # Level L with sum of min(cap, weight * L) = share * total: sources reach their caps in the
    # order of cap / weight, so the level follows from running sums in that order.
    by_level = Window.orderBy("level", "rank")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    table = table.withColumn("level", F.col("cap") / F.col("weight"))
    total = share * F.sum("source_size").over(everything)
    free = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    owed = total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    table = table.withColumn("reach", owed / free)
    # the first source in this order whose cap the level does not reach fixes the level
    uncapped = F.when(F.col("reach") <= F.col("level"), F.struct("level", "rank", "reach"))
    table = table.withColumn("at", F.min(uncapped).over(everything)["reach"])
    target = F.least("cap", F.col("weight") * F.coalesce("at", "level"))
    return settle(table.select("source", "source_size", target.alias("target")))


def balance(cells: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, mean, multiplier): the solved dual, from (source, size, n) counts; settled.

    A Newton step for all sources at once is one aggregation. A multiplier stays between the
    largest one found too small and the smallest found too large.
    """
    sums = cells.where("size > 0").groupBy("source").agg(
        (F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"),
    )
    dual = settle(
        targets.join(sums, targets["source"].eqNullSafe(sums["source"]))
        .select(
            targets["source"], "mean", "target",
            F.lit(0.0).alias("multiplier"), F.lit(None).cast("double").alias("low"),
            F.lit(None).cast("double").alias("high"),
            (F.col("target") >= MAX_REPEAT * F.col("source_size")).alias("full"),
            F.lit(1.0).alias("miss"),
        )
    )
    for _ in range(MAX_STEPS):
        here = cells.join(dual, cells["source"].eqNullSafe(dual["source"])).select(
            cells["source"], "size", "n", "mean", "target", "multiplier", "low", "high", "full"
        )
        tilt = F.exp(F.least(F.lit(50.0), F.col("multiplier") * F.col("size") / F.col("mean")))
        mass = F.col("size") * F.col("n")
        inside = tilt < MAX_REPEAT
        gradient = (
            here.groupBy("source", "mean", "target", "multiplier", "low", "high", "full").agg(
                F.sum(F.least(tilt, F.lit(float(MAX_REPEAT))) * mass).alias("taken"),
                F.sum(F.when(inside, tilt * mass * F.col("size") / F.col("mean"))).alias("slope"),
            )
        )
        short = F.col("taken") < F.col("target")
        low = F.when(short, F.greatest("low", "multiplier")).otherwise(F.col("low"))
        high = F.when(short, F.col("high")).otherwise(F.least("high", "multiplier"))
        bounded = gradient.select(
            "source", "mean", "target", "full", "multiplier", low.alias("low"), high.alias("high"),
            (F.col("multiplier") + (F.col("target") - F.col("taken")) / F.col("slope")).alias("newton"),
            F.when(F.col("full"), 0.0)
            .otherwise(F.abs(F.col("taken") - F.col("target")) / F.greatest("target", F.lit(1.0)))
            .alias("miss"),
        )
        middle = (
            F.when(F.col("low").isNull(), F.col("high") - 4.0)
            .when(F.col("high").isNull(), F.col("low") + 4.0)
            .otherwise((F.col("low") + F.col("high")) / 2)
        )
        fits = (
            F.col("newton").isNotNull()
            & (F.col("low").isNull() | (F.col("newton") > F.col("low")))
            & (F.col("high").isNull() | (F.col("newton") < F.col("high")))
            & (F.abs(F.col("newton") - F.col("multiplier")) < 8.0)
        )
        solved = F.col("miss") <= TOLERANCE
        step = F.when(solved, F.col("multiplier")).when(fits, F.col("newton")).otherwise(middle)
        dual = settle(
            bounded.select(
                "source", "mean", "target", step.alias("multiplier"), "low", "high", "full", "miss"
            )
        )
        if (dual.agg(F.max("miss")).first()[0] or 0.0) <= TOLERANCE:
            break
    return dual.select("source", "mean", "multiplier", "full")


def _round_cells(key, cells):
    """Whole copies per cell: what rounding owes is carried to the next smaller size."""
    cells = cells.sort_values("size", ascending=False)
    copies, carried = [], 0.0
    for size, n, rate in zip(cells["size"], cells["n"], cells["rate"]):
        owed = rate * n * size + carried
        whole = min(max(int(owed / size + 0.5), 0), MAX_REPEAT * int(n))
        carried = owed - whole * size
        copies.append(whole)
    return cells.assign(copies=pd.Series(copies, cells.index, dtype="int64"))[
        ["source", "size", "n", "copies"]
    ]


def rates(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, size, n, rate): the tilted rates by source and size, settled."""
    cells = settle(rows.groupBy("source", "size").agg(F.count("*").alias("n")))
    dual = balance(cells, targets)
    tilt = F.exp(F.least(F.lit(50.0), F.col("multiplier") * F.col("size") / F.col("mean")))
    rate = F.when(F.col("full"), F.lit(float(MAX_REPEAT))).otherwise(
        F.least(tilt, F.lit(float(MAX_REPEAT)))
    )
    return settle(
        cells.where("size > 0")
        .join(dual, cells["source"].eqNullSafe(dual["source"]))
        .select(cells["source"], "size", "n", rate.alias("rate"))
    )


def mix(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, size, source_size, target, copies, taken."""
    return _mix(docs).drop("row_no")


def _mix(docs: DataFrame) -> DataFrame:
    rows = sized(docs)
    targets = source_targets(rows)
    rounded = (
        rates(rows, targets)
        .groupBy("source")
        .applyInPandas(_round_cells, "source string, size long, n long, copies long")
    )
    parts = (
        rows.where("size > 0")
        .groupBy(F.col("source").alias("s"), F.col("size").alias("z"), F.col("part").alias("p"))
        .agg(F.count("*").alias("rows"))
    )
    same_cell = parts["s"].eqNullSafe(rounded["source"]) & (parts["z"] == rounded["size"])
    by_part = Window.partitionBy("s", "z").orderBy("p")
    up_to = "cast(cast({} as decimal(19, 0)) * copies div n as bigint)"
    per_part = settle(
        parts.join(rounded, same_cell)
        .withColumn("upto", F.sum("rows").over(by_part))
        .select(
            "s", "z", "p", "rows",
            F.expr(f"{up_to.format('upto')} - {up_to.format('(upto - rows)')}").alias("all"),
        )
    )
    # The documents of a part share its copies: each takes copies // rows, and the first
    # copies % rows of them, in the order of a hash, one more.
    order = Window.partitionBy("source", "size", "part").orderBy(
        F.xxhash64("doc_id", F.lit(29)), "doc_id", "row_no"
    )
    placed = rows.where("size > 0").withColumn("place", F.row_number().over(order))
    in_part = (
        placed["source"].eqNullSafe(per_part["s"])
        & (placed["size"] == per_part["z"])
        & (placed["part"] == per_part["p"])
    )
    copies = F.floor(F.col("all") / F.col("rows")) + (
        F.col("place") <= F.col("all") % F.col("rows")
    ).cast("long")
    counted = placed.join(per_part, in_part).select(
        "doc_id", "row_no", "source", "size", copies.alias("copies")
    )
    blank = rows.where("size = 0").select(
        "doc_id", "row_no", "source", "size", F.lit(0).cast("long").alias("copies")
    )
    every = counted.unionByName(blank)
    named = targets.withColumnRenamed("source", "of")
    return every.join(named, every["source"].eqNullSafe(named["of"]), "left").select(
        "doc_id",
        "row_no",
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mixed(docs: DataFrame) -> DataFrame:
    """``docs`` with all its columns, each row as often as the mix takes it.

    Rows that share a doc_id are taken alike. Texts are not shuffled unless the ids whose copies
    differ from one are too many to broadcast.
    """
    of, number, copy = free_names(docs, "__of", "__copies", "__copy")
    copies = settle(
        _mix(docs)
        .groupBy(F.col("doc_id").alias(of))
        .agg(F.min("copies").cast("int").alias(number))
        .where(F.col(number) != 1)
    )
    mine = docs["doc_id"].cast("long").eqNullSafe(F.col(of))
    taken = docs.join(small_side(copies), mine, "left")
    times = F.coalesce(number, F.lit(1))
    repeated = taken.where(times > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), times)))
    return repeated.drop(of, number, copy)
