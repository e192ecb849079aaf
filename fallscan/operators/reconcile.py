"""Comparison of two loads by digests: keys travel only where the loads differ.

Rows are dealt into hash buckets. Of every bucket both loads contribute a count and sums of two
64-bit hashes, the second load with a minus sign, so equal multisets of rows cancel to zeros
whatever their order and number of copies. These sums are formed on the map side: what is
shuffled for them is at most a row per bucket and task. Rows are then fetched for the buckets
that did not cancel. How many that are follows from the difference, not from the loads:
``d`` differing rows touch at most ``d`` buckets of ``rows / buckets`` rows.

Two different buckets would have to agree in a count and in two independent 64-bit sums to be
taken for equal. Null values equal null values, NaN equals NaN.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: The table of differing buckets has at most so many rows of one number: 512 KB to broadcast.
BUCKETS = 1 << 16

_SIDE, _BUCKET = "_side", "_bucket"


def _hash(columns: Sequence[str], seed: int) -> Column:
    """A hash that tells null from absent: ``xxhash64`` skips nulls."""
    parts = [part for c in columns for part in (F.col(c), F.col(c).isNull())]
    return F.xxhash64(F.lit(seed), *parts)


def _bucketed(rows: DataFrame, columns: Sequence[str], buckets: int) -> DataFrame:
    bucket = F.pmod(_hash(columns, 1), F.lit(buckets).cast("long"))
    return rows.select(*columns, bucket.alias(_BUCKET))


def _both(first: DataFrame, second: DataFrame, columns: Sequence[str], buckets: int) -> DataFrame:
    """The rows of both loads with their bucket and a sign: 1 the first, -1 the second."""
    return _bucketed(first, columns, buckets).withColumn(_SIDE, F.lit(1)).unionByName(
        _bucketed(second, columns, buckets).withColumn(_SIDE, F.lit(-1))
    )


def _halves(column: Column) -> list[Column]:
    """Two 32-bit halves of a hash: their sums fit a long for 2^31 rows a bucket."""
    return [column.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(column, 32)]


def differing_buckets(
    first: DataFrame, second: DataFrame, columns: Sequence[str], buckets: int = BUCKETS
) -> DataFrame:
    """(_bucket) of the buckets whose rows are not the same multiset in both loads."""
    both = _both(first, second, columns, buckets)
    signed = [F.col(_SIDE).cast("long")]
    for seed in (2, 3):
        signed += [half * F.col(_SIDE) for half in _halves(_hash(columns, seed))]
    sums = [F.sum(value).alias(f"_sum{n}") for n, value in enumerate(signed)]
    unequal = " or ".join(f"_sum{n} <> 0" for n in range(len(sums)))
    return both.groupBy(_BUCKET).agg(*sums).where(unequal).select(_BUCKET)


def changes(
    first: DataFrame,
    second: DataFrame,
    columns: Sequence[str] = ("ticker",),
    buckets: int = BUCKETS,
) -> DataFrame:
    """Rows that do not occur equally often: ``columns``, n_first, n_second.

    ``buckets`` beyond the default would outgrow the bound of the broadcast and is refused.
    """
    if not 1 <= buckets <= BUCKETS:
        raise ValueError(f"buckets must lie between 1 and {BUCKETS}")
    columns = list(columns)
    wanted = F.broadcast(differing_buckets(first, second, columns, buckets))
    suspects = _both(first, second, columns, buckets).join(wanted, _BUCKET, "left_semi")
    return (
        suspects.groupBy(*columns)
        .agg(
            F.count_if(F.col(_SIDE) == 1).alias("n_first"),
            F.count_if(F.col(_SIDE) == -1).alias("n_second"),
        )
        .where("n_first <> n_second")
    )


def only_in_first(
    first: DataFrame,
    second: DataFrame,
    columns: Sequence[str] = ("ticker",),
    buckets: int = BUCKETS,
) -> DataFrame:
    """The bag difference, as ``first.exceptAll(second)`` gives it."""
    surplus = F.sequence(F.lit(1), (F.col("n_first") - F.col("n_second")).cast("int"))
    return (
        changes(first, second, columns, buckets)
        .where("n_first > n_second")
        .select(*columns, F.explode(surplus).alias("_copy"))
        .drop("_copy")
    )
