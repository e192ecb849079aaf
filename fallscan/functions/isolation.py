"""Expected isolation depth of a value, in closed form.

An isolation tree on one feature splits the range of its sample at a uniform
point, again and again, until the value is alone. A gap ``(lo, hi)`` between two
neighbouring values separates a value ``x <= lo`` from ``hi`` exactly if it is hit
before every other cut between ``x`` and ``hi``, which happens with probability
``(hi - lo) / (hi - x)``; the other side is symmetric. The expected number of
cuts that isolate ``x`` is the sum over all gaps. A small depth marks an outlier.
(Liu, Ting, Zhou: Isolation Forest, ICDM 2008.)

Every value of a series takes part, however long the series is. The result is
deterministic, needs no trees and no random state. Short series are summed by a
column expression, long ones as arrays by ``depth_kernels``, whose far gaps count
in groups: n log n steps instead of n^2, with an error far below the rounding.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from fallscan.functions import depth_kernels

# Workers get the kernels with the task, so they need no installed package.
cloudpickle.register_pickle_by_value(depth_kernels)

# Fixed value: decimal places of a depth. Equal positions in a series get equal
# depths although their sums were formed in a different order.
DEPTH_DECIMALS = 6

# Fixed values of the forest: rows that a tree sees, and trees.
MAX_SAMPLES = 256
FOREST_RUNS = 100
FOREST_SEED = 42

Depths = Callable[[np.ndarray], np.ndarray]


def expected_depth(x: Column, gaps: Column) -> Column:
    """Depth of ``x`` given the gaps ``array<struct<lo, hi, width>>`` of its series.

    Every gap lies on one side of ``x``; its far end counts.
    """

    def add(depth: Column, gap: Column) -> Column:
        above = depth + gap.width / (gap.hi - x)
        below = depth + gap.width / (x - gap.lo)
        return F.when(gap.lo >= x, above).otherwise(below)

    return F.aggregate(gaps, F.lit(0.0), add)


def whole_series() -> Depths:
    """Depths over the whole series, trees grown to the end."""
    kernel = depth_kernels.isolation_depths
    return lambda rows: kernel(np.unique(rows))


def limited_forest(
    max_samples: int = MAX_SAMPLES, runs: int = FOREST_RUNS, seed: int = FOREST_SEED
) -> Depths:
    """Path lengths in a forest with samples, a depth limit and leaf corrections."""
    return partial(depth_kernels.forest_depths, max_samples=max_samples, runs=runs, seed=seed)


def _scorer(depths: Depths) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def score(batches):
        for batch in batches:
            scored = [depths(rows.values.to_numpy()) for rows in batch.column("rows")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(scored, pa.list_(pa.float64()))], ["key", "depths"]
            )

    return score


def depth_curves(values: DataFrame, key: str, value: str, depths: Depths) -> DataFrame:
    """(key, depths): for each key the depths of its distinct values, in ascending order.

    A key's values travel as one sorted array, which its number of days bounds. No pair of values
    becomes a row.
    """
    series = (
        values.where(F.col(value).isNotNull())
        .groupBy(F.col(key).alias("key"))
        .agg(F.sort_array(F.collect_list(value)).alias("rows"))
    )
    scored = series.mapInArrow(_scorer(depths), "key string, depths array<double>")
    return scored.withColumnRenamed("key", key)


def rounded(depth: Column) -> Column:
    return F.round(depth, DEPTH_DECIMALS)
