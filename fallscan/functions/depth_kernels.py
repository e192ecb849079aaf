"""Isolation depths of one series of numbers. Plain arrays, no Spark.

Two models:

* ``isolation_depths``: the expected number of cuts until a value is alone, over trees grown to the
  end on the whole series. The sum over gaps is direct for short series and hierarchical for long
  ones.
* ``forest_depths``: the expected path length in a forest whose trees see a sample of the rows,
  stop at a depth limit and add the usual correction for leaves with several rows.
"""

from __future__ import annotations

import itertools
import math

import numpy as np

#: Distinct values up to which every gap is added to every value one by one.
DIRECT = 192

#: Least values of a leaf of the hierarchy, is at most doubled.
LEAF = 32

#: Two nodes are far from each other if their radii make up at most this share of their centres'
#: distance. With ``TERMS`` terms a far sum then errs by at most the fraction
#: SEPARATION ** TERMS * (1 + SEPARATION) / (1 - SEPARATION), below 3e-12, of itself. All terms
#: of a depth are positive, so its error is at most that fraction as well.
SEPARATION = 0.5
TERMS = 40

#: Elements of a temporary matrix, and of one that a series runs over many times.
TILE = 1 << 21
CACHED = 1 << 14


def _binomials() -> np.ndarray:
    """C(p + k, p) for p + k < TERMS, else 0."""
    table = np.zeros((TERMS, TERMS))
    for p in range(TERMS):
        for k in range(TERMS - p):
            table[p, k] = math.comb(p + k, p)
    return table


def _near(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Sum over y > x of weight / (y - x) along the last axis; x has one axis less."""
    distance = y[..., None, :] - x[..., :, None]
    share = np.zeros_like(distance)
    np.divide(np.broadcast_to(weight[..., None, :], share.shape), distance, out=share,
              where=distance > 0)
    return share.sum(axis=-1)


def _direct_above(values: np.ndarray) -> np.ndarray:
    """For each value the sum of gap / (upper end - value) over all gaps above it."""
    out = np.empty(len(values))
    gaps = np.diff(values, prepend=values[:1])
    rows = max(1, TILE // len(values))
    for at in range(0, len(values), rows):
        out[at : at + rows] = _near(values[at : at + rows], values[at:], gaps[at:])
    return out


def _moments(unit: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Sums of weight * unit ** p over each row."""
    out = np.empty((len(unit), TERMS))
    rows = max(1, CACHED // unit.shape[1])
    for at in range(0, len(unit), rows):
        x, power = unit[at : at + rows], weight[at : at + rows].copy()
        for p in range(TERMS):
            out[at : at + rows, p] = power.sum(axis=1)
            power *= x
    return out


def _series(unit: np.ndarray, local: np.ndarray) -> np.ndarray:
    """Sum of local[:, k] * unit ** k, by row."""
    out = np.zeros(unit.shape)
    rows = max(1, CACHED // unit.shape[1])
    for at in range(0, len(unit), rows):
        x, total = unit[at : at + rows], out[at : at + rows]
        for k in range(TERMS - 1, -1, -1):
            total *= x
            total += local[at : at + rows, k, None]
    return out


def _fast_above(values: np.ndarray) -> np.ndarray:
    """The same by a binary hierarchy over positions: near leaves directly, far nodes by moments
    of the gaps about the source's centre, turned into a series about the target's centre."""
    depth = max(0, math.ceil(math.log2(len(values) / (2 * LEAF))))
    leaves = 1 << depth
    size = math.ceil(len(values) / leaves)
    pad = leaves * size - len(values)
    y = np.concatenate([values, np.full(pad, values[-1])])
    weight = np.concatenate([np.diff(values, prepend=values[:1]), np.zeros(pad)])
    out = np.zeros(len(y))
    binomials = _binomials()
    signs = (-1.0) ** np.arange(TERMS)
    target = source = np.zeros(1, np.int64)
    for level in range(depth, -1, -1):
        nodes = y.reshape(leaves >> level, -1)
        centre = (nodes[:, 0] + nodes[:, -1]) / 2
        radius = (nodes[:, -1] - nodes[:, 0]) / 2
        apart = centre[source] - centre[target]
        far = radius[target] + radius[source] <= SEPARATION * apart
        far &= (source > target) & (apart > 0)
        if far.any():
            scale = np.where(radius > 0, radius, 1.0)
            unit = (nodes - centre[:, None]) / scale[:, None]
            moments = _moments(unit, weight.reshape(nodes.shape))
            t, s, d = target[far], source[far], apart[far]
            order = np.arange(TERMS)
            series = moments[s] * signs * (radius[s] / d)[:, None] ** order
            series = (series @ binomials) * (radius[t] / d)[:, None] ** order / d[:, None]
            local = np.zeros((len(nodes), TERMS))
            np.add.at(local, t, series)
            reached = np.unique(t)
            out.reshape(nodes.shape)[reached] += _series(unit[reached], local[reached])
        target, source = target[~far], source[~far]
        if level:
            same = target == source
            t, s = 2 * target[~same], 2 * source[~same]
            own = 2 * target[same]
            target = np.concatenate([t, t, t + 1, t + 1, own, own, own + 1])
            source = np.concatenate([s, s + 1, s, s + 1, own, own + 1, own + 1])
    blocks, gaps = y.reshape(leaves, -1), weight.reshape(leaves, -1)
    step = max(1, TILE // (size * size))
    for at in range(0, len(target), step):
        t, s = target[at : at + step], source[at : at + step]
        np.add.at(out.reshape(blocks.shape), t, _near(blocks[t], blocks[s], gaps[s]))
    return out[: len(values)]


def isolation_depths(values: np.ndarray, direct: int = DIRECT) -> np.ndarray:
    """Depths of an ascending array without repeats."""
    if len(values) < 2:
        return np.zeros(len(values))
    above = _direct_above if len(values) <= direct else _fast_above
    return above(values) + above(-values[::-1])[::-1]


# ---- forests of limited trees on samples ---------------------------------------------------


def leaf_correction(rows: np.ndarray) -> np.ndarray:
    """Expected further depth of a leaf that holds so many rows."""
    rows = np.asarray(rows, float)
    many = np.maximum(rows, 3)
    estimate = 2 * (np.log(many - 1) + np.euler_gamma) - 2 * (many - 1) / many
    return np.where(rows > 2, estimate, np.where(rows == 2, 1.0, 0.0))


def tree_depths(values: np.ndarray, counts: np.ndarray, limit: int) -> np.ndarray:
    """Expected path lengths of ascending distinct values, over all trees on these rows.

    A node is an interval of values. Its probability at each depth follows from those one level
    up: a cut in a gap makes the two intervals beside it, with a chance of gap / interval. An
    inner node adds one to the path of every value inside, a leaf its correction.
    """
    m = len(values)
    before = np.concatenate([[0], np.cumsum(counts)])
    rows = before[None, 1:] - before[:-1, None]
    correction = leaf_correction(rows)
    gaps = np.diff(values)
    span = values[None, :] - values[:, None]
    inner = np.triu(np.ones((m, m), bool), 1)
    span[~inner] = np.inf
    chance = np.zeros((m, m))
    chance[0, -1] = 1.0
    worth = np.zeros((m, m))
    for _ in range(limit):
        worth += np.where(inner, chance, chance * np.eye(m) * correction)
        share = chance / span
        further = np.cumsum(share[:, ::-1], axis=1)[:, ::-1]  # over upper ends from here on
        earlier = np.cumsum(share, axis=0)  # over lower ends up to here
        chance = np.zeros((m, m))
        chance[:, :-1] += gaps * further[:, 1:]
        chance[1:, :] += gaps[:, None] * earlier[:-1, :]
        chance[np.tril_indices(m, -1)] = 0.0
    worth += chance * correction
    inside = np.cumsum(np.cumsum(worth, axis=0)[:, ::-1], axis=1)[:, ::-1]
    return np.diagonal(inside).copy()


def _samples(n: int, size: int, runs: int, seed: int):
    """All samples if they are at most ``runs``, else so many drawn ones."""
    if math.comb(n, size) <= runs:
        yield from (list(s) for s in itertools.combinations(range(n), size))
    else:
        random = np.random.default_rng(seed)
        for _ in range(runs):
            yield random.choice(n, size, replace=False)


def forest_depths(rows: np.ndarray, max_samples: int, runs: int, seed: int) -> np.ndarray:
    """Expected path lengths of the distinct values of ascending ``rows``, repeats included.

    Trees see ``max_samples`` rows. The expectation over trees is exact. So is the one over
    samples if there are at most ``runs`` samples, above all if the series has no more rows than
    one; else it is a mean over that many samples, the same for every series of that length. A
    value that a sample lacks follows its two neighbours there, so its depth lies on the line
    between theirs.
    """
    values, counts = np.unique(rows, return_counts=True)
    size = min(max_samples, len(rows))
    limit = math.ceil(math.log2(max(size, 2)))
    if size == len(rows):
        return tree_depths(values, counts, limit)
    total, taken = np.zeros(len(values)), 0
    for sample in _samples(len(rows), size, runs, seed):
        seen, times = np.unique(rows[sample], return_counts=True)
        total += np.interp(values, seen, tree_depths(seen, times, limit))
        taken += 1
    return total / taken
