"""Lowest and highest prices of many day spans of one series, as arrays.

A span is cut out of the sorted days by two binary searches, and its extremes are looked up in a
sparse table: of the runs of 1, 2, 4, ... days two cover any span, overlapping where they must.
(Bender, Farach-Colton: The LCA Problem Revisited, 2000.) The steps of a span do not depend on
its length; the table has n log m entries for n days and spans of at most m of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Spans of several series that are put out as one batch.
OUT_ROWS = 100_000


def first_lowest(values: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Position of the first lowest of ``values[left:right]`` for many non-empty ranges."""
    level = np.frexp((right - left).astype(np.float64))[1] - 1
    table = [np.arange(len(values))]
    for k in range(int(level.max(initial=0))):
        runs = table[-1]
        a, b = runs[: -(1 << k)], runs[1 << k :]
        table.append(np.where(values[a] <= values[b], a, b))
    starts = np.cumsum([0, *map(len, table[:-1])])[level]
    table = np.concatenate(table)
    a = table[starts + left]
    b = table[starts + right - (1 << level)]
    return np.where(values[a] <= values[b], a, b)


def day_numbers(days: pa.Array, missing: int) -> np.ndarray:
    return days.cast(pa.int32()).fill_null(missing).to_numpy(zero_copy_only=False).astype(np.int64)


def extremes_of_lists(longest: int, falling: bool):
    """Rows (ticker, series, spans) to rows (ticker, span, _low, _high), see ``spans``."""

    def points(where, filled, days, keys):
        values = [pa.array(keys[where], pa.float64()), pa.array(days[where], pa.int32()).cast(pa.date32())]
        return pa.StructArray.from_arrays(values, ["key", "day"], mask=pa.array(~filled))

    def run(batches):
        for batch in batches:
            series, spans = batch.column("series"), batch.column("spans")
            bars, asked = series.values, spans.values
            days = day_numbers(bars.field("day"), 0)
            low = bars.field("low").to_numpy(zero_copy_only=False)
            high = -bars.field("high").to_numpy(zero_copy_only=False)
            first, last = day_numbers(asked.field("first_day"), 1), day_numbers(asked.field("last_day"), 0)
            if np.any((last - first >= longest)):
                raise ValueError(f"a span has more than {longest} days")
            bar_at, span_at = series.offsets.to_numpy(), spans.offsets.to_numpy()
            found, held = [], 0
            for row in range(batch.num_rows):
                b, e = bar_at[row], bar_at[row + 1]
                s, t = span_at[row], span_at[row + 1]
                order = b + np.argsort(days[b:e])
                left = np.searchsorted(days[order], first[s:t], "left")
                right = np.searchsorted(days[order], last[s:t], "right")
                filled = left < right
                at = np.flatnonzero(filled)
                lows = highs = np.zeros(0, np.int64)
                if len(at):
                    lows = order[first_lowest(low[order], left[at], right[at])]
                    highs = order[first_lowest(high[order], left[at], right[at])]
                if falling:
                    some = days[highs] < days[lows]
                    at, lows, highs, filled = at[some], lows[some], highs[some], np.ones(some.sum(), bool)
                    taken = s + at
                else:
                    all_lows, all_highs = np.zeros((2, t - s), np.int64)
                    all_lows[at], all_highs[at] = lows, highs
                    taken, lows, highs = np.arange(s, t), all_lows, all_highs
                found.append((np.full(len(taken), row), taken, filled, lows, highs))
                held += len(taken)
                if held and (held >= OUT_ROWS or row == batch.num_rows - 1):
                    rows, taken, filled, lows, highs = map(np.concatenate, zip(*found))
                    if not len(days):
                        days_, low_, high_ = np.zeros(1, np.int64), np.zeros(1), np.zeros(1)
                    else:
                        days_, low_, high_ = days, low, high
                    out = [
                        batch.column("ticker").take(pa.array(rows)), asked.take(pa.array(taken)),
                        points(lows, filled, days_, low_), points(highs, filled, days_, high_),
                    ]
                    yield pa.RecordBatch.from_arrays(out, ["ticker", "span", "_low", "_high"])
                    found, held = [], 0

    return run
