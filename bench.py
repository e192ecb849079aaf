"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the local cores. Every query runs
whole, into a sink that discards the rows; the median of the timed runs counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fallscan.plans.registry import all_queries  # noqa: E402
from fallscan.session import local_session  # noqa: E402

HEADLINE = [
    "bars", "window_crashes", "window_crashes_today", "window_extremes", "step_stats",
    "bar_lag", "isolation_score", "isolation_score_long", "anomalies", "anomaly_window_join",
    "anomaly_window_range", "anomaly_crashes", "anomaly_crashes_long", "step_stats_outlier",
    "collate_bars_crashes", "chart_series", "panel_to_long", "bars_latest_batch",
    "tickers_missing", "load_stability",
]


def seconds(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = local_session("bench", cpus)
    queries = all_queries()
    times = {}
    for name in HEADLINE:
        seconds(queries[name], spark, sf_dir)  # warm-up: class loading and code generation
        runs = [seconds(queries[name], spark, sf_dir) for _ in range(repeats)]
        times[name] = round(statistics.median(runs), 4)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, sum of median wall seconds",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
