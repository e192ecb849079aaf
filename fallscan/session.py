"""Session settings.

On a cluster the session comes from the cluster's own configuration; only the
settings in ``CLUSTER`` matter to these analyses. Adaptive execution chooses the
number of reducers, the join strategy by measured size, and splits skewed joins.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

CLUSTER = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

#: Small data on one machine: keep a reducer on every core instead of merging
#: them by size, and record no Python call sites while plans are built.
LOCAL = {
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(name: str, cpus: str | int = "*", memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks, a reducer per core."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8" if cpus == "*" else str(cpus))
    )
    for key, value in {**CLUSTER, **LOCAL}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
