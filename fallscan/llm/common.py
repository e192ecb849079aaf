"""What several operators of this package share.

Every operator takes a DataFrame of documents with at least ``doc_id`` (bigint) and ``text``
(string) and selects only the columns it needs, so further columns with any name do no harm.
"""

from __future__ import annotations

import math
import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The white space of the contracts, as a regular expression and as characters.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"

#: A side of a join is broadcast only if it was counted and its rows, as narrow as two or
#: three longs, stay below this number (about 64 MB); above it the join shuffles.
BROADCAST_ROWS = 2_000_000

#: The same bound for rows of any width, in bytes, and what a row costs beside its values.
BROADCAST_BYTES = 64 << 20
ROW_OVERHEAD = 64

#: Bytes of an Arrow batch. Every running task holds some of them, in the JVM and in its worker.
BATCH_BYTES = 1 << 20

_PACKAGE_HOME = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers import the package and see whole texts in batches of bounded bytes.

    On a cluster the package is shipped with the job (``--py-files``); the extra path entry
    serves local sessions that were started in another folder. A batch holds at most 2,000 rows
    and ends with the row that fills ``BATCH_BYTES``, unless the session sets other bounds.
    """
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if _PACKAGE_HOME not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([_PACKAGE_HOME, *filter(None, paths)])
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "67108864b":
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` once and read it back: cuts lineage, survives lost executors.

    The files go to the shared folder named by ``spark.checkpoint.dir``. Only where that is
    unset, as in tests, a folder below the session's warehouse is used.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        context.setCheckpointDir(folder or f"{warehouse.rstrip('/')}/_checkpoints")
    return df.checkpoint(eager=True)


def small_side(df: DataFrame) -> DataFrame:
    """A broadcast hint behind a count of the rows; beyond the bound the plain DataFrame.

    ``df`` must be settled and narrow (a few numbers a row).
    """
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def broadcast_bytes(df: DataFrame, row_bytes: Column) -> DataFrame:
    """A broadcast hint if the rows of the settled ``df``, so many bytes each, measure few in all."""
    total = df.agg(F.sum(row_bytes + ROW_OVERHEAD)).first()[0] or 0
    return F.broadcast(df) if total <= BROADCAST_BYTES else df


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each lengthened until ``df`` has no column of that name in any case."""
    taken = {column.lower() for column in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        found.append(name)
    return found


def parts_for(spark: SparkSession, rows: int, per_part: int) -> int:
    """A number of hash buckets that grows with the rows; never below the reducers'."""
    reducers = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(reducers, math.ceil(rows / per_part), 1)
