"""Writing result tables, and cutting a long plan by a written table."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

MONTH = "month"
BAR_KEYS = ("ticker", "trade_date")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    ``spark.checkpoint.dir`` names it; a session that leaves it unset gets a folder below
    its warehouse, which is shared as well.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/fallscan/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a work folder and all that was materialised in it."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _month(day: str) -> Column:
    return F.date_format(F.trunc(F.col(day), "month"), "yyyy-MM")


def write_by_month(table: DataFrame, path: str, day: str) -> None:
    """Write parquet partitioned by the month of ``day``.

    The rebalance hint sizes the files: adaptive execution merges small months
    and splits large ones, so no month is written by a single task.
    """
    keyed = table.withColumn(MONTH, _month(day))
    keyed.hint("rebalance", MONTH).write.mode("error").partitionBy(MONTH).parquet(path)


def read_by_month(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """Read such a table back in the schema of ``like``."""
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def merge_batch(
    batch: DataFrame, path: str, order: Sequence[str] = (), keys: Sequence[str] = BAR_KEYS,
    day: str = "trade_date",
) -> None:
    """Merge a batch of rows into the table at ``path``, which is partitioned by month.

    Of several rows per key the one that is greatest in ``order`` stays, then the greatest in
    all its fields; without ``order`` the batch replaces what is there. Only months in which this
    changes a row are read in full and written again, each replaced as a whole when the job
    commits; the files of all others stay. A batch that was merged before changes nothing, so a
    job that failed half-way is simply run again. Rows without a day are left out. ``batch`` must
    not be read from ``path``.
    """
    spark = batch.sparkSession
    fields = [c for c in batch.columns if c not in keys]
    ranked = F.struct(*order, "_fresh", *[c for c in fields if c not in order])

    def newest(rows: DataFrame) -> DataFrame:
        best = rows.groupBy(MONTH, *keys).agg(F.max(ranked).alias("_best"))
        return best.select(*keys, *[f"_best.{c}" for c in fields], "_best._fresh", MONTH)

    dated = batch.where(F.col(day).isNotNull())
    incoming = dated.withColumns({MONTH: _month(day), "_fresh": F.lit(True)})
    if not _exists(spark, path):
        write_by_month(newest(incoming).select(*batch.columns), path, day)
        return
    schema = StructType([*batch.schema.fields, StructField(MONTH, StringType())])
    stored = spark.read.schema(schema).parquet(path).withColumn("_fresh", F.lit(False))
    months = [r[MONTH] for r in incoming.select(MONTH).distinct().collect()]
    touched = stored.where(F.col(MONTH).isin(months))
    merged = newest(touched.unionByName(incoming))
    same = F.lit(True)
    for c in batch.columns:
        same &= F.col(f"m.{c}").eqNullSafe(F.col(f"s.{c}"))
    same &= F.col(f"m.{MONTH}") == F.col(f"s.{MONTH}")
    fresh = merged.where("_fresh").alias("m")
    changed = [
        r[MONTH]
        for r in fresh.join(touched.alias("s"), same, "left_anti").select(MONTH).distinct().collect()
    ]
    if changed:
        rows = merged.where(F.col(MONTH).isin(changed)).select(*batch.columns, MONTH)
        writer = rows.hint("rebalance", MONTH).write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)


def materialise(table: DataFrame, folder: str, name: str) -> DataFrame:
    """Write ``table`` into a shared work folder and return it as read from there.

    Several outputs can then be built from one computation, and a lost executor
    costs a re-read instead of a recomputation. ``remove`` deletes the folder.
    """
    path = f"{folder.rstrip('/')}/{name}"
    table.write.mode("error").parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def save_bucketed_bars(bars: DataFrame, name: str, buckets: int, path: str) -> None:
    """Save bars as a table bucketed by ticker.

    All per-ticker analyses read such a table without any shuffle.
    """
    (
        bars.repartition(buckets, "ticker")
        .write.mode("error")
        .option("path", path)
        .bucketBy(buckets, "ticker")
        .sortBy("ticker", "trade_date")
        .saveAsTable(name)
    )
