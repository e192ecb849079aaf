"""Every query against its SQL on the same files, and on a heavily skewed copy."""

import datetime
import math

import duckdb
import pytest
from pyspark.sql import functions as F

from fallscan.plans import inputs
from fallscan.plans.oracle import oracle_statements
from fallscan.plans.registry import all_queries
from fallscan.schemas import DRIVER_TABLES

QUERIES, STATEMENTS = all_queries(), oracle_statements()


def connect(folder):
    con = duckdb.connect()
    for name in DRIVER_TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def oracle(sf_dir):
    return connect(sf_dir)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(value):
        if value is None or isinstance(value, float) and math.isnan(value):
            return ""
        if isinstance(value, datetime.datetime):
            value = value.date()
        return repr(value)

    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def assert_equal(frame, relation):
    assert sorted(frame.columns) == sorted(relation.columns)
    rows = [tuple(r) for r in frame.collect()]
    assert canonical(frame.columns, rows) == canonical(relation.columns, relation.fetchall())


def test_registry_is_complete():
    assert set(STATEMENTS) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query_equals_sql(spark, sf_dir, oracle, name):
    assert_equal(QUERIES[name](spark, sf_dir), oracle.sql(STATEMENTS[name]))


def test_entry(spark):
    frame = __import__("__spark_entry__").entry(spark)
    assert frame.count() > 0
    assert frame.columns[-2:] == ["max_value", "min_value"]


@pytest.fixture(scope="module")
def skewed(spark, sf_dir, tmp_path_factory):
    """The same tables, but one user and one supplier hold more than a third of all rows."""
    folder = tmp_path_factory.mktemp("skewed")
    for name in DRIVER_TABLES:
        rows = inputs.table(spark, sf_dir, name)
        if name == "events":
            hot = F.when(F.col("event_id") % 5 < 2, F.lit(3)).otherwise(F.col("user_id"))
            rows = rows.withColumn("user_id", hot.cast("bigint"))
        if name == "lineitem":
            hot = F.when(F.col("l_orderkey") % 5 < 2, F.lit(7)).otherwise(F.col("l_suppkey"))
            rows = rows.withColumn("l_suppkey", hot.cast("bigint"))
        rows.write.parquet(str(folder / f"{name}.parquet"))
    return str(folder)


@pytest.mark.parametrize(
    "name",
    ["bars", "window_crashes", "isolation_score_long", "anomaly_crashes", "anomaly_crashes_long",
     "step_stats_outlier", "bars_latest_batch", "anomaly_window_join"],
)
def test_hot_keys_keep_results_whole(spark, skewed, name):
    con = duckdb.connect()
    for table in DRIVER_TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{skewed}/{table}.parquet/*.parquet'")
    assert_equal(all_queries()[name](spark, skewed), con.sql(STATEMENTS[name]))


def test_long_keys_stay_apart(spark):
    keys = spark.createDataFrame([(7,), (123456,), (1234567,)], "k bigint")
    found = [r[0] for r in keys.select(inputs.ticker_of(F.col("k"))).collect()]
    assert found == ["T00007", "T123456", "T1234567"]
