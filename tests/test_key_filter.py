"""Semi joins behind a Bloom filter."""

import pytest
from pyspark.sql import functions as F

from fallscan.operators import key_filter
from fallscan.plans import inputs
from fallscan.plans.registry import REGION, all_queries


@pytest.fixture(scope="module")
def table(spark):
    ticker = "case when id % 50 = 0 then null else concat('T', id % 2000) end as ticker"
    return spark.range(20_000).selectExpr(ticker, "id", "'x' as word", "'y' as bits")


@pytest.mark.parametrize("words", [1, 64, key_filter.WORDS])
def test_equals_the_plain_semi_join(spark, table, words):
    wanted = "case when id = 3 then null else concat('T', id * 7) end as ticker"
    keys = spark.range(300).selectExpr(wanted).union(spark.sql("select 'T7'"))
    found = key_filter.semi_join(table, keys, words=words)
    plain = table.join(keys, "ticker", "left_semi")
    assert found.columns == table.columns
    assert sorted(r.id for r in found.collect()) == sorted(r.id for r in plain.collect())


def test_few_rows_pass_wrongly_and_none_is_lost(spark):
    words = 256
    keys = spark.range(4 * words).select(F.col("id").alias("key"))
    rows = spark.range(101_024).select(F.col("id").alias("key"))
    passed = rows.where(key_filter.might_contain(keys, "key", F.col("key"), words))
    wrong = passed.where(F.col("key") >= 4 * words).count()
    assert passed.count() - wrong == 4 * words
    assert wrong < 1_000


def test_no_keys_and_no_rows(table):
    assert key_filter.semi_join(table, table.limit(0)).isEmpty()
    assert key_filter.semi_join(table.limit(0), table).isEmpty()


def test_types_must_agree(spark, table):
    with pytest.raises(TypeError):
        key_filter.semi_join(table, spark.range(3).select(F.col("id").alias("ticker")))
    for words in (0, key_filter.MAX_WORDS + 1):
        with pytest.raises(ValueError):
            key_filter.filter_words(table, "ticker", words)


def test_the_filter_reaches_the_scan(spark, sf_dir):
    """Below the aggregation to bars, over raw rows, and the exact join stays."""
    bars = all_queries()["bars_of_region"](spark, sf_dir)
    lines = bars._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = next(n for n, line in enumerate(lines) if "scalar-subquery" in line)
    above = [n for n, line in enumerate(lines) if "Aggregate" in line and n < at]
    assert above and any("LeftSemi" in line for line in lines[:at])
    keys = inputs.region_tickers(spark, sf_dir, REGION)
    everything = inputs.lineitem_bars(spark, sf_dir)
    passed = everything.where(key_filter.might_contain(keys, "ticker", F.col("ticker")))
    assert bars.count() <= passed.count() < everything.count()
