"""Comparison of loads by digests, against the plain set operations."""

import random

import pytest

from fallscan.operators import reconcile

SCHEMA = "ticker string, day int, price double"


def bag(frame):
    return sorted(map(repr, frame.collect()))


@pytest.fixture(scope="module")
def loads(spark):
    chance = random.Random(3)
    rows = [
        (chance.choice([None, "", "A", "B", "C"]), chance.choice([None, 1, 2]),
         chance.choice([None, 0.0, 1.5, float("nan")]))
        for _ in range(600)
    ]
    other = [r for r in rows if chance.random() < 0.9] + [("new", 9, 1.0)] * 3
    chance.shuffle(other)
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(other, SCHEMA)


@pytest.mark.parametrize("buckets", [1, 7, reconcile.BUCKETS])
def test_difference_equals_except_all(loads, buckets):
    first, second = loads
    columns = first.columns
    for one, two in ((first, second), (second, first)):
        found = reconcile.only_in_first(one, two, columns, buckets)
        assert bag(found) == bag(one.exceptAll(two)) != []


def test_counts_of_both_sides(spark):
    first = spark.createDataFrame([("A",), ("A",), ("B",), (None,)], "ticker string")
    second = spark.createDataFrame([("A",), ("B",), (None,), (None,), ("C",)], "ticker string")
    found = {r.ticker: (r.n_first, r.n_second) for r in reconcile.changes(first, second).collect()}
    assert found == {"A": (2, 1), None: (1, 2), "C": (0, 1)}


def test_null_is_neither_absent_nor_moved(spark):
    schema = "ticker string, name string"
    first = spark.createDataFrame([(None, "x")], schema)
    second = spark.createDataFrame([("x", None)], schema)
    assert reconcile.changes(first, second, ["ticker", "name"]).count() == 2


def test_order_and_empty_loads(spark, loads):
    first, _ = loads
    same = first.repartition(5).orderBy("price")
    assert reconcile.differing_buckets(first, same, first.columns).isEmpty()
    nothing = first.limit(0)
    assert reconcile.changes(nothing, nothing, first.columns).isEmpty()
    assert bag(reconcile.only_in_first(first, nothing, first.columns)) == bag(first)


def test_rows_fetched_follow_the_difference(spark):
    first = spark.range(50_000).selectExpr("cast(id as string) as ticker", "id as _bucket")
    second = first.where("_bucket % 10000 <> 7")
    wanted = reconcile.differing_buckets(first, second, ["ticker"], 1 << 12)
    assert 1 <= wanted.count() <= 5
    fetched = reconcile._bucketed(first, ["ticker"], 1 << 12).join(wanted, "_bucket", "left_semi")
    assert fetched.count() < 5 * 40
    gone = {r.ticker for r in reconcile.only_in_first(first, second, ["ticker"], 1 << 12).collect()}
    assert gone == {"7", "10007", "20007", "30007", "40007"}


def test_buckets_are_bounded(loads):
    for buckets in (0, reconcile.BUCKETS + 1):
        with pytest.raises(ValueError):
            reconcile.changes(*loads, ["ticker"], buckets)
