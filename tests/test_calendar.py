import datetime

import pytest
from pyspark.sql import functions as F

from fallscan.functions.calendar import crash_period, latest_trading_day, load_start, weekday_back


def loop_back(start, weekdays):
    """The definition: step back day by day, counting weekdays."""
    current = start
    while weekdays > 0:
        current -= datetime.timedelta(days=1)
        weekdays -= current.weekday() < 5
    return current


@pytest.fixture(scope="module")
def days(spark):
    return spark.range(400).select(
        F.date_add(F.lit("2023-11-27").cast("date"), F.col("id").cast("int")).alias("d")
    )


@pytest.mark.parametrize("n", [0, 1, 2, 4, 5, 6, 10, 11, 23])
def test_weekday_back_equals_stepping(days, n):
    for start, found in days.select("d", weekday_back(F.col("d"), n)).collect():
        assert found == loop_back(start, n), start


@pytest.mark.parametrize(
    "asof, latest",
    [
        ("2024-01-08", "2024-01-05"),  # Monday -> Friday
        ("2024-01-09", "2024-01-08"),  # Tuesday -> Monday
        ("2024-01-13", "2024-01-12"),  # Saturday -> Friday
        ("2024-01-14", "2024-01-13"),  # Sunday -> Saturday, by the rule as given
    ],
)
def test_latest_trading_day(spark, asof, latest):
    found = spark.range(1).select(latest_trading_day(asof)).first()[0]
    assert found == datetime.date.fromisoformat(latest)


def test_crash_period_of_a_wednesday(spark):
    first, last = crash_period("2024-01-31", 5)
    row = spark.range(1).select(first, last).first()
    assert tuple(map(str, row)) == ("2024-01-23", "2024-01-30")


def test_load_start(spark):
    row = spark.range(1).select(
        load_start("2024-03-31", 1, "month"), load_start("2024-03-31", 5, "day")
    ).first()
    assert tuple(map(str, row)) == ("2024-02-29", "2024-03-26")
    with pytest.raises(ValueError):
        load_start("2024-03-31", 1, "year")
