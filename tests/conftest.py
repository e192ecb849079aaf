import datetime
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fallscan import schemas  # noqa: E402
from fallscan.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4, memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def day(n: int, start: str = "2024-01-01") -> datetime.date:
    """The n-th day, counted from 1. 2024-01-01 is a Monday."""
    return datetime.date.fromisoformat(start) + datetime.timedelta(days=n - 1)


@pytest.fixture(scope="session")
def make_bars(spark):
    """Bars from ``{ticker: [(day number, price, volume[, close]), ...]}``."""

    def build(series):
        rows = []
        for ticker, points in series.items():
            for n, price, volume, *close in points:
                shown = close[0] if close else price
                rows.append((ticker, day(n), shown, shown, shown, shown, price, volume))
        return spark.createDataFrame(rows, schemas.BARS)

    return build


@pytest.fixture(scope="session")
def prices(make_bars):
    """Bars from ``{ticker: [price, ...]}`` on successive days with volume 1."""

    def build(series):
        return make_bars(
            {t: [(i + 1, p, 1) for i, p in enumerate(values)] for t, values in series.items()}
        )

    return build
