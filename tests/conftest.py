import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

from riverframe.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """Sorted list of tuples of a result, columns in the given order."""

    def collect(df, *cols):
        picked = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((v is None, str(v)) for v in t))

    return collect


@pytest.fixture(scope="session")
def series(spark):
    """DataFrame (location, date DATE, x DOUBLE) from {location: [values]} on consecutive days."""

    def build(data, start="2024-01-01"):
        values = [(k, i, None if v is None else float(v)) for k, vs in data.items() for i, v in enumerate(vs)]
        df = spark.createDataFrame(values, "location string, i int, x double")
        return df.selectExpr("location", f"date_add(date'{start}', i) AS date", "x")

    return build
