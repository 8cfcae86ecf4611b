import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from binoscope.session import get_session  # noqa: E402

SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", 8, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


@pytest.fixture
def small_ranges(spark):
    """Force the split-range form of every ordered operator."""
    spark.conf.set("binoscope.rowsPerBucket", "50")
    yield
    spark.conf.unset("binoscope.rowsPerBucket")


@pytest.fixture
def scored_of(spark):
    def make(y, p, **columns):
        names = ["id", "y", "p", *columns]
        rows = list(zip(range(1, len(y) + 1), y, [float(v) for v in p], *columns.values()))
        kinds = ["long", "int", "double"] + ["string"] * len(columns)
        return spark.createDataFrame(rows, ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds)))
    return make
