from __future__ import annotations

import tempfile

import pytest

from skyledger.session import build_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    shared = tempfile.mkdtemp(prefix="run-shared-", dir="/tmp")
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": shared,
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture(scope="session")
def one(spark):
    """Apply a column function to one literal."""
    from pyspark.sql import functions as F

    def apply(function, *values):
        return spark.range(1).select(function(*[F.lit(v) for v in values]).alias("x")).head()["x"]

    return apply
