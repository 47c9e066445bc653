import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark():
    from tidemill import local_session

    session = local_session(4, 4, **{"spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture
def one(spark):
    """A one-row frame of the given columns."""

    def make(schema: str, *values):
        return spark.createDataFrame([tuple(values)], schema)

    return make


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
