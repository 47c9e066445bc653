"""Every registered query against its SQL twin, on the smallest tables."""

import pytest
from oracle import compare, connect

from tidemill.queries import ORACLES, QUERIES

# nothing of this kind lies in the smallest tables
MAY_BE_EMPTY = {"stale_keys", "stream_silent_keys", "issue_poll"}


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    if name not in ORACLES:
        assert df.count() > 0
        return
    problem = compare(duck, df, ORACLES[name])
    assert problem is None or (problem == "no rows" and name in MAY_BE_EMPTY), problem


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
