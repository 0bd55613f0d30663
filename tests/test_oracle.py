"""Every registered query against its SQL oracle (DuckDB) on the smallest tables."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tidewater.plans import ORACLE, QUERIES
from tools.oracle_check import compare, connect

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return connect(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, name, SF_SMALL)
    assert ok, msg


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["hour", "event_type", "event_count"]
    assert df.count() > 0
