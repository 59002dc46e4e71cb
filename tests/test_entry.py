"""Driver contract and DuckDB parity of every registered query (sf0.01)."""

import pytest

import __spark_entry__ as E
from meterline.plans.registry import ORACLES, QUERIES
from tests.conftest import SF01
from tools.check_oracles import compare, duck

NAMES = sorted(QUERIES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 5 and df.columns == ["pickup_borough", "trip_count", "avg_distance", "avg_fare", "rated_trips"]


def test_oracles_cover_queries(spark):
    o = E.oracle_sql()
    assert set(o) <= set(E.queries())
    assert set(QUERIES) == set(ORACLES) <= set(o)


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    oracles = E.oracle_sql()
    df = E.queries()[name](spark, SF01)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(oracles[name])
    msg = compare(rows, df.columns, cur.fetchall(), [d[0] for d in cur.description])
    assert msg is None, msg
