"""Every catalogue query with an SQL oracle matches DuckDB (sf0.001)."""

import pytest

import __spark_entry__ as E
from tests.oracle_harness import compare, duck
from tests.conftest import SF_SMALL

ORACLES = E.oracle_sql()
NAMES = sorted(ORACLES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLES[name])
    diff = compare(rows, df.columns, cur.fetchall(), [d[0] for d in cur.description])
    assert diff is None, diff


def test_every_query_registered_with_callable():
    qs = E.queries()
    assert len(qs) >= 130
    assert set(ORACLES) <= set(qs)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["window_start", "window_end", "rmse", "mae", "bias", "n_samples"]
    assert df.count() > 0
