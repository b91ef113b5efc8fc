"""Every named query against its SQL on the smallest tables."""

import compare
import pytest

import __spark_entry__ as contract

QUERIES = contract.queries()
ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def con(data):
    return compare.connect(data)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, con, name):
    df = QUERIES[name](spark, data)
    if name in ORACLES:
        assert compare.difference(df, con, ORACLES[name]) is None
    else:
        assert df.columns and df.count() >= 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).columns == ["host", "pages", "min_build_id"]
