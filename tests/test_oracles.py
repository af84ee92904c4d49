"""Registered queries against their DuckDB oracles on sf0.001, streams
included (python tests/check_oracles.py runs them at sf0.01)."""

import pytest

import __spark_entry__ as E
from lakeledger.plans import queries as Q
from harness import compare, duck

SF = "/root/testdata/sf0.001"
@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, E.queries()[name], E.oracle_sql()[name], SF)
    assert r["match"], r


def test_every_query_has_an_oracle():
    assert set(Q.QUERIES) == set(Q.ORACLES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["table_name", "server"] and df.count() == 12
