"""Every registered query against its DuckDB oracle on sf0.001."""

import pytest

import __spark_entry__ as E
from tests.oracle_compare import compare, duck
from tickloom.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
Q = E.queries()
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(SQL) <= set(Q)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    compare(spark, con, Q[name], SQL[name], SF)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "mean_close" in df.columns
