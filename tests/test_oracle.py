"""Every registered query against its DuckDB oracle (the driver's check),
on the smallest driver tables."""

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"
NAMES = sorted(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    # the optional corpus queries have SQL only where SQL can express them
    optional = set(E.corpus.QUERIES) | {"pipeline"} if E.corpus else set()
    assert set(E.queries()) - optional == set(E.oracle_sql()) - optional
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert df.count() >= 0
        return
    r = compare(df, con, sql)
    assert r["cols_ok"], r
    assert r["rows_ok"], r
    assert r["hash_ok"], r["diff"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["CompanyName", "Total_Orders", "Total_Revenue"]
    assert df.count() > 0
