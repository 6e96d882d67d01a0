"""Every registered query against its DuckDB oracle on sf0.001 / sf0.01."""

import os

import pytest

import __spark_entry__ as E
from tests.oracle import compare, duck

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    r = compare(df, con, E.oracle_sql()[name])
    assert r["columns"], r
    assert r["rows"][0] == r["rows"][1], r
    assert r["hash"], r


def test_every_query_runs(spark):
    for name, fn in E.queries().items():
        df = fn(spark, SF)
        assert df.columns, name
