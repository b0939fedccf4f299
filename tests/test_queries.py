"""Every registered query against its SQL oracle (DuckDB) on the smallest fixture."""

import pytest

import __spark_entry__ as E
from compare import compare, duck
from tidepool.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, QUERIES[name], ORACLE[name], SF)
    assert r["cols_match"] and r["rows_spark"] == r["rows_oracle"] and r["hash_match"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
