"""Every registered query against its DuckDB oracle (order-insensitive, names must match)."""

import os

import pytest

import __spark_entry__ as E
import oracle_queries
from paths import SF0001
from oracle_compare import compare, duck
from stratum.plans.registry import QUERIES

ORACLE = oracle_queries.oracle_sql()
# STRATUM_ORACLE_SF=/root/testdata/sf0.01 reproduces the driver's correctness gate
SF = os.environ.get("STRATUM_ORACLE_SF", SF0001)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF), con, ORACLE[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[0] == "borough" and df.count() > 0
