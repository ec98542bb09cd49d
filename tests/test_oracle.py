"""Every registered query against its DuckDB oracle SQL (row count, columns, value hash)."""

import pytest

import __spark_entry__ as E
from fundtrail import registry
from tests.conftest import SF_MID, SF_SMALL
from tests.oracle_check import compare, duck

QUERIES, ORACLE = registry.spark_queries(), registry.oracle_sql()
NAMES = sorted(QUERIES)
FLAGSHIPS = ("customer_features_all_spans", "customer_features_short_spans", "location_features")


def test_every_query_has_oracle_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def con_small():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle_small(spark, con_small, name):
    r = compare(spark, name, SF_SMALL, QUERIES[name], ORACLE[name], con_small)
    assert r["ok"], r


@pytest.mark.parametrize("name", FLAGSHIPS)
def test_flagship_matches_oracle_mid(spark, name):
    r = compare(spark, name, SF_MID, QUERIES[name], ORACLE[name])
    assert r["rows_spark"] > 0, r
    assert r["ok"], r


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "entity_id" and len(df.columns) == 65
