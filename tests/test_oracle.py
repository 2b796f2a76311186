"""Every registered query with an SQL counterpart agrees with it, column types included."""

import pytest
from compare import connect, differences

from __spark_entry__ import entry
from basketmart.catalog import QUERIES
from oracle_queries import ORACLES

FOLDER = "/root/testdata/sf0.001"
ROWS_ONLY = {"hypothesis_p_values"}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_only_models_and_p_values_lack_sql():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    assert differences(QUERIES[name](spark, FOLDER), con, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_query_without_sql_returns_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_flagship_query(spark):
    assert entry(spark).count() == 1473


def test_all_invariants_hold(spark):
    values = {r["check_name"]: r["check_value"] for r in QUERIES["invariant_checks"](spark, FOLDER).collect()}
    assert values and set(values.values()) == {"true"}
