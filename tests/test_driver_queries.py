"""Every registered query against its DuckDB oracle (as the driver does)."""

import pytest

import __spark_entry__ as E
from starloom.plans.driver_tables import QUERIES
from tests.conftest import SF_ORACLE
from tests.oracle_check import compare, duck

KEYS = sorted(E.oracle_sql())  # the training-data queries beyond SQL have tests of their own


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and df.columns == ["market", "n_facts", "market_size"]


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    res = compare(spark, key, E.queries()[key], E.oracle_sql().get(key), SF_ORACLE, con)
    assert res["status"] == "ok", res
