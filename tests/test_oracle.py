"""Every registered query equals its DuckDB oracle (sf0.001; the driver checks sf0.01)."""

import pytest

import __spark_entry__ as entry
from compare import compare, duck
from conftest import SF_SMALL
from indexforge.plans.catalog import QUERIES
from indexforge.plans.oracle import ORACLE

KEYS = sorted(QUERIES)  # the training-data queries have tests of their own


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    ok, msg = compare(entry.queries()[key](spark, SF_SMALL), con, entry.oracle_sql()[key])
    assert ok, f"{key}: {msg}"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["date", "ticker", "close_price", "weight", "market_cap", "index_type"]
    assert df.count() > 0
