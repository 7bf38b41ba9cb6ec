"""Every registered query against its DuckDB twin on the smallest driver tables."""

import pytest

import __spark_entry__ as entry
from ledgerline.plans import registry
from oracle import registry as oracle_registry
from oracle.compare import compare, connect
from tests.conftest import SF_SMALL

KEYS = sorted(registry.QUERIES)


@pytest.fixture(scope="module")
def con():
    return connect(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(oracle_registry.SQL) == set(registry.QUERIES)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_duckdb(spark, con, key):
    out = compare(spark, con, SF_SMALL, key, entry.queries()[key], entry.oracle_sql()[key])
    assert out.ok, out.detail


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["region", "city", "gmv_mmk", "total_orders"]
    assert df.count() > 0
