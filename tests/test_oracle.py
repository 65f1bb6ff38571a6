"""Every registered query against its SQL oracle (DuckDB) on the sf0.001 tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from ordermart.plans.catalog import QUERIES
from ordermart.plans.oracle import SQL
from scripts.check_oracle import compare, duck_connection
from tests.conftest import SF_SMALL

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(SQL) == set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(NAMES) >= 52


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    assert compare(df, con, entry.oracle_sql()[name]) == []


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["market_segment", "revenue", "revenue_share"]
    assert df.count() == 5
