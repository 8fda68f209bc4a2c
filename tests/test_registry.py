"""Every registered query against DuckDB on the smallest tables."""

from __future__ import annotations

import pytest
from compare import connect, difference

import __spark_entry__ as contract

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_contract_names():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) > 170


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 10 and rows[0]["revenue"] >= rows[-1]["revenue"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    if name in ORACLES:
        assert difference(df, con, ORACLES[name]) is None
    else:
        assert df.count() > 0
