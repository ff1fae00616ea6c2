"""Every query of the reference's operators against DuckDB, over the whole tables."""

import os

import pytest
from oracle import duck, oracle_rows, rows_of

import __spark_entry__ as registry
from corpusprep.plans import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, sf, con, name):
    columns, rows = rows_of(QUERIES[name](spark, sf))
    expected_columns, expected = oracle_rows(con, ORACLES[name])
    assert columns == expected_columns
    assert sum(rows.values()) > 0
    assert rows == expected


def test_all_are_registered():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(registry.queries()) and set(ORACLES) <= set(registry.oracle_sql())


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test data")
def test_entry(spark):
    assert registry.entry(spark).columns == ["page_id", "message"]
    assert registry.entry(spark).count() > 0
