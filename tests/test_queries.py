"""Every registered query against its SQL on the smallest data."""

import duckdb
import pytest

import check
from lotwatch.plans.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return check.duck(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con: duckdb.DuckDBPyConnection, sf, name):
    ok, note = check.compare(spark, con, sf, name)
    assert ok, note


def test_sql_belongs_to_queries():
    assert set(ORACLES) <= set(QUERIES)
    assert sorted(set(QUERIES) - set(ORACLES)) == ["alerts_with_outliers", "outlier_screen"]
