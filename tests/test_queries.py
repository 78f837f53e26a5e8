"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import check, duck
from workload import catalogue

QUERIES, SQL = catalogue.QUERIES, catalogue.SQL


@pytest.fixture(scope="module")
def con():
    return duck("0.001")


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    ok, note, _ = check(spark, con, name, QUERIES[name], SQL.get(name), "0.001")
    assert ok is not False, note


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
