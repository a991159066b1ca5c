"""Every query of the catalogue has an SQL twin and gives the twin's rows (smallest tables)."""

import pytest

import __spark_entry__ as entry
from tools.check_sql import compare, connect

SF = "/root/testdata/sf0.001"
CATALOG = entry._catalog()
QUERIES, SQL = CATALOG.QUERIES, CATALOG.SQL


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_a_twin():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, con, name):
    ok, note = compare(spark, con, SF, name, QUERIES[name], SQL.get(name))
    assert ok, note
