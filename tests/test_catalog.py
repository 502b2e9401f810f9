import pytest

from __spark_entry__ import entry, oracle_sql, queries
from delivery_marts.catalog.queries import QUERIES
from tools.compare import open_tables, results

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return open_tables(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(queries())
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, db, name):
    got, want = results(spark, db, name, SF_DIR)
    assert got[0] == want[0]
    assert got[1] == want[1]
    assert got[1], "a query without rows proves nothing"


def test_flagship_has_one_row_per_order(spark):
    mart = entry(spark)
    assert mart.count() == mart.select("order_id").distinct().count() > 0
