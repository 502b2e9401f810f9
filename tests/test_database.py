"""Database jobs with the JDBC calls replaced: which tables, how cut, in what order."""

import pytest

from delivery_marts.plans import database
from delivery_marts.schemas import MARTS, TABLES, computed_schema, storage_schema
from tests.conftest import clean_tables


@pytest.fixture
def calls(spark, monkeypatch):
    tables = clean_tables(spark)
    log = []
    monkeypatch.setattr(database, "read_current", lambda *_: tables)
    monkeypatch.setattr(
        database, "read_jdbc", lambda _, url, name, **o: log.append(("whole", name, o)) or tables[name]
    )
    monkeypatch.setattr(
        database,
        "read_jdbc_ranges",
        lambda _, url, name, column, n, **o: log.append(("ranges", name, column, n)) or tables[name],
    )
    monkeypatch.setattr(
        database, "write_jdbc", lambda df, url, name, n, **o: log.append(("write", name, df, n, o))
    )
    return log


def test_large_tables_are_read_in_ranges_and_small_ones_whole(spark, calls):
    database.read_tables(spark, "jdbc:x", ("orders", "order_items", "items"), 10, user="u")
    assert calls == [
        ("ranges", "orders", "order_id", 10),
        ("ranges", "order_items", "order_id", 10),
        ("whole", "items", {"user": "u"}),
    ]


def test_export_writes_parents_first_and_leaves_derived_columns_out(spark, calls):
    database.export_tables(spark, "root", "jdbc:x", 10)
    assert [call[1] for call in calls] == list(TABLES)
    orders = next(call[2] for call in calls if call[1] == "orders")
    assert "status" not in orders.columns
    assert all(call[4] == {"cascadeTruncate": "true"} for call in calls)


@pytest.mark.parametrize("declared", [True, False])
@pytest.mark.parametrize(
    ("build", "name"),
    [(database.build_orders_mart, "orders_datamart"), (database.build_items_mart, "items_datamart")],
)
def test_mart_is_written_in_declared_or_computed_types(spark, calls, build, name, declared):
    build(spark, "jdbc:x", 10, declared=declared)
    _, table, mart, connections, options = calls[-1]
    assert (table, connections, options["keep_declaration"]) == (name, 10, declared)
    want = storage_schema(MARTS[name].schema) if declared else computed_schema(MARTS[name].schema)
    assert [(f.name, f.dataType) for f in mart.schema] == [(f.name, f.dataType) for f in want]
    assert mart.count() == 1
