"""The same tables and marts kept in a database instead of parquet.

Parquet is what the jobs are made for. These are for tables that already live in a
database, or consumers that only read one. A database write is not all or nothing: each
table commits by itself, and each connection on its own.

A database does not tell the bytes of its tables, so a caller with large ones gives
``input_bytes`` for the session to be sized by; it is left as it was afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from delivery_marts.plans.marts import items_mart, orders_mart
from delivery_marts.schemas import MARTS, TABLES
from delivery_marts.session import Limits, sized
from delivery_marts.sinks.conform import conform
from delivery_marts.sinks.jdbc import write_jdbc
from delivery_marts.sources.jdbc import read_jdbc, read_jdbc_ranges
from delivery_marts.sources.tables import read_current

# Tables that grow with the orders; they are read in ranges of this column.
RANGE_COLUMN = "order_id"
# Columns the database derives by itself.
GENERATED = ("status",)


def read_tables(
    spark: SparkSession, url: str, names: tuple[str, ...], connections: int, **options: str
) -> dict[str, DataFrame]:
    """Tables by name; those with an order id over ``connections`` ranges of it."""
    return {
        name: read_jdbc_ranges(spark, url, name, RANGE_COLUMN, connections, **options)
        if RANGE_COLUMN in TABLES[name].schema.names
        else read_jdbc(spark, url, name, **options)
        for name in names
    }


def export_tables(spark: SparkSession, root: str, url: str, connections: int, **options: str) -> None:
    """Copy the published tables, parents before children.

    Truncating a parent empties its children too, which the following writes fill again.
    Generated keys are written with the rows; a sequence that numbers later rows has to be
    set past them in the database.
    """
    for name, table in read_current(spark, root).items():
        write_jdbc(table.drop(*GENERATED), url, name, connections, cascadeTruncate="true", **options)


def build_orders_mart(
    spark: SparkSession,
    url: str,
    connections: int,
    declared: bool = True,
    input_bytes: int = 0,
    limits: Limits = Limits(),
    **options: str,
) -> None:
    """The orders mart from and to the database. ``declared`` keeps the mart's declaration
    and types; without it the table is made anew from the computed ones."""
    t = read_tables(spark, url, ("orders", "order_items", "delivery_assignments"), connections, **options)
    mart = orders_mart(t["orders"], t["order_items"], t["delivery_assignments"])
    with sized(spark, input_bytes, limits):
        _write_mart("orders_datamart", mart, url, connections, declared, **options)


def build_items_mart(
    spark: SparkSession,
    url: str,
    connections: int,
    declared: bool = True,
    input_bytes: int = 0,
    limits: Limits = Limits(),
    **options: str,
) -> None:
    """The items mart, like ``build_orders_mart``. Its declaration refuses the cells of
    orders without lines, as they have no item."""
    t = read_tables(spark, url, ("orders", "order_items", "items"), connections, **options)
    mart = items_mart(t["orders"], t["order_items"], t["items"])
    with sized(spark, input_bytes, limits):
        _write_mart("items_datamart", mart, url, connections, declared, **options)


def _write_mart(
    name: str, mart: DataFrame, url: str, connections: int, declared: bool, **options: str
) -> None:
    frame = conform(mart, MARTS[name].schema) if declared else mart
    write_jdbc(frame, url, name, connections, keep_declaration=declared, **options)
