from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from delivery_marts.operators.ordering import FILE, ROW
from delivery_marts.schemas import RAW_FEED, TABLES, storage_schema
from delivery_marts.session import configure

FEED_SCHEMA = T.StructType([*RAW_FEED.fields, T.StructField(FILE, T.LongType()), T.StructField(ROW, T.LongType())])


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    session = (
        SparkSession.builder.master("local[4]")
        .appName("delivery-marts-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.default.parallelism", "1")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


def at(clock: str | None) -> dt.datetime | None:
    """'10:30' on the fixtures' day."""
    return dt.datetime.fromisoformat(f"2024-01-05 {clock}") if clock else None


LINE = {
    "order_id": 1,
    "user_id": 1,
    "user_phone": "8 (900) 123-45-67",
    "store_id": 1,
    "store_address": "Store street",
    "driver_id": 1,
    "driver_phone": "+7 900 765-43-21",
    "item_id": 1,
    "item_title": "milk",
    "item_category": "dairy",
    "address_text": "Москва, ул. 1",
    "created_at": at("10:00"),
    "paid_at": at("10:05"),
    "delivery_started_at": at("10:30"),
    "delivered_at": at("11:00"),
    "canceled_at": None,
    "payment_type": "card",
    "order_discount": 0,
    "order_cancellation_reason": None,
    "delivery_cost": 100,
    "item_price": 100,
    "item_discount": 0,
    "item_replaced_id": None,
    "item_quantity": 1,
    "item_canceled_quantity": 0,
}


def make_feed(spark: SparkSession, *files: list[dict]) -> DataFrame:
    """A feed out of lists of overrides, one list per file, rows in order."""
    rows = [
        [*({**LINE, **line}[name] for name in RAW_FEED.names), file_no, row_no]
        for file_no, lines in enumerate(files)
        for row_no, line in enumerate(lines)
    ]
    return spark.createDataFrame(rows, FEED_SCHEMA)


def make_table(spark: SparkSession, name: str, *rows: dict, base: dict | None = None) -> DataFrame:
    schema = storage_schema(TABLES[name].schema)
    return spark.createDataFrame([[{**(base or {}), **row}.get(c) for c in schema.names] for row in rows], schema)


ORDER = {
    "order_id": 1, "user_id": 1, "store_id": 1, "address_text": "Москва, ул. 1", "created_at": at("10:00"),
    "payment_type": "card", "order_discount": 0, "delivery_cost": 100, "status": "delivered",
    "delivered_at": at("11:00"),
}
ORDER_LINE = {
    "order_item_id": 1, "order_id": 1, "item_id": 1, "item_quantity": 1, "item_price": 100,
    "item_discount": 0, "item_canceled_quantity": 0,
}
ASSIGNMENT = {
    "assignment_id": 1, "order_id": 1, "driver_id": 1, "assigned_at": at("10:30"), "unassigned_at": at("11:00"),
}


BASES = {
    "users": {"user_id": 1, "user_phone": "79001234567"},
    "stores": {"store_id": 1, "store_address": "Store street"},
    "drivers": {"driver_id": 1, "driver_phone": "79007654321"},
    "items": {"item_id": 1, "item_title": "milk", "item_category": "dairy"},
    "orders": ORDER,
    "order_items": ORDER_LINE,
    "delivery_assignments": ASSIGNMENT,
}


def clean_tables(spark: SparkSession, **rows: list[dict]) -> dict[str, DataFrame]:
    """A set of tables that breaks no rule; give rows to replace a table's own."""
    return {name: make_table(spark, name, *rows.get(name, [{}]), base=BASES[name]) for name in TABLES}


def values(df: DataFrame, *columns: str) -> list[tuple]:
    """Rows as tuples, sorted with NULLs last."""
    rows = [tuple(r) for r in df.select(*(columns or df.columns)).collect()]
    return sorted(rows, key=lambda row: [(v is None, str(type(v)), v if v is not None else 0) for v in row])
