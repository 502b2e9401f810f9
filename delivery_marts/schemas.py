"""Declared shapes: the raw feed, the seven normalised tables and the two marts.

Field nullability and VARCHAR lengths *are* the NOT NULL and length constraints;
:mod:`delivery_marts.operators.constraints` derives its checks from them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Ids and sums are 64 bits wide: a feed of this kind passes two billion orders, and one
# much-repeated line two billion pieces, long before 100 TB. In Spark's rows and in parquet
# the wider type costs nothing.
ID = SUM = T.LongType()
INT, TEXT, MOMENT = T.IntegerType(), T.StringType(), T.TimestampNTZType()


def _struct(*fields: tuple) -> T.StructType:
    """(name, type) is nullable, (name, type, False) is not."""
    return T.StructType([T.StructField(*f) for f in fields])


# Column names, types, lengths and nullability of the data contract.

RAW_FEED = _struct(
    ("order_id", ID),
    ("user_id", ID),
    ("user_phone", TEXT),
    ("store_id", ID),
    ("store_address", TEXT),
    ("driver_id", ID),
    ("driver_phone", TEXT),
    ("item_id", ID),
    ("item_title", TEXT),
    ("item_category", TEXT),
    ("address_text", TEXT),
    ("created_at", MOMENT),
    ("paid_at", MOMENT),
    ("delivery_started_at", MOMENT),
    ("delivered_at", MOMENT),
    ("canceled_at", MOMENT),
    ("payment_type", TEXT),
    ("order_discount", INT),
    ("order_cancellation_reason", TEXT),
    ("delivery_cost", INT),
    ("item_price", INT),
    ("item_discount", INT),
    ("item_replaced_id", ID),
    ("item_quantity", INT),
    ("item_canceled_quantity", INT),
)

USERS = _struct(("user_id", ID, False), ("user_phone", T.VarcharType(20), False))

STORES = _struct(("store_id", ID, False), ("store_address", T.VarcharType(255), False))

DRIVERS = _struct(("driver_id", ID, False), ("driver_phone", T.VarcharType(20), False))

ITEMS = _struct(
    ("item_id", ID, False),
    ("item_title", T.VarcharType(100), False),
    ("item_category", T.VarcharType(50), False),
)

ORDERS = _struct(
    ("order_id", ID, False),
    ("user_id", ID, False),
    ("store_id", ID, False),
    ("address_text", T.VarcharType(255), False),
    ("created_at", MOMENT, False),
    ("paid_at", MOMENT),
    ("delivery_started_at", MOMENT),
    ("delivered_at", MOMENT),
    ("canceled_at", MOMENT),
    ("payment_type", T.VarcharType(20), False),
    ("order_discount", INT),
    ("order_cancellation_reason", T.VarcharType(100)),
    ("delivery_cost", INT, False),
    ("status", T.VarcharType(20)),
)

ORDER_ITEMS = _struct(
    ("order_item_id", ID, False),
    ("order_id", ID, False),
    ("item_id", ID, False),
    ("item_quantity", SUM, False),
    ("item_price", INT, False),
    ("item_discount", INT),
    ("item_canceled_quantity", SUM),
    ("replaced_by_item_id", ID),
)

DELIVERY_ASSIGNMENTS = _struct(
    ("assignment_id", ID, False),
    ("order_id", ID, False),
    ("driver_id", ID, False),
    ("assigned_at", MOMENT, False),
    ("unassigned_at", MOMENT),
)

ORDERS_MART = _struct(
    ("order_id", ID, False),
    ("user_id", ID, False),
    ("store_id", ID, False),
    ("driver_id", ID),
    ("cash_flows", T.DecimalType(14, 2)),
    ("revenue", T.DecimalType(14, 2)),
    ("status", T.VarcharType(20)),
    ("order_cancellation_reason", T.VarcharType(100)),
    ("is_cancel_error", INT),
    ("is_cancel_after_delivery", INT),
    ("city", T.VarcharType(100)),
    ("year", INT),
    ("month", INT),
    ("day", INT),
)

ITEMS_MART = _struct(
    ("store_id", ID, False),
    ("item_category", T.VarcharType(100)),
    ("item_id", ID, False),
    ("item_title", T.VarcharType(255)),
    ("item_cash_flows", T.DecimalType(14, 2)),
    ("ordered_qty", INT),
    ("canceled_qty", INT),
    ("orders_cnt", INT),
    ("orders_with_canceled_items", INT),
    ("year", INT),
    ("month", INT),
    ("day", INT),
    ("city", T.VarcharType(100)),
)


@dataclass(frozen=True)
class Reference:
    """A foreign key: ``column`` must occur as ``parent_key`` in ``parent``."""

    column: str
    parent: str
    parent_key: str


@dataclass(frozen=True)
class TableSpec:
    """One target table with every rule declared on it.

    ``natural_key`` names a row where the primary key is generated (and in reports
    on frames that have not been keyed yet). ``checks`` are SQL predicates; as in
    any SQL CHECK, a predicate that comes out NULL passes.
    """

    name: str
    schema: T.StructType
    primary_key: tuple[str, ...]
    natural_key: tuple[str, ...]
    references: tuple[Reference, ...] = ()
    checks: dict[str, str] = field(default_factory=dict)
    unique: dict[str, tuple[str, ...]] = field(default_factory=dict)
    # Columns whose NULL is one value with another in a unique rule.
    unique_nulls: dict[str, int] = field(default_factory=dict)
    defaults: dict[str, int] = field(default_factory=dict)


# Metadata of a column that a stored table is bucketed by: the number of buckets.
BUCKETS = "stored_buckets"

LINE_GROUP = ("order_id", "item_id", "item_price", "item_discount", "replaced_by_item_id")
# Fixed value: in rules on line groups a missing replacement is this id.
NO_REPLACEMENT = -1
ASSIGNMENT_ORDER = ("order_id", "driver_id", "assigned_at", "unassigned_at")

TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        TableSpec("users", USERS, ("user_id",), ("user_id",)),
        TableSpec("stores", STORES, ("store_id",), ("store_id",)),
        TableSpec("drivers", DRIVERS, ("driver_id",), ("driver_id",)),
        TableSpec("items", ITEMS, ("item_id",), ("item_id",)),
        TableSpec(
            "orders",
            ORDERS,
            ("order_id",),
            ("order_id",),
            references=(
                Reference("user_id", "users", "user_id"),
                Reference("store_id", "stores", "store_id"),
            ),
            defaults={"order_discount": 0},
        ),
        TableSpec(
            "order_items",
            ORDER_ITEMS,
            ("order_item_id",),
            LINE_GROUP,
            references=(
                Reference("order_id", "orders", "order_id"),
                Reference("item_id", "items", "item_id"),
                Reference("replaced_by_item_id", "items", "item_id"),
            ),
            checks={
                "item_quantity_positive": "item_quantity > 0",
                "item_price_positive": "item_price > 0",
                "item_discount_percent": "item_discount BETWEEN 0 AND 100",
                "item_canceled_quantity_not_negative": "item_canceled_quantity >= 0",
            },
            unique={"order_item_group": LINE_GROUP},
            unique_nulls={"replaced_by_item_id": NO_REPLACEMENT},
            defaults={"item_discount": 0, "item_canceled_quantity": 0},
        ),
        TableSpec(
            "delivery_assignments",
            DELIVERY_ASSIGNMENTS,
            ("assignment_id",),
            ASSIGNMENT_ORDER,
            references=(
                Reference("order_id", "orders", "order_id"),
                Reference("driver_id", "drivers", "driver_id"),
            ),
            checks={"interval_order": "unassigned_at IS NULL OR unassigned_at >= assigned_at"},
        ),
    )
}

ITEMS_MART_KEY = ("store_id", "item_id", "year", "month", "day", "city")

MARTS: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        TableSpec("orders_datamart", ORDERS_MART, ("order_id",), ("order_id",)),
        TableSpec("items_datamart", ITEMS_MART, ITEMS_MART_KEY, ITEMS_MART_KEY),
    )
}


def computed_schema(schema: T.StructType) -> T.StructType:
    """A mart as the plans return and publish it: money as double, counts as bigint.

    The declared decimals and ints cannot hold every sum that may come up.
    """
    wide = {T.DecimalType: T.DoubleType()}
    counts = ("ordered_qty", "canceled_qty", "orders_cnt", "orders_with_canceled_items")
    return T.StructType(
        [
            T.StructField(f.name, SUM if f.name in counts else wide.get(type(f.dataType), f.dataType))
            for f in storage_schema(schema)
        ]
    )


def storage_schema(schema: T.StructType) -> T.StructType:
    """The same columns as files hold them: VARCHAR is string, everything nullable."""
    return T.StructType(
        [
            T.StructField(f.name, TEXT if isinstance(f.dataType, T.VarcharType) else f.dataType)
            for f in schema
        ]
    )
