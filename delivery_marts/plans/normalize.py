"""Wide feed to seven normalised tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from delivery_marts.operators.assignments import assignment_starts, delivery_assignments
from delivery_marts.operators.dimensions import dim_drivers, dim_items, dim_stores, dim_users
from delivery_marts.operators.headers import order_headers, with_status
from delivery_marts.operators.lines import grouped_lines, order_lines
from delivery_marts.operators.surrogate_keys import KeyBounds, key_assignments, key_bounds, key_order_lines
from delivery_marts.schemas import ASSIGNMENT_ORDER, LINE_GROUP, TABLES
from delivery_marts.sinks.conform import conform


def orders(feed: DataFrame) -> DataFrame:
    return with_status(order_headers(feed))


NORMALISED = {
    "users": dim_users,
    "stores": dim_stores,
    "drivers": dim_drivers,
    "items": dim_items,
    "orders": orders,
    "order_items": order_lines,
    "delivery_assignments": delivery_assignments,
}


def normalize(feed: DataFrame, *names: str) -> dict[str, DataFrame]:
    """The seven tables, or those named, lazily; lines and assignments still without generated keys.

    Each plan scans only the feed columns it needs. Together that is little more than
    one pass over the columns, so the feed is not cached.
    """
    return {name: NORMALISED[name](feed) for name in names or NORMALISED}


ADD_KEYS = {"order_items": key_order_lines, "delivery_assignments": key_assignments}


KEY_SAMPLES = {
    "order_items": (grouped_lines, LINE_GROUP),
    "delivery_assignments": (assignment_starts, ASSIGNMENT_ORDER[:3]),
}


def feed_key_bounds(feed: DataFrame, *names: str) -> dict[str, KeyBounds]:
    """Where the ranges of generated keys begin (default: of both tables that have them), sampled
    from the feed's own columns: that takes two scans of a few columns a table, and none of the
    tables' groupings and joins."""
    return {name: key_bounds(KEY_SAMPLES[name][0](feed), KEY_SAMPLES[name][1]) for name in names or KEY_SAMPLES}


def keyed(name: str, table: DataFrame, bounds: KeyBounds | None = None) -> DataFrame:
    """The table as declared: generated key added, columns in order and typed."""
    add_key = ADD_KEYS.get(name)
    return conform(add_key(table, bounds) if add_key else table, TABLES[name].schema)
