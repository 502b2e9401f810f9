"""The named queries: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delivery_marts.catalog import inputs
from delivery_marts.functions import (
    address_city,
    cancel_after_delivery_flag,
    cancel_error_flag,
    date_parts,
    nan_to_null,
    normalize_phone,
    unfill_replaced_id,
)
from delivery_marts.operators import constraints, quality
from delivery_marts.operators.assignments import current_driver, driver_history, open_assignments
from delivery_marts.operators.dimensions import latest_attributes
from delivery_marts.operators.joins import left_join_many
from delivery_marts.operators.lines import drop_unkeyed_lines, order_lines_by_file
from delivery_marts.operators.ordering import known
from delivery_marts.plans.marts import item_cells, items_mart, order_money, orders_mart
from delivery_marts.plans.normalize import NORMALISED, feed_key_bounds, keyed, normalize
from delivery_marts.schemas import ITEMS_MART, MARTS, ORDERS_MART, RAW_FEED, TABLES
from delivery_marts.sinks.conform import conform
from delivery_marts.sinks.tables import row_counts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__.removeprefix("q_")] = function
    return function


# Feed and normalisation


@query
def raw_feed_scan(spark, sf_dir):
    return inputs.feed(spark, sf_dir).select("file_no", *RAW_FEED.names)


@query
def scan_table(spark, sf_dir):
    return inputs.stored(spark, sf_dir, "orders")


@query
def q_normalize_phone(spark, sf_dir):
    phones = inputs.feed(spark, sf_dir).select("order_id", "user_id", "user_phone", "driver_phone")
    return phones.withColumns(
        {c: normalize_phone(F.col(c)) for c in ("user_phone", "driver_phone")}
    )


@query
def q_nan_to_null(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    price = F.when(F.col("l_linenumber") == 1, F.lit(float("nan"))).otherwise(F.col("l_extendedprice"))
    return lines.select("l_orderkey", "l_linenumber", nan_to_null(price).alias("price"))


@query
def replaced_id_sentinel(spark, sf_dir):
    filled = F.coalesce("item_replaced_id", F.lit(-1))
    return inputs.feed(spark, sf_dir).select(
        "order_id",
        "item_id",
        filled.alias("filled_id"),
        unfill_replaced_id(filled).alias("replaced_by_item_id"),
    )


@query
def order_lines_null_key_drop(spark, sf_dir):
    return drop_unkeyed_lines(inputs.feed(spark, sf_dir)).select(
        "order_id", "item_id", "item_price", "item_discount", "item_quantity"
    )


@query
def order_lines_file(spark, sf_dir):
    return order_lines_by_file(inputs.feed(spark, sf_dir))


@query
def q_driver_history(spark, sf_dir):
    return driver_history(inputs.feed(spark, sf_dir))


def _table(name: str) -> Query:
    return lambda spark, sf_dir: inputs.tables(spark, sf_dir)[name]


QUERIES.update(
    dim_users=_table("users"),
    dim_stores=_table("stores"),
    dim_drivers=_table("drivers"),
    dim_items=_table("items"),
    orders_normalized=_table("orders"),
    order_items=_table("order_items"),
    delivery_assignments=_table("delivery_assignments"),
)


def _keyed(name: str) -> Query:
    def run(spark, sf_dir):
        source = inputs.stored_feed(spark, sf_dir, name)
        return keyed(name, NORMALISED[name](source), feed_key_bounds(source, name)[name])

    return run


QUERIES.update(order_items_keyed=_keyed("order_items"), assignments_keyed=_keyed("delivery_assignments"))


@query
def order_status(spark, sf_dir):
    return inputs.tables(spark, sf_dir)["orders"].select("order_id", "status")


def _on_assignments(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(inputs.tables(spark, sf_dir)["delivery_assignments"])


QUERIES.update(
    open_assignments=_on_assignments(open_assignments), current_driver=_on_assignments(current_driver)
)


@query
def q_row_counts(spark, sf_dir):
    return row_counts(normalize(inputs.stored_feed(spark, sf_dir)))


# Marts. Everything follows lazily from the given tables; the jobs join tables read back from
# disk, where adaptive execution can split a hot order.


@query
def orders_left_items(spark, sf_dir):
    t = inputs.tables(spark, sf_dir)
    orders = t["orders"].select("order_id", "user_id", "store_id", "status", "order_discount")
    return left_join_many(orders, t["order_items"], "order_id")


@query
def orders_current_driver(spark, sf_dir):
    t = inputs.tables(spark, sf_dir)
    drivers = current_driver(t["delivery_assignments"])
    return t["orders"].select("order_id", "status").join(drivers, "order_id", "left")


@query
def items_left_join(spark, sf_dir):
    t = inputs.tables(spark, sf_dir)
    return t["order_items"].join(t["items"], "item_id", "left")


@query
def store_join_noop(spark, sf_dir):
    """Money per order without the stores; the SQL joins them."""
    t = inputs.tables(spark, sf_dir)
    return order_money(t["orders"], t["order_items"]).select("order_id", "store_id", "cash_flows", "revenue")


@query
def order_cash_flows(spark, sf_dir):
    t = inputs.tables(spark, sf_dir)
    return order_money(t["orders"], t["order_items"]).select("order_id", "cash_flows")


@query
def order_revenue(spark, sf_dir):
    t = inputs.tables(spark, sf_dir)
    return order_money(t["orders"], t["order_items"]).select("order_id", "status", "revenue")


@query
def cancel_flags(spark, sf_dir):
    c = F.col
    return inputs.tables(spark, sf_dir)["orders"].select(
        "order_id",
        "status",
        cancel_error_flag(c("status"), c("order_cancellation_reason")).alias("is_cancel_error"),
        cancel_after_delivery_flag(c("delivered_at"), c("canceled_at")).alias("is_cancel_after_delivery"),
    )


@query
def q_address_city(spark, sf_dir):
    orders = inputs.tables(spark, sf_dir)["orders"]
    return orders.select("order_id", "address_text", address_city(F.col("address_text")).alias("city"))


@query
def order_date_parts(spark, sf_dir):
    orders = inputs.tables(spark, sf_dir)["orders"]
    return orders.select(
        "order_id", *[part.alias(name) for name, part in date_parts(F.col("created_at")).items()]
    )


def _orders_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = inputs.tables(spark, sf_dir)
    return orders_mart(t["orders"], t["order_items"], t["delivery_assignments"])


def _items_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = inputs.tables(spark, sf_dir)
    return items_mart(t["orders"], t["order_items"], t["items"])


QUERIES.update(
    orders_mart=_orders_mart,
    items_mart=_items_mart,
    conform_orders_mart=lambda spark, sf_dir: conform(_orders_mart(spark, sf_dir), ORDERS_MART),
    conform_items_mart=lambda spark, sf_dir: conform(_items_mart(spark, sf_dir), ITEMS_MART),
)


@query
def laid_out_orders_mart(spark, sf_dir):
    t = inputs.laid_out(spark, sf_dir, "orders", "order_items", "delivery_assignments")
    return orders_mart(t["orders"], t["order_items"], t["delivery_assignments"])


@query
def laid_out_items_mart(spark, sf_dir):
    t = inputs.laid_out(spark, sf_dir, "orders", "order_items", "items")
    return items_mart(t["orders"], t["order_items"], t["items"])


def _cell_counts(column: str) -> Query:
    def run(spark, sf_dir):
        t = inputs.tables(spark, sf_dir)
        return item_cells(t["orders"], t["order_items"]).select(
            "created_on", "city", "store_id", "item_id", column
        )

    return run


QUERIES.update(
    item_orders_cnt=_cell_counts("orders_cnt"),
    item_canceled_orders_cnt=_cell_counts("orders_with_canceled_items"),
)


# Constraints


def _marts(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "orders_datamart": orders_mart(t["orders"], t["order_items"], t["delivery_assignments"]),
        "items_datamart": items_mart(t["orders"], t["order_items"], t["items"]),
    }


@query
def not_null_violations(spark, sf_dir):
    t = inputs.kept_tables(spark, normalize(inputs.stored_feed(spark, sf_dir)))
    specs = {**TABLES, **MARTS}
    return constraints.union(
        [
            constraints.row_violations(df, specs[name], constraints.NOT_NULL)
            for name, df in {**t, **_marts(t)}.items()
        ]
    )


@query
def pk_violations(spark, sf_dir):
    source = inputs.stored_feed(spark, sf_dir)
    kept = ("orders", "order_items", "delivery_assignments", "items")
    t = inputs.kept_tables(spark, normalize(source, *kept))
    specs = {**TABLES, **MARTS}
    generated = {
        name: inputs.paired_keys(keyed(name, t[name]), TABLES[name].primary_key[0])
        for name in ("order_items", "delivery_assignments")
    }
    frames = {**inputs.candidates(source), **generated, **_marts(t)}
    return constraints.union(
        [constraints.primary_key_violations(df, specs[name]) for name, df in frames.items()]
    )


@query
def fk_violations(spark, sf_dir):
    t = inputs.kept_tables(spark, normalize(inputs.stored_feed(spark, sf_dir)))
    spoiled = {
        "orders": inputs.spoiled_orders(t["orders"]),
        "order_items": inputs.spoiled_lines(t["order_items"]),
        "delivery_assignments": inputs.spoiled_assignments(t["delivery_assignments"]),
    }
    return constraints.union(
        [constraints.foreign_key_violations(df, TABLES[name], t) for name, df in spoiled.items()]
    )


@query
def check_violations(spark, sf_dir):
    lines = inputs.tables(spark, sf_dir)["order_items"]
    frames = {
        "order_items": inputs.shifted_lines(lines),
        "delivery_assignments": inputs.unfiltered_intervals(inputs.feed(spark, sf_dir)),
    }
    return constraints.union(
        [constraints.row_violations(df, TABLES[name], constraints.CHECK) for name, df in frames.items()]
    )


@query
def length_violations(spark, sf_dir):
    t = inputs.lengthened(inputs.tables(spark, sf_dir))
    return constraints.union(
        [constraints.row_violations(df, TABLES[name], constraints.LENGTH) for name, df in t.items()]
    )


@query
def unique_group_violations(spark, sf_dir):
    lines = inputs.unmerged_lines(inputs.feed(spark, sf_dir))
    return constraints.unique_violations(lines, TABLES["order_items"])


@query
def constraint_counts(spark, sf_dir):
    t = inputs.kept_tables(spark, normalize(inputs.stored_feed(spark, sf_dir)))
    return constraints.violation_counts(t, TABLES)


@query
def observed_rule_counts(spark, sf_dir):
    """On the lines with shifted numbers and on tables with lengthened texts."""
    source = inputs.stored_feed(spark, sf_dir)
    t = normalize(source)
    bounds = feed_key_bounds(source, "order_items")["order_items"]
    lines = {"order_items": inputs.shifted_lines(keyed("order_items", t["order_items"], bounds))}
    return inputs.observed_counts(spark, {**lines, **inputs.lengthened(t)})


# Quality checks, each on the normalised tables and on a spoiled copy


def _both(name: str, normalised: DataFrame, spoiled: DataFrame) -> DataFrame:
    return constraints.union(
        [
            value.select(F.lit(name).alias("check_name"), F.lit(dataset).alias("dataset"), "value")
            for dataset, value in (("normalised", normalised), ("spoiled", spoiled))
        ]
    )


def _orphans(name: str, spoil: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark, sf_dir):
        child_name, ref = quality.ORPHANS[name]
        t = inputs.tables(spark, sf_dir)
        child, parent = t[child_name], t[ref.parent]
        return _both(
            name,
            quality.orphan_check(name, child, parent),
            quality.orphan_check(name, spoil(child), parent),
        )

    return run


QUERIES.update(
    orphan_order_items=_orphans("orphan_order_items", inputs.spoiled_lines),
    orders_without_users=_orphans("orders_without_users", inputs.spoiled_orders),
    orders_without_stores=_orphans("orders_without_stores", inputs.spoiled_orders),
)


@query
def invalid_replaced_items(spark, sf_dir):
    t = inputs.tables(spark, sf_dir)
    lines, items = t["order_items"], t["items"]
    return _both(
        "invalid_replaced_items",
        quality.invalid_replaced_items(lines, items),
        quality.invalid_replaced_items(inputs.spoiled_lines(lines), items),
    )


@query
def duplicate_order_item_groups(spark, sf_dir):
    lines = inputs.tables(spark, sf_dir)["order_items"]
    unmerged = inputs.unmerged_lines(inputs.feed(spark, sf_dir))
    return _both(
        "duplicate_order_item_groups",
        quality.duplicate_order_item_groups(lines),
        quality.duplicate_order_item_groups(unmerged),
    )


@query
def invalid_assignment_dates(spark, sf_dir):
    assignments = inputs.tables(spark, sf_dir)["delivery_assignments"]
    unfiltered = inputs.unfiltered_intervals(inputs.feed(spark, sf_dir))
    return _both(
        "invalid_assignment_dates",
        quality.invalid_assignment_dates(assignments),
        quality.invalid_assignment_dates(unfiltered),
    )


def _phones(name: str) -> Query:
    def run(spark, sf_dir):
        table, phone = quality.PHONES[name]
        cleaned = inputs.tables(spark, sf_dir)[table]
        key = TABLES[table].primary_key[0]
        raw = latest_attributes(known(inputs.feed(spark, sf_dir), key), key, phone)
        return _both(name, quality.non_digit_phones(cleaned, phone), quality.non_digit_phones(raw, phone))

    return run


QUERIES.update({name: _phones(name) for name in quality.PHONES})


@query
def quality_report(spark, sf_dir):
    return quality.quality_report(inputs.kept_tables(spark, normalize(inputs.stored_feed(spark, sf_dir))))
