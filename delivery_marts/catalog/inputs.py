"""Inputs of the named queries: the feed, its normalised tables, and spoiled copies.

On good data a check finds nothing, which proves little. The spoiled copies have known
faults put into whole tables by plain expressions, the same here and in the SQL.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delivery_marts.operators.assignments import assignment_intervals
from delivery_marts.operators.headers import HEADER_COLUMNS, file_order_ends
from delivery_marts.operators.lines import QUANTITIES, REQUIRED, drop_unkeyed_lines
from delivery_marts.operators.constraints import RowRules
from delivery_marts.plans.normalize import ADD_KEYS, feed_key_bounds, keyed, normalize
from delivery_marts.plans.pipeline import layout_buckets
from delivery_marts.schemas import ASSIGNMENT_ORDER, LINE_GROUP, NO_REPLACEMENT, RAW_FEED, TABLES
from delivery_marts.functions import unfill_replaced_id
from delivery_marts.session import configure, scratch_path
from delivery_marts.sinks.tables import write_all, write_table
from delivery_marts.sources.tables import read_table
from delivery_marts.sources.driver_tables import read_feed, store_feed


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_feed(configure(spark), sf_dir)


# What each table takes of the feed.
FEED_COLUMNS = {
    "users": ["user_id", "user_phone"],
    "stores": ["store_id", "store_address"],
    "drivers": ["driver_id", "driver_phone"],
    "items": ["item_id", "item_title", "item_category"],
    "orders": ["order_id", *HEADER_COLUMNS],
    "order_items": [*REQUIRED, "item_replaced_id", *QUANTITIES],
    "delivery_assignments": ["order_id", "driver_id", "delivery_started_at", "delivered_at", "canceled_at"],
}


def stored_feed(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """The feed written once, with what the named tables (default: all) take of it.

    For queries that read it several times: the feed is a join of whole tables.
    """
    needed = {column for name in names or TABLES for column in FEED_COLUMNS[name]}
    columns = [name for name in RAW_FEED.names if name in needed]
    return store_feed(configure(spark), sf_dir, scratch_path(spark, "feed"), columns)


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return normalize(feed(spark, sf_dir))


def kept_tables(spark: SparkSession, normalised: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Normalised tables written once and read back as they are, still without generated keys, for
    queries that test them against each other."""
    out = {}

    def keep(name: str) -> None:
        path = scratch_path(spark, f"kept-{name}")
        write_table(normalised[name], path)
        out[name] = spark.read.schema(normalised[name].schema).parquet(path)

    write_all({name: partial(keep, name) for name in normalised})
    return {name: out[name] for name in normalised}


def stored(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A normalised table written to the shared folder and read back as a published one is."""
    path = scratch_path(spark, name)
    write_table(keyed(name, tables(spark, sf_dir)[name]), path)
    return read_table(spark, path, TABLES[name].schema)


def laid_out(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """Tables stored as a load stores them, in buckets by order, and read back so."""
    source = stored_feed(spark, sf_dir, *names, *ADD_KEYS)
    bounds = feed_key_bounds(source)
    buckets = layout_buckets(spark, bounds)
    out, normalised = {}, normalize(source, *names)
    for name in names:
        path = scratch_path(spark, f"laid-out-{name}")
        write_table(keyed(name, normalised[name], bounds.get(name)), path, buckets)
        out[name] = read_table(spark, path, TABLES[name].schema, buckets)
    return out


def observed_counts(spark: SparkSession, frames: dict[str, DataFrame]) -> DataFrame:
    """Row rules of frames as the tasks count them that write the frames."""
    rows = []
    for name, frame in frames.items():
        rules = RowRules(TABLES[name])
        write_table(frame, scratch_path(spark, f"observed-{name}"), observe=rules.observe)
        rows += [*rules.counts, (name, "rows", "rows", rules.rows)]
    return spark.createDataFrame(rows, "table_name string, kind string, constraint_name string, violations long")


def spoiled_orders(orders: DataFrame) -> DataFrame:
    urgent = F.col("payment_type") == "1-URGENT"
    return orders.withColumns(
        {
            "user_id": F.when(urgent, -F.col("user_id")).otherwise(F.col("user_id")),
            "store_id": F.when(urgent, F.col("store_id") + 5).otherwise(F.col("store_id")),
        }
    )


def spoiled_lines(lines: DataFrame) -> DataFrame:
    lost = F.when(F.col("item_discount") > 0, -F.col("order_id"))
    lost = lost.when(F.col("item_canceled_quantity") == 4, None)
    return lines.withColumns(
        {
            "order_id": lost.otherwise(F.col("order_id")),
            "item_id": F.when(F.col("item_price") > 140, F.col("item_id") + 50).otherwise(F.col("item_id")),
            "replaced_by_item_id": F.coalesce("replaced_by_item_id", F.col("item_quantity").cast("int")),
        }
    )


def spoiled_assignments(assignments: DataFrame) -> DataFrame:
    still_open = F.col("unassigned_at").isNull()
    return assignments.withColumns(
        {
            "order_id": F.when(still_open, -F.col("order_id")).otherwise(F.col("order_id")),
            "driver_id": F.when(still_open, F.col("driver_id")).otherwise(-F.col("driver_id")),
        }
    )


def unmerged_lines(source: DataFrame) -> DataFrame:
    """Lines before they are merged; some without a replacement once more, with the id that
    stands for none."""
    lines = drop_unkeyed_lines(source).withColumn(
        "replaced_by_item_id", unfill_replaced_id(F.col("item_replaced_id"))
    )
    again = lines.where("replaced_by_item_id IS NULL AND item_quantity = 7").withColumn(
        "replaced_by_item_id", F.lit(NO_REPLACEMENT)
    )
    return lines.unionByName(again).select(*LINE_GROUP, "item_quantity", "item_canceled_quantity")


def paired_keys(table: DataFrame, key: str) -> DataFrame:
    """Generated keys halved, so that each stands on two rows (the first on one)."""
    return table.withColumn(key, F.expr(f"{key} div 2"))


def shifted_lines(lines: DataFrame) -> DataFrame:
    """Numbers moved so that each CHECK on a line is broken by some rows."""
    return lines.withColumns(
        {
            "item_quantity": F.col("item_quantity") - 10,
            "item_price": F.col("item_price") - 110,
            "item_discount": F.col("item_discount") + 95,
            "item_canceled_quantity": F.col("item_canceled_quantity") - 2,
        }
    )


def unfiltered_intervals(source: DataFrame) -> DataFrame:
    return assignment_intervals(source).select(*ASSIGNMENT_ORDER)


def candidates(source: DataFrame) -> dict[str, DataFrame]:
    """Rows competing for each primary key, before deduplication."""
    return {
        "users": source.select("user_id", "user_phone").distinct(),
        "stores": source.select("store_id", "store_address").distinct(),
        "drivers": source.select("driver_id", "driver_phone").distinct(),
        "items": source.select("item_id", "item_title", "item_category").distinct(),
        "orders": file_order_ends(source),
    }


def lengthened(normalised: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Texts repeated so that some, not all, outgrow their declared length."""
    times = {
        "users": {"user_phone": 2},
        "stores": {"store_address": 16},
        "drivers": {"driver_phone": 2},
        "items": {"item_title": 15, "item_category": 11},
        "orders": {"address_text": 18, "payment_type": 2, "order_cancellation_reason": 8, "status": 3},
    }
    return {
        name: normalised[name].withColumns({c: F.repeat(F.col(c), F.lit(n)) for c, n in columns.items()})
        for name, columns in times.items()
    }
