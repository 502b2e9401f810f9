"""Order headers out of order lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delivery_marts.functions import order_status
from delivery_marts.operators.ordering import FILE, ROW, earliest, file_of, known, rank_if_known
from delivery_marts.schemas import ORDERS

HEADER_COLUMNS = [name for name in ORDERS.names if name not in ("order_id", "status")]


def order_headers(feed: DataFrame) -> DataFrame:
    """One row per order: in its first file, each column's first non-NULL value.

    A column that is NULL all through the first file stays NULL though a later file may
    fill it. So every column's first non-NULL value over *all* files is found together
    with its rank, and dropped if it does not stem from the order's first file. That makes
    one aggregate and one shuffle of what would be two (per file, then per order).
    """
    rank = earliest(feed)
    found = []
    for name in HEADER_COLUMNS:
        known_at = rank_if_known(F.col(name), rank)
        found += [F.min_by(name, known_at).alias(name), F.min(known_at).alias(f"{name}_rank")]
    per_order = known(feed, "order_id").groupBy("order_id").agg(F.min(rank).alias("first_rank"), *found)

    first_file = file_of(feed, F.col("first_rank"))
    in_first_file = [
        F.when(file_of(feed, F.col(f"{name}_rank")) == first_file, F.col(name)).alias(name)
        for name in HEADER_COLUMNS
    ]
    return per_order.select("order_id", *in_first_file)


def with_status(orders: DataFrame) -> DataFrame:
    return orders.withColumn("status", order_status())


def file_order_ends(feed: DataFrame) -> DataFrame:
    """Per file and order, the first known delivery and cancellation times.

    The two keys are grouped as one struct. That leaves the rows partitioned by the
    struct, so a join on the two columns shuffles them again, and that is wanted:
    adaptive execution splits a hot key only where both sides come straight from a
    shuffle, and these rows are the small side.
    """
    row = F.col(ROW)
    first_known = [
        F.min_by(name, rank_if_known(F.col(name), row)).alias(name)
        for name in ("delivered_at", "canceled_at")
    ]
    key = F.struct(FILE, "order_id").alias("key")
    return known(feed, "order_id").groupBy(key).agg(*first_known).select("key.*", "delivered_at", "canceled_at")
