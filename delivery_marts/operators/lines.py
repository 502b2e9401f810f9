"""Order lines: equal lines of an order merged into one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delivery_marts.functions import unfill_replaced_id
from delivery_marts.operators.ordering import FILE, known
from delivery_marts.schemas import LINE_GROUP

REQUIRED = [name for name in LINE_GROUP if name != "replaced_by_item_id"]
QUANTITIES = ["item_quantity", "item_canceled_quantity"]


def drop_unkeyed_lines(feed: DataFrame) -> DataFrame:
    """Lines with a NULL in their group key belong to no group and are left out."""
    return known(feed, *REQUIRED)


def grouped_lines(feed: DataFrame) -> DataFrame:
    """The feed's lines with the whole key of their group, still unmerged."""
    return drop_unkeyed_lines(feed).withColumn(
        "replaced_by_item_id", unfill_replaced_id(F.col("item_replaced_id"))
    )


def _merge(feed: DataFrame, *group: str) -> DataFrame:
    totals = [F.coalesce(F.sum(q), F.lit(0)).alias(q) for q in QUANTITIES]
    return grouped_lines(feed).groupBy(*group).agg(*totals)


def order_lines_by_file(feed: DataFrame) -> DataFrame:
    return _merge(feed, FILE, *LINE_GROUP)


def order_lines(feed: DataFrame) -> DataFrame:
    """Lines merged over all files; sums add up, so files need no step of their own."""
    return _merge(feed, *LINE_GROUP)
