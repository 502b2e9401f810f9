"""Courier assignments as intervals [assigned_at, unassigned_at)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delivery_marts.functions import interval_end
from delivery_marts.operators.headers import file_order_ends
from delivery_marts.operators.ordering import FILE, known
from delivery_marts.schemas import ASSIGNMENT_ORDER


def _starts(feed: DataFrame) -> DataFrame:
    """(order, courier, start) of every line that has them; lines of an order repeat them."""
    return known(feed, "driver_id", "delivery_started_at").select(
        FILE, "order_id", "driver_id", "delivery_started_at"
    )


def assignment_starts(feed: DataFrame) -> DataFrame:
    """The first columns of an assignment's order, as the lines repeat them."""
    starts = _starts(feed).withColumnRenamed("delivery_started_at", "assigned_at")
    return starts.select(*ASSIGNMENT_ORDER[:3])


def _with_ends(starts: DataFrame, feed: DataFrame) -> DataFrame:
    """Every start with the end its *own file* gives the order.

    The starts are the left side: where one order has a huge history, adaptive execution
    splits it over tasks and repeats the single row of ends.
    """
    ends = file_order_ends(feed).select(
        FILE, "order_id", interval_end(F.col("delivered_at"), F.col("canceled_at")).alias("unassigned_at")
    )
    return (
        starts.join(ends, [FILE, "order_id"], "left")
        .withColumnRenamed("delivery_started_at", "assigned_at")
        .select(FILE, *ASSIGNMENT_ORDER)
    )


def driver_history(feed: DataFrame) -> DataFrame:
    """Distinct (order, courier, start) per file."""
    return _starts(feed).distinct()


def assignment_intervals(feed: DataFrame) -> DataFrame:
    """Every start of the history with its end, inverted ones included."""
    return _with_ends(driver_history(feed), feed)


def delivery_assignments(feed: DataFrame) -> DataFrame:
    """Distinct intervals that are in order.

    Starts meet their ends as the lines repeat them, and repeats go only once, at the end:
    taking them out before the join as well costs a shuffle more than it saves.
    """
    in_order = F.col("unassigned_at").isNull() | (F.col("unassigned_at") >= F.col("assigned_at"))
    return _with_ends(_starts(feed), feed).where(in_order).select(*ASSIGNMENT_ORDER).distinct()


def open_assignments(assignments: DataFrame) -> DataFrame:
    return assignments.where(F.col("unassigned_at").isNull())


def current_driver(assignments: DataFrame) -> DataFrame:
    """The largest courier id among an order's open assignments."""
    return open_assignments(assignments).groupBy("order_id").agg(F.max("driver_id").alias("driver_id"))
