"""The two data marts.

Money comes out as double, as computed; ``conform`` gives the declared decimals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delivery_marts.functions import (
    address_city,
    cancel_after_delivery_flag,
    cancel_error_flag,
    date_parts,
    line_value,
    order_amount,
)
from delivery_marts.functions.lifecycle import CANCELED
from delivery_marts.functions.money import amount
from delivery_marts.operators.assignments import current_driver
from delivery_marts.operators.joins import childless
from delivery_marts.operators.ordering import known
from delivery_marts.schemas import ITEMS_MART, ORDERS_MART


def order_totals(order_items: DataFrame) -> DataFrame:
    """Per order, line values in hundredths: all ordered, and all kept."""
    price, discount = F.col("item_price"), F.col("item_discount")
    ordered = F.col("item_quantity")
    kept = ordered - F.col("item_canceled_quantity")
    return order_items.groupBy("order_id").agg(
        F.sum(line_value(ordered, price, discount)).alias("ordered_value"),
        F.sum(line_value(kept, price, discount)).alias("kept_value"),
    )


def order_money(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Orders with ``cash_flows`` and ``revenue``.

    Lines are summed per order before they meet the order: the order's discount and
    status are the same on all its lines, so they factor out of the sums. The join is
    then one to one, on a key the sums are already partitioned by.
    """
    discount = F.col("order_discount")
    return (
        orders.join(order_totals(order_items), "order_id", "left")
        .withColumn("cash_flows", order_amount(F.col("ordered_value"), discount))
        .withColumn(
            "revenue",
            F.when(F.col("status") == CANCELED, F.lit(0.0)).otherwise(
                order_amount(F.col("kept_value"), discount)
            ),
        )
        .drop("ordered_value", "kept_value")
    )


def orders_mart(orders: DataFrame, order_items: DataFrame, assignments: DataFrame) -> DataFrame:
    """One row per order. Orders, line sums and drivers each shuffle once, by order."""
    derived = {
        "is_cancel_error": cancel_error_flag(F.col("status"), F.col("order_cancellation_reason")),
        "is_cancel_after_delivery": cancel_after_delivery_flag(
            F.col("delivered_at"), F.col("canceled_at")
        ),
        "city": address_city(F.col("address_text")),
        **date_parts(F.col("created_at")),
    }
    return (
        order_money(orders, order_items)
        .join(current_driver(assignments), "order_id", "left")
        .withColumns(derived)
        .select(*ORDERS_MART.names)
    )


CELL = ["created_on", "city", "store_id", "item_id"]


def item_cells(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Sums and order counts per day, city, store and item.

    Distinct orders are counted by grouping down to (cell, order) first. The join leaves
    rows partitioned by order, which serves that grouping as it is, so only lines, orders
    and the reduced cells are shuffled. Item attributes are not joined here but to the
    far fewer cells; the date goes along as one value, not three.
    """
    # The inner and the anti join take the same orders, so they share one scan and shuffle.
    placed = known(orders, "order_id").select(
        "order_id",
        F.to_date("created_at").alias("created_on"),
        address_city(F.col("address_text")).alias("city"),
        "store_id",
    )
    lines = order_items.select(
        "order_id",
        "item_id",
        "item_quantity",
        "item_canceled_quantity",
        line_value(F.col("item_quantity"), F.col("item_price"), F.col("item_discount")).alias("value"),
    )
    per_order = (
        placed.join(lines, "order_id")
        .groupBy(*CELL, "order_id")
        .agg(
            F.sum("value").alias("value"),
            F.sum("item_quantity").alias("ordered_qty"),
            F.sum("item_canceled_quantity").alias("canceled_qty"),
            F.max(F.col("item_canceled_quantity") > 0).alias("has_canceled"),
        )
    )
    # An order without lines still counts as an order, in its cell without an item.
    lineless = childless(placed, order_items, "order_id")
    return (
        per_order.unionByName(lineless, allowMissingColumns=True)
        .groupBy(*CELL)
        .agg(
            F.sum("value").alias("value"),
            F.sum("ordered_qty").alias("ordered_qty"),
            F.sum("canceled_qty").alias("canceled_qty"),
            F.count("order_id").alias("orders_cnt"),
            F.count_if("has_canceled").alias("orders_with_canceled_items"),
        )
    )


def items_mart(orders: DataFrame, order_items: DataFrame, items: DataFrame) -> DataFrame:
    """One row per day, city, store and item. Give it tables read from disk: joins of those
    can be split where one order or item is hot (see ``left_join_many``)."""
    return (
        item_cells(orders, order_items)
        .join(items, "item_id", "left")
        .withColumns({"item_cash_flows": amount(F.col("value")), **date_parts(F.col("created_on"))})
        .select(*ITEMS_MART.names)
    )
