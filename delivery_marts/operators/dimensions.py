"""Dimension tables: one row per key out of many repeats in the feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delivery_marts.functions import normalize_phone
from delivery_marts.operators.ordering import known, latest_file


def latest_attributes(feed: DataFrame, key: str, *attributes: str) -> DataFrame:
    """Attributes as the last file that knows the key first states them, NULLs included.

    One aggregate does both steps (first row in a file, last file), so the key is
    shuffled once, and the map side leaves one row per key and task: a key that fills a
    third of the feed reaches the reducer as one row per task.
    """
    winner = F.min_by(F.struct(*attributes), latest_file(feed)).alias("winner")
    return feed.groupBy(key).agg(winner).select(key, "winner.*")


def dim_users(feed: DataFrame) -> DataFrame:
    users = latest_attributes(feed, "user_id", "user_phone")
    return users.withColumn("user_phone", normalize_phone(F.col("user_phone")))


def dim_stores(feed: DataFrame) -> DataFrame:
    return latest_attributes(feed, "store_id", "store_address")


def dim_drivers(feed: DataFrame) -> DataFrame:
    """Orders without a courier name no driver; all other NULL ids are load errors."""
    drivers = latest_attributes(known(feed, "driver_id"), "driver_id", "driver_phone")
    return drivers.withColumn("driver_phone", normalize_phone(F.col("driver_phone")))


def dim_items(feed: DataFrame) -> DataFrame:
    return latest_attributes(feed, "item_id", "item_title", "item_category")
