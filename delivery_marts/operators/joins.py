"""Join shapes that hold when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame


def childless(parent: DataFrame, child: DataFrame, key: str) -> DataFrame:
    """Parent rows without a child. The child's keys are made distinct first, so a hot
    key leaves each map task once."""
    return parent.join(child.select(key).distinct(), key, "left_anti")


def left_join_many(parent: DataFrame, child: DataFrame, key: str) -> DataFrame:
    """``parent LEFT JOIN child`` for a child with many rows per key.

    Adaptive execution can split a skewed partition on the left of a left join only, and
    here the skew is on the right. An inner join may be split on both sides, so the
    result is put together from the inner join and the childless parents. For a split
    both frames must come straight from a shuffle: read them from disk, as a frame just
    grouped by the key is joined as it lies.
    """
    matched = parent.join(child, key)
    return matched.unionByName(childless(parent, child, key), allowMissingColumns=True)
