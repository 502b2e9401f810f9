"""Rows of a bucket compared in blocks, however large the bucket.

Rows that share a bucket have to be compared pair by pair. A bucket of up to ``block`` rows is
one cell. A larger one is split into parts by the hash of the row, and each pair of parts is a
cell, so no task ever holds more than two parts of a bucket and a hot bucket is spread over many
tasks. Cells are packed into groups by hash, so that many small buckets share one call.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delivery_marts.llm.shared import per_key


def with_cells(rows: DataFrame, key: list[str], identity: list[str | Column], block: int) -> DataFrame:
    """Rows with ``cell`` (bucket and pair of parts, as a hash) and ``side``.

    Rows alone in their bucket have nothing to be compared with and do not appear. ``side`` is 0
    where a cell compares all its rows with each other; in a cell of two parts it is 1 or 2, and
    only pairs across the sides are new. ``rows`` is read twice: to count, and to join.
    """
    buckets = (
        per_key(rows, key, F.count(F.lit(1)).alias("_rows"))
        .where("_rows > 1")
        .select(*key, F.ceil(F.col("_rows") / block).cast("int").alias("_parts"))
    )
    parted = rows.join(buckets, key).withColumn(
        "_part", F.pmod(F.xxhash64(F.lit("part"), *identity), F.col("_parts")).cast("int")
    )
    exploded = parted.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    side = F.when(F.col("_part") == F.col("_other"), 0).when(F.col("_part") < F.col("_other"), 1).otherwise(2)
    low, high = F.least("_part", "_other"), F.greatest("_part", "_other")
    return (
        exploded.withColumn("side", side.cast("int"))
        .withColumn("cell", F.xxhash64(*key, low, high))
        .drop("_parts", "_part", "_other")
    )
