"""Tables in a database, whole or cut into ranges of a numeric column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Timestamps in the tables have no zone; read them as such.
READ_OPTIONS = {"preferTimestampNTZ": "true", "fetchsize": "10000"}


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A small table through one connection."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **READ_OPTIONS, **options).load()


def range_options(column: str, low: int | None, high: int | None, partitions: int) -> dict[str, str]:
    """Options of a range-partitioned read; none for an empty table.

    The bounds set the stride and filter nothing: rows outside them all fall into the
    first or last range. So they have to be the column's real bounds.
    """
    if low is None or high is None:
        return {}
    return {
        "partitionColumn": column,
        "lowerBound": str(low),
        "upperBound": str(high + 1),
        "numPartitions": str(max(1, min(partitions, high - low + 1))),
    }


def read_jdbc_ranges(
    spark: SparkSession, url: str, table: str, column: str, partitions: int, **options: str
) -> DataFrame:
    """A large table through ``partitions`` connections, bounds asked from the table."""
    bounds = f"(SELECT MIN({column}) AS low, MAX({column}) AS high FROM {table}) bounds"
    low, high = read_jdbc(spark, url, bounds, **options).first()
    return read_jdbc(spark, url, table, **range_options(column, low, high, partitions), **options)
