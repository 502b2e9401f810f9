"""Feed order: which row came first.

A feed frame carries two ordinals besides its data columns: ``file_no``, a number that
rises with the file's path, and ``row_no``, anything orderable that rises inside a file
(for parquet its row index). ``first()`` and Spark's ``dropDuplicates`` depend on how a
shuffle happened to deliver rows, so every "first" here is a ``min_by`` on an ordinal.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILE, ROW = "file_no", "row_no"

# A bigint row index takes the low 40 bits of a packed ordinal, the file number the rest, with
# its sign: a feed with more files is refused when it is listed.
ROW_BITS = 40
MOST_FILES = (1 << (63 - ROW_BITS)) - 1
# Rows without a file come before all others, as they do where ordinals are structs.
NO_FILE = -(1 << (63 - ROW_BITS))


def _rank(feed: DataFrame, file_no: Column) -> Column:
    if isinstance(feed.schema[ROW].dataType, T.LongType):
        return F.shiftleft(F.coalesce(file_no.cast("bigint"), F.lit(NO_FILE)), ROW_BITS) + F.col(ROW)
    return F.struct(file_no.alias(FILE), F.col(ROW).alias(ROW))


def earliest(feed: DataFrame) -> Column:
    """Smallest for the first row of the first file."""
    return _rank(feed, F.col(FILE))


def latest_file(feed: DataFrame) -> Column:
    """Smallest for the first row of the *last* file."""
    return _rank(feed, -F.col(FILE))


def file_of(feed: DataFrame, rank: Column) -> Column:
    """The file number inside an ``earliest`` rank of this feed."""
    if isinstance(feed.schema[ROW].dataType, T.LongType):
        return F.nullif(F.shiftright(rank, ROW_BITS), F.lit(NO_FILE))
    return rank[FILE]


def known(df: DataFrame, *columns: str) -> DataFrame:
    """Rows where none of the columns is NULL, as a filter that reaches the parquet scan
    (``dropna`` makes one that does not)."""
    return df.where(reduce(Column.__and__, [F.col(c).isNotNull() for c in columns]))


def rank_if_known(value: Column, rank: Column) -> Column:
    """The rank where the value is not NULL; ``min`` and ``min_by`` skip NULL ranks."""
    return F.when(value.isNotNull(), rank)
