"""Dense surrogate keys 1, 2, 3 … in sort order, without sorting in one task or copying a table.

Rows are cut into ranges of their whole sort key at fixed bounds, so even one order with a third
of the rows spans many ranges. The bounds are quantiles of a small sample of the keys, taken once
and then constants of the plan: a task that runs again, on whatever executor, cuts as before, and a
row's number does not depend on where the cuts are. It is the row's place in its range plus the
sizes of the ranges before. Sizes and rows come from one and the same shuffle, which Spark makes
once and reads twice.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delivery_marts.schemas import ASSIGNMENT_ORDER, LINE_GROUP
from delivery_marts.session import PARTITIONS

RANGE = "_range"
# More ranges than partitions, so that a hash of them fills partitions evenly.
RANGES_PER_PARTITION = 4
SAMPLED_PER_RANGE = 32
LARGEST, SMALLEST = (1 << 63) - 1, -(1 << 63)


def _code(df: DataFrame, name: str) -> Column:
    """A sort column as a bigint that sorts alike, NULLs last.

    A NULL and the largest bigint have one code; they then fall into the same range, in which rows
    are sorted by the columns themselves.
    """
    kind, value = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.TimestampNTZType):
        value = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), value)
    elif not isinstance(kind, T.IntegralType):
        raise TypeError(f"{name} is {kind.simpleString()}; keys are numbered by integers and timestamps")
    return F.coalesce(value.cast("bigint"), F.lit(LARGEST))


def _codes(df: DataFrame, keys: Sequence[str]) -> Column:
    return F.array(*[_code(df, name) for name in keys])


@dataclass(frozen=True)
class KeyBounds:
    """Where ranges of a sort key begin: ascending codes, one list per range but the first."""

    keys: tuple[str, ...]
    codes: tuple[tuple[int, ...], ...] = ()

    def range_of(self, df: DataFrame) -> Column:
        """The range of each row: how many bounds are not beyond its key, by halving.

        The first column decides, but for rows that share its value with a bound; only those
        compare whole keys, which takes several times as long.
        """
        if not self.codes:
            return F.lit(0)
        # One constant, however many bounds: Spark folds the text when it plans.
        flat = F.split(F.lit(",".join(str(c) for code in self.codes for c in code)), ",").cast("array<bigint>")
        firsts = F.split(F.lit(",".join(str(code[0]) for code in self.codes)), ",").cast("array<bigint>")
        width, count = len(self.keys), len(self.codes)
        steps = [1 << bit for bit in reversed(range(count.bit_length()))]

        def by_first(key: Column) -> Column:
            def step(at: Column, by: Column) -> Column:
                return F.when((at + by <= count) & (F.get(firsts, at + by - 1) <= key), at + by).otherwise(at)

            def decided(at: Column) -> Column:
                return F.when((at == 0) | (F.get(firsts, at - 1) < key), at)

            return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step, decided)

        def narrowed(key: Column) -> Column:
            def step(at: Column, by: Column) -> Column:
                bound = F.slice(flat, (at + by - 1) * width + 1, F.lit(width))
                return F.when((at + by <= count) & (bound <= key), at + by).otherwise(at)

            return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step)

        # Never NULL, which Spark does not see; else a filter would ask that of every row.
        return F.coalesce(by_first(_code(df, self.keys[0])), narrowed(_codes(df, self.keys)), F.lit(0))

    def ranges_of_hottest(self) -> int:
        """Ranges that begin at one and the same value of the first key: few, unless that value
        has a large share of the rows."""
        longest = run = 0
        for before, code in zip((None, *self.codes), self.codes):
            run = run + 1 if before and before[0] == code[0] else 1
            longest = max(longest, run)
        return longest


def key_bounds(rows: DataFrame, keys: Sequence[str], ranges: int | None = None) -> KeyBounds:
    """Bounds that cut the distinct values of ``keys`` in ``rows`` into about equal ranges.

    ``rows`` may repeat keys, and may be anything with about the same keys as the rows to be
    numbered. The sample takes keys by their hash, so a key is in it once or not at all however
    often it occurs, and its size does not grow with the rows; its quantiles come to the driver,
    one per range.
    """
    parallel = int(rows.sparkSession.conf.get(PARTITIONS))
    ranges = ranges or RANGES_PER_PARTITION * parallel
    wanted, total = SAMPLED_PER_RANGE * ranges, rows.count()
    coded = rows.select(_codes(rows, keys).alias("code"))
    if total > wanted:
        width = 2 * LARGEST * (wanted / total)
        coded = coded.where(F.xxhash64("code") < F.lit(int(SMALLEST + width)).cast("bigint"))
    # The sample has a few keys per range, so it may be sorted by one task.
    placed = coded.distinct().withColumn("place", F.row_number().over(Window.orderBy("code")))
    counted = placed.withColumn("size", F.count(F.lit(1)).over(Window.partitionBy()))
    bound = F.floor(F.col("place") * ranges / F.col("size")) > F.floor((F.col("place") - 1) * ranges / F.col("size"))
    found = counted.where(bound & (F.col("place") < F.col("size"))).orderBy("place").select("code").collect()
    return KeyBounds(tuple(keys), tuple(tuple(row.code) for row in found))


def with_surrogate_key(
    df: DataFrame, id_column: str, sort_keys: Sequence[str], bounds: KeyBounds | None = None
) -> DataFrame:
    """Number rows by ``sort_keys`` (NULLs last), which must tell all rows apart.

    ``bounds`` are of the first of those keys, or of all; without any they are taken from ``df``,
    which is computed twice for that.
    """
    bounds = bounds or key_bounds(df, sort_keys)
    order = [F.col(name).asc_nulls_last() for name in sort_keys]
    ranged = df.withColumn(RANGE, bounds.range_of(df)).repartition(RANGE)
    # Counting looks at every column, or Spark would leave some out below and shuffle again.
    whole = F.xxhash64(*df.columns) >= F.lit(SMALLEST)
    sizes = ranged.groupBy(RANGE).agg(F.count_if(whole).alias("_rows"))
    # One row per range: small enough for a plain window and for a broadcast whatever the size
    # of the data.
    before = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(RANGE, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    place = F.row_number().over(Window.partitionBy(RANGE).orderBy(*order))
    numbered = ranged.withColumn("_place", place).join(F.broadcast(offsets), RANGE)
    return numbered.select((F.col("_offset") + F.col("_place")).alias(id_column), *df.columns)


def key_order_lines(lines: DataFrame, bounds: KeyBounds | None = None) -> DataFrame:
    """Numbers follow order, item, price, discount and replacement, NULL last."""
    return with_surrogate_key(lines, "order_item_id", LINE_GROUP, bounds)


def key_assignments(assignments: DataFrame, bounds: KeyBounds | None = None) -> DataFrame:
    return with_surrogate_key(assignments, "assignment_id", ASSIGNMENT_ORDER, bounds)
