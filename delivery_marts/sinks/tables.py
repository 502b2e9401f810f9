"""Writing tables and marts as parquet, and publishing a set of them at once."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delivery_marts.sinks.records import RecordExists, create_record, list_folder
from delivery_marts.sources.tables import LAYOUT_KEY, current, layout_name

# Tables written side by side: a small table's last tasks leave the cluster idle.
PARALLEL_WRITES = 4
MART_PARTITIONS = ("year", "month")


def write_table(
    df: DataFrame,
    path: str,
    buckets: int | None = None,
    observe: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> None:
    """Writes a table, in ``buckets`` by order if it has orders.

    ``observe`` may add metrics to the very rows that a writing task holds: Spark counts those of
    a task once, however often it ran.
    """
    if not buckets or LAYOUT_KEY not in df.columns:
        observe(df).write.mode("overwrite").parquet(path)
        return
    laid_out = observe(df.repartition(buckets, LAYOUT_KEY))
    writer = laid_out.write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, LAYOUT_KEY).sortBy(LAYOUT_KEY).saveAsTable(layout_name(path))


def write_mart(df: DataFrame, path: str, observe: Callable[[DataFrame], DataFrame] = lambda df: df) -> None:
    """A mart partitioned by year and month, so date filters skip whole folders.

    ``rebalance`` brings a month's rows together for few, well-filled files, and unlike
    ``repartition`` lets adaptive execution cut a month that is too large for one task.
    """
    (
        observe(df.hint("rebalance", *MART_PARTITIONS))
        .write.mode("overwrite")
        .partitionBy(*MART_PARTITIONS)
        .parquet(path)
    )


def new_version() -> str:
    now = dt.datetime.now(dt.timezone.utc)
    return f"{now:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:12]}"


def write_all(writers: dict[str, Callable[[], None]]) -> None:
    """Run independent writes a few at a time; the first failure is raised."""
    with ThreadPoolExecutor(PARALLEL_WRITES) as pool:
        for job in [pool.submit(writer) for writer in writers.values()]:
            job.result()


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count); on parquet tables the counts come from footers."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


class ConcurrentPublication(ValueError):
    """Another version was published since the number was read that this one was to follow."""


def last_number(spark: SparkSession, root: str) -> int:
    """The number of the newest publication, 0 before the first."""
    names = [name.removesuffix(".json") for name in list_folder(spark, f"{root}/published")]
    numbers = [int(name) for name in names if name.isdigit()]
    if len(numbers) < len(names):  # a log begun before records were named by their number
        newest = current(spark, root)
        numbers.append((newest.sequence or 0) if newest else 0)
    return max(numbers, default=0)


def publish(
    spark: SparkSession,
    root: str,
    version: str,
    counts: dict[str, int],
    schema: str | None = None,
    buckets: int | None = None,
    after: int | None = None,
) -> None:
    """Make a fully written version the current one.

    Adding one record to the publication log is the only step a reader can see, and the record is
    created whole: readers find the old version or the new one, never a mix. Its name is the
    number that follows ``after``, the ``last_number`` when the work on this version began (left
    out: the last one now). If another version has that number by now, this raises
    ConcurrentPublication and the version stays unpublished: of two that began on the same log, one
    wins.
    ``schema`` is kept with a mart, whose types depend on how it was built, and ``buckets`` with
    tables that are laid out by order.
    """
    number = (last_number(spark, root) if after is None else after) + 1
    record = {
        "version": version,
        "sequence": number,
        "published_at": dt.datetime.now(dt.timezone.utc).isoformat(),
        "row_counts": counts,
        "schema": schema,
        "buckets": buckets,
    }
    try:
        create_record(spark, f"{root}/published/{number:020}.json", record)
    except RecordExists:
        raise ConcurrentPublication(f"{root} has a publication {number}; {version} was not published") from None
