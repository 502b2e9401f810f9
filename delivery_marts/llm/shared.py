"""Tables that cut lineage, in the folder that the driver and all executors share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delivery_marts.session import delete_folder, importable, scratch_path

# Rows per Arrow batch. Texts may be long, so batches are small; a batch is the most that a
# Python worker holds at once besides its own state.
BATCH_ROWS = 256


def configure(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return importable(spark)


_MADE: dict[str, list[str]] = {}


def folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name below ``spark.checkpoint.dir``, or where that is unset, as in local
    runs, below the warehouse, which all executors share as well. On a cluster without the
    setting the job stops."""
    path = scratch_path(spark, f"llm-{label}")
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear(spark: SparkSession) -> None:
    """Deletes every folder that the operators have made in this session.

    Frames they returned cannot be read any more; write what is to be kept first.
    """
    for path in _MADE.pop(spark.sparkContext.applicationId, []):
        delete_folder(spark, path)


def written(df: DataFrame, label: str) -> DataFrame:
    """The same rows, written once and read back; an empty frame keeps its columns."""
    path = folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def bucket(buckets: int, *columns: str | Column) -> Column:
    """An even spread of rows over ``buckets`` by the hash of some columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")


def per_key(rows: DataFrame, keys: list[str], *aggregates: Column) -> DataFrame:
    """One row per key, to be joined to rows in which a key may be hot.

    The keys are grouped as one struct, which leaves the result partitioned by the struct, so the
    join shuffles it again; adaptive execution splits a hot key only where both sides of the join
    come straight from a shuffle.
    """
    grouped = rows.groupBy(F.struct(*keys).alias("_key")).agg(*aggregates)
    return grouped.select("_key.*", *grouped.columns[1:])


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, by which rows are held out."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))
