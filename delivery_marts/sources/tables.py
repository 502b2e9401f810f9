"""Tables on disk, how they are laid out, and which published version of them is current.

Tables with an order may be stored in buckets of it: files by a hash of the order id, each sorted by
it, with one number of buckets for all tables of a version. Plans that join or group by order then
shuffle none of them. Spark knows such a layout only from a catalog, so a reader names the files as
an external table of its session's catalog, once per path; the paths of a version never change.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delivery_marts.schemas import BUCKETS, MARTS, TABLES, computed_schema, storage_schema

PUBLICATION = T.StructType(
    [
        T.StructField("version", T.StringType()),
        T.StructField("sequence", T.LongType()),
        T.StructField("published_at", T.TimestampType()),
        T.StructField("row_counts", T.MapType(T.StringType(), T.LongType())),
        T.StructField("schema", T.StringType()),
        # NULL where the tables are not laid out by order.
        T.StructField("buckets", T.IntegerType()),
    ]
)

LAYOUT_KEY = "order_id"


def layout_name(path: str) -> str:
    """The catalog's name of bucketed files, the same in every session."""
    return f"spark_catalog.default.delivery_marts_{hashlib.md5(path.encode()).hexdigest()}"


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def read_table(
    spark: SparkSession, path: str, schema: T.StructType, buckets: int | None = None
) -> DataFrame:
    """A whole table; the schema is given, so no footer is read to infer one.

    ``buckets`` is the number that the files were written with, if they were.
    """
    stored = storage_schema(schema)
    if not buckets or LAYOUT_KEY not in schema.names:
        return spark.read.schema(stored).parquet(path).select(*schema.names)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {layout_name(path)} ({columns}) USING parquet "
        f"CLUSTERED BY ({LAYOUT_KEY}) SORTED BY ({LAYOUT_KEY}) INTO {buckets} BUCKETS LOCATION {_quoted(path)}"
    )
    laid_out = F.col(LAYOUT_KEY).alias(LAYOUT_KEY, metadata={BUCKETS: buckets})
    return spark.table(layout_name(path)).select(*[laid_out if n == LAYOUT_KEY else n for n in schema.names])


def publications(spark: SparkSession, root: str) -> DataFrame:
    """The log of published versions; empty before the first."""
    try:
        return spark.read.schema(PUBLICATION).json(f"{root}/published")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], PUBLICATION)


def current(spark: SparkSession, root: str) -> Row | None:
    """The newest record of the log.

    Records are numbered, as the clocks of two drivers need not agree; the time only tells
    apart records that were numbered alike because they were written at once.
    """
    log = publications(spark, root)
    order = F.struct(F.coalesce("sequence", F.lit(0)), "published_at", "version")
    return log.agg(F.max_by(F.struct(*log.columns), order).alias("newest")).first().newest


def current_version(spark: SparkSession, root: str) -> str | None:
    newest = current(spark, root)
    return newest.version if newest else None


def version_path(root: str, version: str, table: str) -> str:
    return f"{root}/versions/{version}/{table}"


def read_version(
    spark: SparkSession, root: str, version: str, buckets: int | None = None
) -> dict[str, DataFrame]:
    """The seven tables of a version, published or not."""
    return {
        name: read_table(spark, version_path(root, version, name), spec.schema, buckets)
        for name, spec in TABLES.items()
    }


def published(spark: SparkSession, root: str) -> Row:
    """The record of the newest published version; raises if there is none."""
    newest = current(spark, root)
    if newest is None:
        raise FileNotFoundError(f"nothing has been published under {root}")
    return newest


def published_version(spark: SparkSession, root: str) -> str:
    """The newest published version; raises if there is none."""
    return published(spark, root).version


def read_current(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Tables of the newest published version."""
    newest = published(spark, root)
    return read_version(spark, root, newest.version, newest.buckets)


def mart_root(root: str, name: str) -> str:
    """Each mart has versions and a publication log of its own."""
    return f"{root}/marts/{name}"


def read_mart(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The newest published version of a mart, in the types it was published with."""
    home = mart_root(root, name)
    newest = published(spark, home)
    return read_mart_version(spark, version_path(home, newest.version, name), name, newest.schema)


def read_mart_version(spark: SparkSession, path: str, name: str, schema: str | None = None) -> DataFrame:
    """A mart's files; the schema is given, as an empty mart has no file to infer one from."""
    given = T.StructType.fromJson(json.loads(schema)) if schema else computed_schema(MARTS[name].schema)
    return spark.read.schema(given).parquet(path).select(*MARTS[name].schema.names)
