"""The raw order-line feed: a set of parquet files and the order they come in."""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delivery_marts.functions import nan_to_null
from delivery_marts.operators.ordering import FILE, MOST_FILES, ROW
from delivery_marts.schemas import RAW_FEED
from delivery_marts.session import configure, delete_folder, listing, scratch_path
from delivery_marts.sinks.conform import typed

FOOTER_THREADS = 16


def list_feed(spark: SparkSession, path: str, folder: str | None = None) -> DataFrame:
    """The feed's files as (file_path, length, changed, file_no, path_hash), numbered by plain path.

    Lists files without reading any. The list has one row per file, none per record; it
    is written to ``folder`` (else to the shared scratch folder) so that all plans on a feed
    see the same files and the file system is asked once. Raises for more files than a packed
    ordinal can number, and in the case, hardly possible, that two paths share a hash.
    """
    files = spark.read.format("binaryFile").load(path).select(
        "path", "length", F.col("modificationTime").alias("changed"), "_metadata.file_path"
    )
    number = F.row_number().over(Window.orderBy("path")).cast("bigint")
    hashed = F.xxhash64("file_path").alias("path_hash")
    target = folder or scratch_path(spark, "feed-files")
    with listing(spark):
        files.select("file_path", "length", "changed", number.alias(FILE), hashed).write.parquet(target)
    listed = spark.read.parquet(target)
    known_files, hashes = listed.agg(F.count(F.lit(1)), F.count_distinct("path_hash")).first()
    if known_files > MOST_FILES:
        raise ValueError(f"{path} has {known_files} files; {MOST_FILES} can be numbered")
    if hashes != known_files:
        raise ValueError(f"two paths of {path} have the same hash; rename one file")
    return listed


def feed_bytes(files: DataFrame) -> int:
    return files.agg(F.sum("length")).first()[0] or 0


def feed_state(files: DataFrame) -> str:
    """The same for two listings if no file came, went, grew or was written again."""
    file = F.xxhash64("file_path", "length", "changed")
    state = files.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(file).alias("x"), F.sum("length").alias("bytes")).first()
    return f"{state.n} files, {state.bytes or 0} bytes, {state.x or 0}"


def _file_numbers(files: DataFrame) -> DataFrame:
    """Numbers by path hash, two bigints for each of at most ``MOST_FILES`` files: that bound
    is what makes them fit a broadcast. Being grouped, hashes are known to be unique, and plans
    that need no file number drop the join to this table."""
    return F.broadcast(files.groupBy("path_hash").agg(F.max(FILE).alias(FILE)))


def _from_epoch(micros: Column) -> Column:
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", micros, epoch)


def _feed_value(field: T.StructField, source: T.DataType) -> Column:
    """One raw column in its declared type, whatever type the file's writer chose."""
    value = F.col(field.name)
    if isinstance(field.dataType, T.TimestampNTZType):
        if isinstance(source, T.LongType):
            # Nanoseconds since the epoch, floored to Spark's microseconds.
            return _from_epoch(F.expr(f"({field.name} - pmod({field.name}, 1000)) div 1000"))
        if isinstance(source, T.TimestampType):
            # An instant; its wall clock in UTC, whatever zone the session is in.
            return _from_epoch(F.unix_micros(value))
    if isinstance(field.dataType, T.StringType) and isinstance(source, (T.DoubleType, T.FloatType)):
        # A phone column read as float must not gain the digit of its ".0".
        return nan_to_null(value).cast("decimal(20,0)").cast("string")
    return typed(value, source, field.dataType)


def _declared(raw: DataFrame) -> DataFrame:
    """The feed's columns in declared types, with path and row index."""
    return raw.select(
        *[_feed_value(f, raw.schema[f.name].dataType).alias(f.name) for f in RAW_FEED],
        F.xxhash64("_metadata.file_path").alias("path_hash"),
        F.col("_metadata.row_index").alias(ROW),
    )


def _literal(path: str) -> str:
    """A path as a pattern that matches nothing else."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _kinds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The physical types of each file's feed columns, from its footer; NULL where the store is
    one that only Spark can open."""
    for batch in batches:
        kinds: list[str | None] = []
        for uri in batch["file_path"]:
            try:
                system, path = fs.FileSystem.from_uri(uri)
            except (pa.ArrowInvalid, pa.ArrowNotImplementedError):
                kinds.append(None)
                continue
            schema = pq.read_schema(path, filesystem=system)
            found = {f.name: str(f.type) for f in schema}
            kinds.append(json.dumps({name: found.get(name) for name in RAW_FEED.names}))
        yield batch.assign(kinds=kinds)


def _spark_kinds(spark: SparkSession, files: list[str]) -> list[str]:
    """The same from Spark's own reader, a job for each file."""

    def kinds(file: str) -> str:
        found = {f.name: f.dataType.simpleString() for f in spark.read.parquet(_literal(file)).schema}
        return json.dumps({name: found.get(name) for name in RAW_FEED.names})

    with ThreadPoolExecutor(FOOTER_THREADS) as pool:
        return list(pool.map(kinds, files))


def _read_footers(spark: SparkSession, path: str, target: str) -> DataFrame:
    """Footers of the matching files as (path, file_path, kinds), read in one distributed pass and
    kept in ``target``, a row per file."""
    schema = "path string, file_path string, kinds string"
    listed = spark.read.format("binaryFile").load(path).select("path", "_metadata.file_path")
    listed.repartition(F.xxhash64("path")).mapInPandas(_kinds, schema).write.parquet(target)
    return spark.read.schema(schema).parquet(target)


def _groups(spark: SparkSession, path: str, target: str) -> dict[str, list[str]]:
    """Files by physical schema; one file is enough where all are alike.

    What comes to the driver is a row per distinct schema. Only if there are several, the paths
    follow, which Spark's reader wants as a list (and holds itself, for any scan). Files whose store
    only Spark opens, and no others, are asked for with Spark's own reader.
    """
    with listing(spark):
        footers = _read_footers(spark, path, target)
        known = footers.groupBy("kinds").agg(F.min("path").alias("path")).collect()
        pairs = [(row.kinds, row.path) for row in known]
        if len(known) > 1 or any(kinds is None for kinds, _ in pairs):
            pairs = [(row.kinds, row.path) for row in footers.select("kinds", "path").toLocalIterator()]
            unread = [file for kinds, file in pairs if kinds is None]
            pairs = [pair for pair in pairs if pair[0] is not None]
            pairs += zip(_spark_kinds(spark, unread), unread, strict=True)
    for kinds, file in pairs:
        if lacking := [name for name, kind in json.loads(kinds).items() if kind is None]:
            raise ValueError(f"{file} lacks {', '.join(lacking)}")
    groups: dict[str, list[str]] = defaultdict(list)
    for kinds, file in pairs:
        groups[kinds].append(file)
    return groups


def _scans(spark: SparkSession, path: str, target: str) -> list[DataFrame]:
    """The matching files as few scans, each of files with the same physical schema.

    Writers that hold integers as floats once a NULL turns up give a column different
    types in different files, which one Spark scan cannot read. A file that lacks one of the
    feed's columns raises: read with the others it would silently give NULLs.
    """
    groups = _groups(spark, path, target)
    scans = []
    for files in groups.values():
        schema = spark.read.parquet(_literal(files[0])).schema
        matching = [path] if len(groups) == 1 else [_literal(file) for file in files]
        scans.append(spark.read.schema(schema).parquet(*matching))
    return scans


def read_feed(
    spark: SparkSession, path: str, files: DataFrame | None = None, folder: str | None = None
) -> DataFrame:
    """The feed's 25 columns plus ``file_no`` and ``row_no``; ``files`` as ``list_feed`` gives it.

    What the files' footers say is kept in ``folder``, else, until the scans are planned, in the
    shared scratch folder. Raises if nothing matches ``path`` or any file lacks one of the columns. Scans stay
    pruned: only the columns a plan uses are read.
    """
    configure(spark)
    numbers = _file_numbers(list_feed(spark, path) if files is None else files)
    target = folder or scratch_path(spark, "feed-footers")
    try:
        scans = _scans(spark, path, target)
    finally:
        if not folder:
            delete_folder(spark, target)
    feed = reduce(DataFrame.unionByName, [_declared(scan) for scan in scans])
    # A file that came in after the listing has no number; dropping it silently or
    # leaving it unordered would both be wrong.
    listed = F.coalesce(FILE, F.raise_error(F.lit("file not listed")))
    return feed.join(numbers, "path_hash", "left").withColumn(FILE, listed).drop("path_hash")
