"""Session settings the plans rely on, task sizes by input, and scratch folders."""

from __future__ import annotations

import math
import os
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Runtime SQL settings; all may be changed on a live session.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot order may be split even where the aggregate above the join then needs one
    # more shuffle; without this the split is given up to save that shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Feeds written by pandas carry nanosecond timestamps, which Spark reads as bigint.
    "spark.sql.legacy.parquet.nanosAsLong": "true",
}

PARTITIONS, SPLIT = "spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes"


@dataclass(frozen=True)
class Limits:
    """How a job's tasks grow with its input; every job takes one.

    Map tasks times reducers is the number of shuffle blocks, so neither may grow without
    end: past the two limits tasks get larger and spill. A cluster whose shuffle service
    merges blocks can raise them.
    """

    shuffle_partition_bytes: int = 512 << 20  # stored input per shuffle partition
    most_shuffle_partitions: int = 100_000
    scan_tasks: int = 100_000
    largest_scan_bytes: int = 1 << 30


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return importable(spark)


def importable(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package from where the driver has it, wherever the
    driver was started; with --py-files they have it anyway."""
    home = str(Path(__file__).resolve().parent.parent)
    workers = spark.sparkContext.environment
    known = [path for path in workers.get("PYTHONPATH", "").split(os.pathsep) if path]
    if home not in known:
        workers["PYTHONPATH"] = os.pathsep.join([home, *known])
    return spark


def task_sizes(
    input_bytes: int, shuffle_partitions: int, scan_bytes: int, limits: Limits = Limits()
) -> tuple[int, int]:
    """Shuffle partitions and bytes per scan task for an input; never below those given."""
    wanted = math.ceil(input_bytes / limits.shuffle_partition_bytes)
    partitions = min(wanted, limits.most_shuffle_partitions)
    split = min(math.ceil(input_bytes / limits.scan_tasks), limits.largest_scan_bytes)
    return max(partitions, shuffle_partitions), max(split, scan_bytes)


@contextmanager
def sized(spark: SparkSession, input_bytes: int, limits: Limits = Limits()) -> Iterator[None]:
    """Fits the session to an input's size, and back to what it was afterwards.

    Adaptive execution merges partitions that turn out small but cannot cut a shuffle
    into more than it began with, so the count has to start high enough.
    """
    before = {key: spark.conf.get(key) for key in (PARTITIONS, SPLIT)}
    sizes = task_sizes(input_bytes, int(before[PARTITIONS]), _bytes(before[SPLIT]), limits)
    try:
        for key, size in zip((PARTITIONS, SPLIT), sizes, strict=True):
            spark.conf.set(key, str(size))
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _bytes(setting: str) -> int:
    """A size setting in bytes; Spark writes them as 134217728b, users as 128m or 1g."""
    text = setting.lower().rstrip("b")
    unit = {"k": 10, "m": 20, "g": 30, "t": 40}.get(text[-1])
    return int(text[:-1]) << unit if unit else int(text)


@contextmanager
def listing(spark: SparkSession) -> Iterator[None]:
    """For scans that only list files: tasks by cores, not one for each large file."""
    before = spark.conf.get(SPLIT)
    try:
        spark.conf.set(SPLIT, str(1 << 60))
        yield
    finally:
        spark.conf.set(SPLIT, before)


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes of all files below some folders; they are listed, not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    with listing(spark):
        return files.agg(F.sum("length")).first()[0] or 0


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the cluster's shared checkpoint folder.

    For plans that have no folder of their own; jobs keep what they need below their root.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        # The warehouse is shared by definition.
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{root.rstrip('/')}/delivery_marts/{label}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder this library has written; one that is not there is fine."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch(spark: SparkSession, root: str) -> Iterator[str]:
    """A folder below a job's root for what it writes on the way, gone when the job ends."""
    path = f"{root.rstrip('/')}/scratch/{uuid.uuid4().hex}"
    try:
        yield path
    finally:
        delete_folder(spark, path)
