"""Small records on shared storage that are created whole, once, or not at all."""

from __future__ import annotations

import json
import os
import uuid
from typing import Any

from pyspark.sql import SparkSession


class RecordExists(ValueError):
    """A record of this name had been created before."""


def _system(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """The Hadoop file system of a path, and the path."""
    given = spark._jvm.org.apache.hadoop.fs.Path(path)
    return given.getFileSystem(spark._jsc.hadoopConfiguration()), given


def create_record(spark: SparkSession, path: str, record: dict[str, Any]) -> None:
    """Creates a file with one line of JSON, or raises RecordExists if there is one.

    The line is written under another name, hidden from Spark's readers, and then gets its own in
    one step that fails where the name is taken: a hard link on local disks, a rename elsewhere. That
    step is atomic on HDFS and file systems like it. An object store whose rename copies has to have
    one writer at a time.
    """
    line = (json.dumps(record) + "\n").encode()
    system, target = _system(spark, path)
    hidden = f"{path.rpartition('/')[0]}/_{uuid.uuid4().hex}"
    if system.getScheme() == "file":
        local, local_hidden = (spark._jvm.org.apache.hadoop.fs.Path(p).toUri().getPath() for p in (path, hidden))
        os.makedirs(os.path.dirname(local), exist_ok=True)
        with open(local_hidden, "wb") as file:
            file.write(line)
        try:
            os.link(local_hidden, local)
        except FileExistsError:
            raise RecordExists(path) from None
        finally:
            os.unlink(local_hidden)
        return
    source = spark._jvm.org.apache.hadoop.fs.Path(hidden)
    stream = system.create(source, False)
    stream.write(line)
    stream.close()
    try:
        # FileSystem.rename gives False, FileContext raises, where the name is taken.
        if system.exists(target) or not system.rename(source, target):
            raise RecordExists(path)
    finally:
        system.delete(source, False)


def remove_record(spark: SparkSession, path: str) -> None:
    system, given = _system(spark, path)
    system.delete(given, False)


def list_folder(spark: SparkSession, path: str) -> dict[str, int]:
    """Names in a folder and when they were changed, in milliseconds; hidden ones left out.

    Folders of versions, leases and journals have few names; none holds a table's files.
    """
    system, given = _system(spark, path)
    if not system.exists(given):
        return {}
    found = {status.getPath().getName(): status.getModificationTime() for status in system.listStatus(given)}
    return {name: changed for name, changed in found.items() if not name.startswith(("_", "."))}


def read_record(spark: SparkSession, path: str) -> dict[str, Any]:
    system, given = _system(spark, path)
    stream = system.open(given)
    try:
        return json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()
