"""Leases that readers hold on versions, and removal of versions that nobody needs."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from delivery_marts.schemas import MARTS
from delivery_marts.session import delete_folder
from delivery_marts.sinks.records import create_record, list_folder, remove_record
from delivery_marts.sources.tables import mart_root, publications

# A lease that its holder never gave back, as it died, ends by itself.
LEASE = dt.timedelta(days=7)
MINIMUM_AGE = dt.timedelta(days=1)


@contextmanager
def leased(spark: SparkSession, root: str, version: str) -> Iterator[None]:
    """Keeps a version's files as long as the block runs, up to the time that leases last."""
    path = f"{root}/versions/{version}/_leases/{uuid.uuid4().hex}.json"
    create_record(spark, path, {"since": dt.datetime.now(dt.timezone.utc).isoformat()})
    try:
        yield
    finally:
        remove_record(spark, path)


def remove_versions(
    spark: SparkSession,
    root: str,
    keep: int = 1,
    minimum_age: dt.timedelta = MINIMUM_AGE,
    lease: dt.timedelta = LEASE,
) -> list[str]:
    """Deletes the versions below ``root`` that nobody needs, and returns their names.

    Those stay: the ``keep`` newest published ones, those with a lease, and those that changed
    within ``minimum_age``, which covers readers between asking for the current version and taking
    their lease. Versions that were never published, left by loads that failed, go like old ones.
    A removal that breaks off is completed by the next.
    """
    if keep < 1:
        raise ValueError("the current version has to stay")
    now = dt.datetime.now(dt.timezone.utc).timestamp() * 1000
    newest = publications(spark, root).orderBy(F.desc("sequence"), F.desc("published_at"), F.desc("version"))
    kept = {row.version for row in newest.select("version").limit(keep).collect()}
    removed = []
    for version, changed in sorted(list_folder(spark, f"{root}/versions").items()):
        leases = list_folder(spark, f"{root}/versions/{version}/_leases").values()
        held = any(now - since < lease.total_seconds() * 1000 for since in leases)
        if version in kept or held or now - changed < minimum_age.total_seconds() * 1000:
            continue
        delete_folder(spark, f"{root}/versions/{version}")
        removed.append(version)
    return removed


def remove_old(spark: SparkSession, root: str, keep: int = 1, minimum_age: dt.timedelta = MINIMUM_AGE) -> dict[str, list[str]]:
    """The same for the tables and for each mart, which has versions of its own."""
    homes = {"tables": root, **{name: mart_root(root, name) for name in MARTS}}
    return {name: remove_versions(spark, home, keep, minimum_age) for name, home in homes.items()}
