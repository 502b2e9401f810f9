"""The four jobs, and the whole run: load, check, orders mart, items mart."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from delivery_marts.operators.constraints import RowRules, primary_key_violations, reference_counts
from delivery_marts.operators.quality import assert_quality, quality_report
from delivery_marts.plans.marts import items_mart, orders_mart
from delivery_marts.operators.surrogate_keys import RANGES_PER_PARTITION, KeyBounds
from delivery_marts.plans.normalize import feed_key_bounds, keyed, normalize
from delivery_marts.schemas import MARTS, TABLES
from delivery_marts.session import PARTITIONS, Limits, configure, scratch, sized, stored_bytes
from delivery_marts.sinks.conform import conform
from delivery_marts.sinks.records import create_record, list_folder, read_record
from delivery_marts.sinks.retention import leased
from delivery_marts.sinks.tables import (
    last_number,
    new_version,
    publish,
    write_all,
    write_mart,
    write_table,
)
from delivery_marts.sources.raw_feed import feed_bytes, feed_state, list_feed, read_feed
from delivery_marts.sources.tables import (
    mart_root,
    publications,
    published,
    read_mart_version,
    read_version,
    version_path,
)


class ConstraintError(ValueError):
    """What was written broke declared constraints and was not published."""


# Buckets that one order may fill by itself before tables are stored without buckets.
HOT_BUCKETS = 2


def layout_buckets(spark: SparkSession, bounds: dict[str, KeyBounds]) -> int | None:
    """In how many buckets by order the tables are stored; None where an order is hot.

    A bucket is read by one task. Where the sampled keys show that one order owns more than a
    few buckets' share of the rows, the tables are stored as they come: plans then shuffle them
    by order, and adaptive execution splits that order among tasks.
    """
    hottest = max((b.ranges_of_hottest() for b in bounds.values()), default=0)
    return int(spark.conf.get(PARTITIONS)) if hottest <= HOT_BUCKETS * RANGES_PER_PARTITION else None


def _refuse(version: str, broken: list[tuple[str, str, int]]) -> None:
    found = {f"{table}.{name}": count for table, name, count in broken if count}
    if found:
        raise ConstraintError(f"version {version} was not published: {found}")


class _Journal:
    """What a load has finished, kept with the version it writes.

    A record is created once a table is written in full, with the rows and broken rules that were
    counted on the way. Tables without one are written anew.
    """

    def __init__(self, spark: SparkSession, root: str, version: str):
        self.spark, self.version = spark, version
        self.folder = f"{root}/versions/{version}/_journal"

    def begin(self, state: str, buckets: int | None) -> None:
        create_record(self.spark, f"{self.folder}/begun.json", {"feed": state, "buckets": buckets})

    def finish(self, name: str, result: dict) -> None:
        create_record(self.spark, f"{self.folder}/{name}.json", result)

    def begun(self) -> dict | None:
        names = list_folder(self.spark, self.folder)
        return read_record(self.spark, f"{self.folder}/begun.json") if "begun.json" in names else None

    def finished(self) -> dict[str, dict]:
        names = [name.removesuffix(".json") for name in list_folder(self.spark, self.folder)]
        return {name: read_record(self.spark, f"{self.folder}/{name}.json") for name in names if name in TABLES}


def _unfinished(spark: SparkSession, root: str, state: str) -> _Journal | None:
    """The newest version that a load of this very feed began and did not publish."""
    known = {row.version for row in publications(spark, root).select("version").collect()}
    for version in sorted(list_folder(spark, f"{root}/versions"), reverse=True):
        journal = _Journal(spark, root, version)
        begun = None if version in known else journal.begun()
        if begun and begun["feed"] == state:
            return journal
    return None


def load(
    spark: SparkSession, feed_path: str, root: str, limits: Limits = Limits(), resume: bool = False
) -> dict[str, int]:
    """Normalise the feed and publish the seven tables, all or nothing.

    A version is written in full, tested against every declared constraint, and only then made
    current. If anything fails readers keep seeing the version before. Rows, and the rules that
    a single row can break, are counted by the tasks that write it; only references are read
    again. Uniqueness is not tested: each table is grouped by its key, so it holds by
    construction (and NULL keys break NOT NULL). Tables with orders are stored in buckets of
    them (see ``layout_buckets``). Returns the row count of each table.

    ``resume`` goes on with the newest version that a load of the same feed files began and did
    not publish: tables that it finished are kept, the others are written. Generated keys do not
    depend on where their ranges were cut, so the version is the one that a single run gives. If
    another version is published while this one is written, this one stays unpublished.

    Task sizes follow the feed's bytes within ``limits``; the session is left as it was, and
    nothing written on the way stays but the journal of a version.
    """
    configure(spark)
    after = last_number(spark, root)
    with scratch(spark, root) as folder:
        files = list_feed(spark, feed_path, f"{folder}/files")
        state = feed_state(files)
        journal = _unfinished(spark, root, state) if resume else None
        done = journal.finished() if journal else {}
        with sized(spark, feed_bytes(files), limits):
            feed = read_feed(spark, feed_path, files, f"{folder}/footers")
            bounds = {} if TABLES.keys() <= done.keys() else feed_key_bounds(feed)
            if journal:
                buckets = journal.begun()["buckets"]
            else:
                journal, buckets = _Journal(spark, root, new_version()), layout_buckets(spark, bounds)
                journal.begin(state, buckets)
            version = journal.version
            with leased(spark, root, version):

                def writer(name: str, table: DataFrame):
                    def write() -> None:
                        rules, path = RowRules(TABLES[name]), version_path(root, version, name)
                        write_table(keyed(name, table, bounds.get(name)), path, buckets, rules.observe)
                        journal.finish(name, rules.record())

                    return write

                tables = normalize(feed)
                write_all({name: writer(name, table) for name, table in tables.items() if name not in done})
                done = journal.finished()
                broken = [(t, c, n) for result in done.values() for t, _, c, n in result["counts"]]
                written = read_version(spark, root, version, buckets)
                lost = reference_counts(written, TABLES).where("violations > 0").collect()
                _refuse(version, [*broken, *((r.table_name, r.constraint_name, r.violations) for r in lost)])
                counts = {name: done[name]["rows"] for name in TABLES}
                publish(spark, root, version, counts, buckets=buckets, after=after)
    return counts


@contextmanager
def _current_tables(
    spark: SparkSession, root: str, names: tuple[str, ...], limits: Limits
) -> Iterator[dict[str, DataFrame]]:
    """Some of the current tables, in a session sized for their bytes."""
    configure(spark)
    newest = published(spark, root)
    paths = [version_path(root, newest.version, name) for name in names]
    with leased(spark, root, newest.version), sized(spark, stored_bytes(spark, *paths), limits):
        yield read_version(spark, root, newest.version, newest.buckets)


def check_quality(spark: SparkSession, root: str, limits: Limits = Limits()) -> dict[str, int]:
    """All quality checks on the current tables; raises QualityError if any fails."""
    with _current_tables(spark, root, tuple(TABLES), limits) as t:
        return assert_quality(quality_report(t))


def _publish_mart(spark: SparkSession, root: str, name: str, mart: DataFrame, declared: bool) -> int:
    """Write a mart, test it if it is to be as declared, and make it current.

    With ``declared`` a mart keeps its whole declaration or is refused: types, NOT NULL, lengths,
    and its key. So an items mart with the cell of orders without lines, which has no item, is
    refused, and ``item_id_not_null`` named. Without it marts are published as computed, that
    cell included.
    """
    version, home, spec = new_version(), mart_root(root, name), MARTS[name]
    after = last_number(spark, home)
    path = version_path(home, version, name)
    frame = conform(mart, spec.schema) if declared else mart
    rules = RowRules(spec)
    write_mart(frame, path, rules.observe)
    schema = frame.schema.json()
    if declared:
        keys = primary_key_violations(read_mart_version(spark, path, name, schema), spec).count()
        _refuse(version, [*((t, c, n) for t, _, c, n in rules.counts), (name, f"{name}_pkey", keys)])
    publish(spark, home, version, {name: rules.rows}, schema, after=after)
    return rules.rows


def build_orders_mart(
    spark: SparkSession, root: str, declared: bool = False, limits: Limits = Limits()
) -> int:
    """Build and publish the orders mart; returns its row count.

    Money is double, as computed. ``declared`` gives the declared types instead, raises if a
    value does not fit them, and tests every declared rule before publishing.
    """
    with _current_tables(spark, root, ("orders", "order_items", "delivery_assignments"), limits) as t:
        mart = orders_mart(t["orders"], t["order_items"], t["delivery_assignments"])
        return _publish_mart(spark, root, "orders_datamart", mart, declared)


def build_items_mart(
    spark: SparkSession, root: str, declared: bool = False, limits: Limits = Limits()
) -> int:
    """Build and publish the items mart, like ``build_orders_mart``."""
    with _current_tables(spark, root, ("orders", "order_items", "items"), limits) as t:
        mart = items_mart(t["orders"], t["order_items"], t["items"])
        return _publish_mart(spark, root, "items_datamart", mart, declared)


def run_pipeline(
    spark: SparkSession, feed_path: str, root: str, limits: Limits = Limits()
) -> dict[str, int]:
    """All four jobs in order; a failure stops the ones after it."""
    counts = load(spark, feed_path, root, limits)
    check_quality(spark, root, limits)
    counts["orders_datamart"] = build_orders_mart(spark, root, limits=limits)
    counts["items_datamart"] = build_items_mart(spark, root, limits=limits)
    return counts
