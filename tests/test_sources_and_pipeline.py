import datetime as dt
import os
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import AnalysisException

import jobs
from delivery_marts.operators.quality import QualityError
from delivery_marts.plans import pipeline
from delivery_marts.plans.pipeline import (
    ConstraintError,
    build_items_mart,
    build_orders_mart,
    check_quality,
    load,
    run_pipeline,
)
from delivery_marts.schemas import MARTS, RAW_FEED, TABLES, computed_schema, storage_schema
from delivery_marts.operators.ordering import MOST_FILES
from delivery_marts.session import Limits, _bytes, scratch_path, sized, stored_bytes, task_sizes
from delivery_marts.sinks.jdbc import write_jdbc
from delivery_marts.sinks.tables import publish, row_counts, write_mart, write_table
from delivery_marts.sources.jdbc import range_options
from delivery_marts.sources import raw_feed
from delivery_marts.sources.raw_feed import feed_bytes, list_feed, read_feed
from delivery_marts.sources.tables import (
    current_version,
    mart_root,
    publications,
    read_current,
    read_mart,
    read_table,
    version_path,
)
from tests.conftest import LINE, at, values


def write_file(folder, name, *lines, **pandas_options):
    frame = pd.DataFrame([{**LINE, **line} for line in lines], columns=RAW_FEED.names)
    for column in frame.columns:
        if column.endswith("_at"):
            frame[column] = pd.to_datetime(frame[column])
    frame.to_parquet(folder / name, **pandas_options)


def test_files_are_numbered_by_path_and_rows_by_position(spark, tmp_path):
    write_file(tmp_path, "part-2.parquet", {"order_id": 3}, {"order_id": 4})
    write_file(tmp_path, "part-10.parquet", {"order_id": 1}, {"order_id": 2})
    got = values(read_feed(spark, f"{tmp_path}/*.parquet"), "order_id", "file_no", "row_no")
    assert got == [(1, 1, 0), (2, 1, 1), (3, 2, 0), (4, 2, 1)]


def test_paths_that_need_encoding_are_ordered_as_plain_text(spark, tmp_path):
    names = ["a b.parquet", "a!.parquet", "a%20b.parquet", "aé.parquet", "a+b.parquet"]
    for name in names:
        write_file(tmp_path, name, {"store_address": name})
    got = values(read_feed(spark, f"{tmp_path}/*.parquet"), "file_no", "store_address")
    assert [name for _, name in got] == sorted(names)


def test_file_that_arrives_after_the_listing_is_not_dropped_silently(spark, tmp_path):
    write_file(tmp_path, "a.parquet", {"order_id": 1})
    files = list_feed(spark, f"{tmp_path}/*.parquet")
    write_file(tmp_path, "b.parquet", {"order_id": 2})
    with pytest.raises(Exception, match="file not listed"):
        read_feed(spark, f"{tmp_path}/*.parquet", files).select("order_id", "file_no").collect()


def test_missing_feed_raises(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_feed(spark, f"{tmp_path}/*.parquet")


def test_missing_column_raises(spark, tmp_path):
    pd.DataFrame([{k: v for k, v in LINE.items() if k == "order_id"}]).to_parquet(tmp_path / "a.parquet")
    with pytest.raises(Exception, match="user_id"):
        read_feed(spark, f"{tmp_path}/*.parquet")


def test_a_single_file_that_lacks_columns_raises(spark, tmp_path):
    """Read with the others it would give NULLs, and its lines would be dropped silently."""
    write_file(tmp_path, "a.parquet", *[{"order_id": i} for i in range(5)])
    lines = pd.DataFrame([LINE] * 5, columns=RAW_FEED.names)
    lines.drop(columns=["item_price", "driver_id"]).to_parquet(tmp_path / "b.parquet")
    with pytest.raises(ValueError, match="b.parquet lacks driver_id, item_price"):
        read_feed(spark, f"{tmp_path}/*.parquet")
    # the same where types differ between files as well
    write_file(tmp_path, "c.parquet", {"driver_id": np.nan})
    with pytest.raises(ValueError, match="b.parquet lacks"):
        read_feed(spark, f"{tmp_path}/*.parquet")


def jobs_started(spark, action):
    group = f"count-{id(action)}"
    spark.sparkContext.setJobGroup(group, "counted")
    action()
    spark.sparkContext.setJobGroup("none", "")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_jobs_do_not_grow_with_the_files(spark, tmp_path):
    """Half of the files hold an integer column as double."""
    counts = []
    for files in (4, 60):
        folder = tmp_path / str(files)
        folder.mkdir()
        for i in range(files):
            write_file(folder, f"{i}.parquet", {"order_id": i, "driver_id": np.nan if i % 2 else 1})
        pattern = f"{folder}/*.parquet"
        counts.append(jobs_started(spark, lambda pattern=pattern: read_feed(spark, pattern)))
        assert read_feed(spark, pattern).select("order_id").count() == files
    # the paths of the mixed case come partition by partition, of which there are a few
    assert counts[1] <= counts[0] + spark.sparkContext.defaultParallelism + 4


def test_footers_are_read_once_and_only_unread_files_are_asked_of_spark(spark, tmp_path, monkeypatch):
    for i in range(6):
        write_file(tmp_path, f"{i}.parquet", {"order_id": i, "driver_id": np.nan if i % 2 else 1})
    read, asked = spark.sparkContext.accumulator(0), []
    kinds, spark_kinds = raw_feed._kinds, raw_feed._spark_kinds

    def counting(batches, unread=()):
        for batch in kinds(batches):
            read.add(len(batch))
            closed = batch["path"].str.contains("|".join(unread) or "$^")
            yield batch.assign(kinds=batch["kinds"].where(~closed, None))

    monkeypatch.setattr(raw_feed, "_kinds", counting)
    monkeypatch.setattr(raw_feed, "_spark_kinds", lambda s, files: asked.extend(files) or spark_kinds(s, files))
    assert read_feed(spark, f"{tmp_path}/*.parquet").count() == 6
    assert read.value == 6 and not asked
    monkeypatch.setattr(raw_feed, "_kinds", lambda batches: counting(batches, ("/2.parquet", "/3.parquet")))
    got = values(read_feed(spark, f"{tmp_path}/*.parquet"), "order_id", "driver_id")
    assert got == [(i, None if i % 2 else 1) for i in range(6)]
    assert sorted(file[-9:] for file in asked) == ["2.parquet", "3.parquet"] and read.value == 12


def test_stores_that_only_spark_opens_are_read_all_the_same(spark, tmp_path, monkeypatch):
    write_file(tmp_path, "a.parquet", {"driver_id": 5})
    write_file(tmp_path, "b.parquet", {"driver_id": np.nan})
    monkeypatch.setattr(raw_feed, "_kinds", lambda batches: (b.assign(kinds=[None] * len(b)) for b in batches))
    got = values(read_feed(spark, f"{tmp_path}/*.parquet"), "file_no", "driver_id")
    assert got == [(1, 5), (2, None)]
    pd.DataFrame([{"order_id": 1}]).to_parquet(tmp_path / "c.parquet")
    with pytest.raises(ValueError, match="c.parquet lacks"):
        read_feed(spark, f"{tmp_path}/*.parquet")


def test_more_files_than_can_be_numbered_are_refused(spark, tmp_path, monkeypatch):
    assert (MOST_FILES << 40) + (1 << 40) - 1 == (1 << 63) - 1
    write_file(tmp_path, "a.parquet", {})
    write_file(tmp_path, "b.parquet", {})
    monkeypatch.setattr(raw_feed, "MOST_FILES", 1)
    with pytest.raises(ValueError, match="has 2 files; 1 can be numbered"):
        list_feed(spark, f"{tmp_path}/*.parquet")


def test_column_types_may_differ_between_files(spark, tmp_path):
    """pandas writes an integer column as double once it holds a NULL."""
    write_file(tmp_path, "a.parquet", {"driver_id": 5})
    write_file(tmp_path, "b [1] {é}%20?.parquet", {"driver_id": np.nan}, {"driver_id": 6.0})
    write_file(tmp_path, "c.parquet", {"driver_id": 7, "driver_phone": 9001234567})
    write_file(tmp_path, "d.parquet", {"driver_id": 8, "driver_phone": 89001234567.0}, {"driver_phone": np.nan})
    feed = read_feed(spark, f"{tmp_path}/*.parquet")
    got = values(feed, "file_no", "driver_id", "driver_phone")
    assert [row[:2] for row in got] == [(1, 5), (2, 6), (2, None), (3, 7), (4, 1), (4, 8)]
    assert [row[2] for row in got][3:] == ["9001234567", None, "89001234567"]
    assert [f.dataType for f in feed.select(*RAW_FEED.names).schema] == [f.dataType for f in RAW_FEED]


@pytest.mark.parametrize("unit", ["us", "ms", "ns"])
def test_timestamps_of_any_unit(spark, tmp_path, unit):
    moments = ["2024-01-05 10:00:00", "1969-12-31 23:59:59"]
    lines = [{"created_at": pd.Timestamp(m)} for m in moments]
    write_file(tmp_path, "a.parquet", *lines, coerce_timestamps=None if unit == "ns" else unit)
    got = values(read_feed(spark, f"{tmp_path}/*.parquet"), "created_at")
    assert got == [(dt.datetime.fromisoformat(m),) for m in sorted(moments)]


def test_instants_become_utc_wall_clock(spark, tmp_path):
    moments = ["2024-03-31 01:30:00", "2024-10-27 00:30:00", "2024-10-27 01:30:00"]
    write_file(tmp_path, "a.parquet", *[{"created_at": pd.Timestamp(m, tz="UTC")} for m in moments])
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        got = values(read_feed(spark, f"{tmp_path}/*.parquet"), "created_at")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == [(dt.datetime.fromisoformat(m),) for m in moments]


def test_nanoseconds_are_floored_to_microseconds(spark, tmp_path):
    moments = [pd.Timestamp("1970-01-01 00:00:00.000001999"), pd.Timestamp(-500)]
    write_file(tmp_path, "a.parquet", *[{"created_at": m} for m in moments])
    got = values(read_feed(spark, f"{tmp_path}/*.parquet"), "created_at")
    assert [row[0].isoformat() for row in got] == ["1969-12-31T23:59:59.999999", "1970-01-01T00:00:00.000001"]


def test_fractions_round_half_away_from_zero(spark, tmp_path):
    write_file(tmp_path, "a.parquet", *[{"item_price": p} for p in (2.5, -2.5, 2.4, np.nan)])
    assert values(read_feed(spark, f"{tmp_path}/*.parquet"), "item_price") == [(-3,), (2,), (3,), (None,)]


def test_feed_bytes(spark, tmp_path):
    write_file(tmp_path, "a.parquet", {})
    assert feed_bytes(list_feed(spark, f"{tmp_path}/*.parquet")) == (tmp_path / "a.parquet").stat().st_size


FEED = [
    {"order_id": 1, "item_id": 1},
    {"order_id": 1, "item_id": 2, "item_title": "bread"},
    {"order_id": 2, "item_id": 1, "delivered_at": None, "item_replaced_id": 2},
]


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    write_file(folder, "a.parquet", *FEED)
    return folder


def test_pipeline_publishes_tables_and_marts(spark, tmp_path, raw):
    root = str(tmp_path / "out")
    counts = run_pipeline(spark, f"{raw}/*.parquet", root)
    assert counts == {
        "users": 1, "stores": 1, "drivers": 1, "items": 2, "orders": 2, "order_items": 3,
        "delivery_assignments": 2, "orders_datamart": 2, "items_datamart": 2,
    }
    tables = read_current(spark, root)
    assert values(tables["users"]) == [(1, "79001234567")]
    assert values(tables["order_items"], "order_item_id", "order_id", "item_id") == [(1, 1, 1), (2, 1, 2), (3, 2, 1)]
    assert values(tables["delivery_assignments"], "assignment_id", "unassigned_at") == [(1, at("11:00")), (2, None)]
    mart = read_mart(spark, root, "orders_datamart")
    assert values(mart, "order_id", "cash_flows", "driver_id") == [(1, 200.0, None), (2, 100.0, 1)]
    for name, spec in MARTS.items():
        published = read_mart(spark, root, name)
        assert published.count() == 2
        assert [(f.name, f.dataType) for f in published.schema] == [
            (f.name, f.dataType) for f in computed_schema(spec.schema)
        ]
    assert publications(spark, root).first().row_counts == {name: counts[name] for name in TABLES}


def test_rerun_gives_the_same_tables_under_a_new_version(spark, tmp_path, raw):
    root = str(tmp_path / "out")
    load(spark, f"{raw}/*.parquet", root)
    before, version = {n: values(t) for n, t in read_current(spark, root).items()}, current_version(spark, root)
    load(spark, f"{raw}/*.parquet", root)
    assert current_version(spark, root) != version
    assert {n: values(t) for n, t in read_current(spark, root).items()} == before


FAULTS = {
    "users.user_phone_not_null": {"user_id": 9, "user_phone": "n/a"},
    "users.user_id_not_null": {"user_id": None},
    "order_items.order_items_replaced_by_item_id_fkey": {"item_replaced_id": 77},
    "delivery_assignments.order_id_not_null": {"order_id": None},
    "order_items.item_quantity_positive": {"item_quantity": 0, "order_id": 8},
    "stores.store_address_length": {"store_address": "x" * 256, "store_id": 9},
}


def test_broken_load_leaves_the_old_version_current(spark, tmp_path, raw):
    root = str(tmp_path / "out")
    load(spark, f"{raw}/*.parquet", root)
    version = current_version(spark, root)
    write_file(raw, "b.parquet", {"order_id": 3}, *FAULTS.values())
    with pytest.raises(ConstraintError) as error:
        load(spark, f"{raw}/*.parquet", root)
    assert [name for name in FAULTS if name not in str(error.value)] == []
    assert current_version(spark, root) == version


def test_nothing_published_yet(spark, tmp_path):
    assert current_version(spark, str(tmp_path / "none")) is None
    with pytest.raises(FileNotFoundError):
        check_quality(spark, str(tmp_path / "none"))


def test_failed_checks_stop_the_run_before_the_marts(spark, tmp_path, raw):
    """All orders without courier: tables obey every constraint, but one is empty."""
    write_file(raw, "a.parquet", *[{**line, "driver_id": None} for line in FEED])
    root = str(tmp_path / "out")
    with pytest.raises(QualityError, match="drivers_count.*delivery_assignments_count"):
        run_pipeline(spark, f"{raw}/*.parquet", root)
    assert current_version(spark, root) is not None
    assert current_version(spark, mart_root(root, "orders_datamart")) is None
    # each job can also be run by hand
    assert build_orders_mart(spark, root, declared=True) == 2
    assert build_items_mart(spark, root) == 2
    money = read_mart(spark, root, "orders_datamart").select("cash_flows")
    assert [str(r.cash_flows) for r in money.orderBy("cash_flows").collect()] == ["100.00", "200.00"]


def test_jobs_from_the_command_line(spark, tmp_path, raw, capsys):
    jobs.main(["load", "--feed", f"{raw}/*.parquet", "--root", str(tmp_path / "out")])
    jobs.main(["check", "--root", str(tmp_path / "out")])
    assert "'orders': 2" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        jobs.parse(["load", "--root", "x"])


def test_mart_is_partitioned_by_month_and_overwritten(spark, tmp_path):
    schema = "order_id int, year int, month int"
    for rows in ([(1, 2024, 1), (2, 2024, 2)], [(3, 2023, 5)]):
        write_mart(spark.createDataFrame(rows, schema), str(tmp_path / "mart"))
    got = spark.read.parquet(str(tmp_path / "mart"))
    assert values(got, "order_id", "year", "month") == [(3, 2023, 5)]


def test_empty_table_keeps_its_schema(spark, tmp_path):
    empty = spark.createDataFrame([], "user_id int, user_phone string")
    write_table(empty, str(tmp_path / "users"))
    back = read_table(spark, str(tmp_path / "users"), TABLES["users"].schema)
    assert back.columns == ["user_id", "user_phone"]
    assert values(row_counts({"users": back})) == [("users", 0)]


def test_range_bounds_cover_the_column_and_bound_the_connections():
    assert range_options("order_id", 1, 400, 10) == {
        "partitionColumn": "order_id", "lowerBound": "1", "upperBound": "401", "numPartitions": "10",
    }
    assert range_options("order_id", 7, 7, 10)["numPartitions"] == "1"
    assert range_options("order_id", None, None, 10) == {}


class Recorder:
    """Stands for a frame and its writer; notes the calls."""

    def __init__(self):
        self.calls = {}

    write = property(lambda self: self)

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls[name] = (args, kwargs)
            return self

        return call


@pytest.mark.parametrize("keep", [True, False])
def test_jdbc_overwrite_truncates_unless_told_to_recreate(keep):
    frame = Recorder()
    write_jdbc(frame, "jdbc:x", "orders_datamart", 10, keep_declaration=keep, user="u")
    assert frame.calls["mode"] == (("overwrite",), {})
    assert frame.calls["repartition"] == ((10,), {})
    options = frame.calls["options"][1]
    assert options["truncate"] == str(keep).lower()
    assert (options["dbtable"], options["user"]) == ("orders_datamart", "u")


def test_task_sizes_grow_with_the_input_within_limits():
    assert task_sizes(10 << 20, 200, 128 << 20) == (200, 128 << 20)
    partitions, split = task_sizes(1 << 40, 200, 128 << 20)
    assert (partitions, split) == (2048, 128 << 20)
    assert task_sizes(100 << 40, 200, 128 << 20) == (100_000, 1 << 30)
    assert task_sizes(100 << 40, 200, 128 << 20, Limits(most_shuffle_partitions=300_000))[0] == 204_800


def test_jobs_are_sized_by_their_input_and_leave_the_session_as_it_was(spark, tmp_path, raw, monkeypatch):
    root, names = str(tmp_path / "out"), ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")
    before = [spark.conf.get(name) for name in names]
    seen = []

    def noted(plan):
        def run(*args):
            seen.append(int(spark.conf.get(names[0])))
            return plan(*args)

        return run

    for name in ("normalize", "quality_report", "orders_mart", "items_mart"):
        monkeypatch.setattr(pipeline, name, noted(getattr(pipeline, name)))
    small = Limits(shuffle_partition_bytes=1 << 10, most_shuffle_partitions=7)
    run_pipeline(spark, f"{raw}/*.parquet", root, small)
    assert seen == [7] * 4
    assert [spark.conf.get(name) for name in names] == before
    with pytest.raises(ZeroDivisionError), sized(spark, 1 << 50):
        raise ZeroDivisionError
    assert [spark.conf.get(name) for name in names] == before
    assert stored_bytes(spark, str(raw)) == (raw / "a.parquet").stat().st_size


def test_nothing_intermediate_stays(spark, tmp_path, raw):
    root = tmp_path / "out"
    shared = sorted(os.listdir(spark.conf.get("spark.checkpoint.dir")))
    run_pipeline(spark, f"{raw}/*.parquet", str(root))
    write_file(raw, "b.parquet", {"user_id": None})
    with pytest.raises(ConstraintError):
        load(spark, f"{raw}/*.parquet", str(root))
    assert sorted(os.listdir(root)) == ["marts", "published", "scratch", "versions"]
    assert os.listdir(root / "scratch") == []
    assert sorted(os.listdir(spark.conf.get("spark.checkpoint.dir"))) == shared


@pytest.mark.parametrize("declared", [True, False])
def test_empty_marts_have_their_columns(spark, tmp_path, declared):
    root = str(tmp_path / "out")
    for name, spec in TABLES.items():
        empty = spark.createDataFrame([], storage_schema(spec.schema))
        write_table(empty, version_path(root, "v1", name))
    publish(spark, root, "v1", dict.fromkeys(TABLES, 0))
    assert build_orders_mart(spark, root, declared) == build_items_mart(spark, root, declared) == 0
    for name, spec in MARTS.items():
        mart = read_mart(spark, root, name)
        assert mart.columns == spec.schema.names and mart.count() == 0


def test_the_last_publication_counts_whatever_the_clocks_say(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "out")
    publish(spark, root, "v-late-clock", {})
    moment = publications(spark, root).first().published_at
    early = type("Early", (dt.datetime,), {"now": classmethod(lambda cls, tz: moment - dt.timedelta(days=1))})
    monkeypatch.setattr("delivery_marts.sinks.tables.dt.datetime", early)
    publish(spark, root, "a-early-clock", {})
    assert current_version(spark, root) == "a-early-clock"


def test_byte_settings():
    assert [_bytes(s) for s in ("134217728b", "128m", "1g", "64KB", "5")] == [1 << 27, 1 << 27, 1 << 30, 1 << 16, 5]


def test_scratch_lies_in_the_folder_the_session_names(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_scratch_where_no_folder_is_named():
    """Below the warehouse in local runs; on a cluster the plan stops."""

    def session(master):
        settings = {"spark.sql.warehouse.dir": "file:/w"}
        conf = SimpleNamespace(get=lambda key, default=None: settings.get(key, default))
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    assert scratch_path(session("local[4]"), "x").startswith("file:/w/_scratch/delivery_marts/x-")
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            scratch_path(session(master), "x")
