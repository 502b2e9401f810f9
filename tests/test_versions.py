"""Publication, resumed loads and removal of old versions."""

import datetime as dt
import os
import threading

import pytest

import jobs
from delivery_marts.plans import pipeline
from delivery_marts.plans.pipeline import ConstraintError, build_orders_mart, load
from delivery_marts.schemas import TABLES
from delivery_marts.session import stored_bytes
from delivery_marts.sinks import tables as sink
from delivery_marts.sinks.records import RecordExists, create_record, list_folder, read_record, remove_record
from delivery_marts.sinks.retention import leased, remove_old, remove_versions
from delivery_marts.sinks.tables import ConcurrentPublication, last_number, publish
from delivery_marts.sources.tables import PUBLICATION, current, current_version, publications, read_current, version_path
from tests.conftest import values
from tests.test_sources_and_pipeline import FEED, write_file

NONE = dt.timedelta(0)


@pytest.fixture
def raw(tmp_path):
    (tmp_path / "raw").mkdir()
    write_file(tmp_path / "raw", "a.parquet", *FEED)
    return f"{tmp_path}/raw/*.parquet"


def test_a_record_is_created_once(spark, tmp_path):
    path = f"{tmp_path}/folder/7.json"
    create_record(spark, path, {"a": "é"})
    with pytest.raises(RecordExists):
        create_record(spark, path, {"a": 2})
    assert read_record(spark, path) == {"a": "é"} and list(list_folder(spark, f"{tmp_path}/folder")) == ["7.json"]
    assert os.listdir(tmp_path / "folder") == ["7.json"]
    remove_record(spark, path)
    assert list_folder(spark, f"{tmp_path}/folder") == list_folder(spark, f"{tmp_path}/none") == {}


def test_of_many_publishers_at_once_one_wins(spark, tmp_path):
    root, wins, losses = str(tmp_path), [], []
    publish(spark, root, "first", {})
    begun = last_number(spark, root)
    gate = threading.Barrier(8)

    def run(name):
        gate.wait()
        try:
            publish(spark, root, name, {}, after=begun)
            wins.append(name)
        except ConcurrentPublication:
            losses.append(name)

    threads = [threading.Thread(target=run, args=(f"v{i}",)) for i in range(8)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert len(wins) == 1 and len(losses) == 7
    assert current_version(spark, root) == wins[0] and publications(spark, root).count() == 2


def test_a_load_does_not_replace_what_was_published_meanwhile(spark, tmp_path, raw, monkeypatch):
    root = str(tmp_path / "out")

    def overtaken(*args):
        if current(spark, root) is None:
            publish(spark, root, "faster", {})
        return real(*args)

    real = pipeline.reference_counts
    monkeypatch.setattr(pipeline, "reference_counts", overtaken)
    with pytest.raises(ConcurrentPublication, match="has a publication 1"):
        load(spark, raw, root)
    assert current_version(spark, root) == "faster"


def test_a_log_from_before_numbered_names_goes_on(spark, tmp_path):
    root = str(tmp_path)
    old = [("v1", 1, None, {}, None, None), ("v2", 2, None, {}, None, None)]
    spark.createDataFrame(old, PUBLICATION).coalesce(1).write.json(f"{root}/published")
    assert last_number(spark, root) == 2
    publish(spark, root, "v3", {"orders": 5})
    assert current(spark, root).sequence == 3 and current(spark, root).row_counts == {"orders": 5}


class Lost(Exception):
    """Stands for a driver that is gone."""


def broken_after(monkeypatch, finished):
    """Writes of ``finished`` tables succeed, then the load breaks."""
    real = pipeline.write_table
    written = []

    def write(df, path, *rest):
        if len(written) == finished:
            raise Lost
        real(df, path, *rest)
        written.append(path.rpartition("/")[2])

    monkeypatch.setattr(pipeline, "write_table", write)
    monkeypatch.setattr(sink, "PARALLEL_WRITES", 1)
    return written


def test_a_broken_load_is_finished_without_writing_again(spark, tmp_path, raw, monkeypatch):
    root = str(tmp_path / "out")
    whole = str(tmp_path / "whole")
    counts = load(spark, raw, whole)
    with monkeypatch.context() as patch:
        first = broken_after(patch, 4)
        with pytest.raises(Lost):
            load(spark, raw, root)
    (version,) = list_folder(spark, f"{root}/versions")
    assert len(first) == 4 and current_version(spark, root) is None
    before = {name: os.stat(version_path(root, version, name)).st_mtime_ns for name in first}
    with monkeypatch.context() as patch:
        second = broken_after(patch, 99)
        assert load(spark, raw, root, resume=True) == counts
    assert sorted(first + second) == sorted(TABLES)
    assert {name: os.stat(version_path(root, version, name)).st_mtime_ns for name in first} == before
    assert current_version(spark, root) == version
    assert publications(spark, root).first().row_counts == counts
    want = {n: values(t) for n, t in read_current(spark, whole).items()}
    assert {n: values(t) for n, t in read_current(spark, root).items()} == want
    # Nothing is left to resume: the next load is a new version.
    load(spark, raw, root, resume=True)
    assert current_version(spark, root) != version


def test_another_feed_is_not_resumed(spark, tmp_path, raw, monkeypatch):
    root = str(tmp_path / "out")
    with monkeypatch.context() as patch:
        broken_after(patch, 2)
        with pytest.raises(Lost):
            load(spark, raw, root)
    write_file(tmp_path / "raw", "b.parquet", {"order_id": 9})
    assert load(spark, raw, root, resume=True)["orders"] == 3
    assert len(list_folder(spark, f"{root}/versions")) == 2


def test_a_refused_version_is_refused_again_when_resumed(spark, tmp_path, raw):
    write_file(tmp_path / "raw", "b.parquet", {"order_id": 8, "item_quantity": 0})
    root = str(tmp_path / "out")
    for resume in (False, True):
        with pytest.raises(ConstraintError, match="order_items.item_quantity_positive': 1"):
            load(spark, raw, root, resume=resume)
    assert len(list_folder(spark, f"{root}/versions")) == 1


def test_old_versions_go_and_leased_ones_stay(spark, tmp_path, raw, monkeypatch):
    root, versions = str(tmp_path / "out"), []
    for _ in range(4):
        load(spark, raw, root)
        versions.append(current_version(spark, root))
    with monkeypatch.context() as patch:
        broken_after(patch, 1)
        with pytest.raises(Lost):
            load(spark, raw, root)
    assert remove_versions(spark, root) == []  # all of them are young
    with leased(spark, root, versions[1]):
        reader = read_current(spark, root)["orders"]
        removed = remove_versions(spark, root, keep=2, minimum_age=NONE)
        assert sorted(removed)[0] == versions[0] and len(removed) == 2  # and the one never published
        assert stored_bytes(spark, version_path(root, versions[1], "orders")) > 0
        assert remove_versions(spark, root, minimum_age=NONE, lease=dt.timedelta(hours=1)) == [versions[2]]
    assert remove_versions(spark, root, minimum_age=NONE) == [versions[1]]
    assert list(list_folder(spark, f"{root}/versions")) == [versions[3]]
    assert reader.count() == 2 and build_orders_mart(spark, root) == 2
    with pytest.raises(ValueError, match="has to stay"):
        remove_versions(spark, root, keep=0)


def test_a_lease_that_was_never_given_back_ends(spark, tmp_path, raw):
    root = str(tmp_path / "out")
    load(spark, raw, root)
    old = current_version(spark, root)
    create_record(spark, f"{root}/versions/{old}/_leases/dead.json", {})
    load(spark, raw, root)
    assert remove_versions(spark, root, minimum_age=NONE) == []
    assert remove_versions(spark, root, minimum_age=NONE, lease=NONE) == [old]


def test_jobs_hold_leases_and_marts_are_cleaned_too(spark, tmp_path, raw, monkeypatch, capsys):
    root = str(tmp_path / "out")
    load(spark, raw, root)
    version, held = current_version(spark, root), []
    real = pipeline.orders_mart
    monkeypatch.setattr(
        pipeline, "orders_mart", lambda *t: held.append(len(list_folder(spark, f"{root}/versions/{version}/_leases"))) or real(*t)
    )
    for _ in range(3):
        build_orders_mart(spark, root)
    assert held == [1, 1, 1] and list_folder(spark, f"{root}/versions/{version}/_leases") == {}
    found = remove_old(spark, root, keep=2, minimum_age=NONE)
    assert {name: len(gone) for name, gone in found.items()} == {"tables": 0, "orders_datamart": 1, "items_datamart": 0}
    jobs.main(["clean", "--root", root, "--days", "0"])
    assert capsys.readouterr().out.count("T") >= 1
    assert len(list_folder(spark, f"{root}/marts/orders_datamart/versions")) == 1
