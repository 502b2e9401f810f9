"""Shapes of physical plans: what is shuffled, pushed down, split and never done."""

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from delivery_marts.catalog.queries import QUERIES
from delivery_marts.operators import surrogate_keys
from delivery_marts.operators.assignments import delivery_assignments
from delivery_marts.operators.joins import left_join_many
from delivery_marts.operators.lines import order_lines
from delivery_marts.plans.marts import items_mart, orders_mart
from delivery_marts.plans.normalize import normalize
from delivery_marts.schemas import LINE_GROUP, TABLES, storage_schema
from delivery_marts.sinks.conform import conform
from delivery_marts.sources.raw_feed import read_feed
from tests.conftest import at, values
from tests.test_sources_and_pipeline import FEED, write_file

ORDERS, HOT_LINES = 300, 30_000


@contextmanager
def settings(spark, **pairs):
    old = {key: spark.conf.get(key, None) for key in pairs}
    try:
        for key, value in pairs.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
EAGER_SPLITS = {
    **NO_BROADCAST,
    "spark.sql.shuffle.partitions": "8",
    # a partition is split between map outputs, so there have to be several
    "spark.sql.files.minPartitionNum": "8",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> tuple[list, str]:
    """Rows, and the plan adaptive execution ended with."""
    rows = df.collect()
    return rows, plan(df).split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Published-like tables in which one of 300 orders owns almost all lines."""
    root = tmp_path_factory.mktemp("tables")
    ids = spark.range(ORDERS).select(F.col("id").cast("int").alias("order_id"))
    moment = F.lit(at("10:00"))
    frames = {
        "orders": ids.withColumns(
            {"user_id": F.lit(1), "store_id": F.col("order_id") % 3, "address_text": F.lit("Москва, 1"),
             "created_at": moment, "status": F.lit("delivered"), "order_discount": F.lit(0)}
        ),
        "order_items": spark.range(HOT_LINES + ORDERS // 2, numPartitions=8).select(
            F.col("id").alias("order_item_id"),
            F.when(F.col("id") < HOT_LINES, 7).otherwise(F.col("id") - HOT_LINES).alias("order_id"),
            (F.xxhash64("id") % 1000).alias("item_id"),
            F.lit(1).alias("item_quantity"),
            (F.xxhash64("id") % 100_000).alias("item_price"),
            F.lit(0).alias("item_discount"),
            F.lit(0).alias("item_canceled_quantity"),
        ),
        "items": spark.range(1000).select(
            F.col("id").alias("item_id"), F.lit("t").alias("item_title"), F.lit("c").alias("item_category")
        ),
        "delivery_assignments": ids.withColumns(
            {"assignment_id": F.col("order_id"), "driver_id": F.lit(1), "assigned_at": moment}
        ),
    }
    out = {}
    for name, frame in frames.items():
        schema = storage_schema(TABLES[name].schema)
        missing = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in frame.columns}
        conform(frame.withColumns(missing), schema).write.parquet(f"{root}/{name}")
        out[name] = spark.read.schema(schema).parquet(f"{root}/{name}")
    return out


def test_orders_mart_shuffles_each_table_once_by_order(spark, tables):
    t = tables
    with settings(spark, **NO_BROADCAST):
        text = plan(orders_mart(t["orders"], t["order_items"], t["delivery_assignments"]))
    assert re.findall(r"Exchange (\w+)\((\w+)#", text) == [("hashpartitioning", "order_id")] * 3
    assert "PushedFilters: [IsNull(unassigned_at)" in text
    lines_scan = next(row for row in text.splitlines() if "item_price" in row and "FileScan" in row)
    assert "order_item_id" not in lines_scan and "replaced_by_item_id" not in lines_scan


def test_items_mart_counts_orders_without_another_shuffle_of_lines(spark, tables):
    t = tables
    with settings(spark, **NO_BROADCAST):
        rows, text = final_plan(items_mart(t["orders"], t["order_items"], t["items"]))
    exchanges = re.findall(r"\+- Exchange hashpartitioning\((\w+)#", text)
    # lines, orders (shared by both joins), distinct ids of the lines, cells, cells by item, items
    assert sorted(exchanges) == ["created_on", "item_id", "item_id", "order_id", "order_id", "order_id"]
    assert "ReusedExchange [order_id" in text
    assert "Expand" not in text
    assert sum(r.orders_cnt for r in rows if r.item_id is None) == ORDERS - ORDERS // 2


def test_hot_order_is_split_in_the_items_mart(spark, tables):
    t = tables
    want = values(items_mart(t["orders"], t["order_items"], t["items"]))
    with settings(spark, **EAGER_SPLITS):
        mart = items_mart(t["orders"], t["order_items"], t["items"])
        _, text = final_plan(mart)
        assert values(mart) == want
    assert "SortMergeJoin(skew=true)" in text


def test_hot_order_is_split_in_a_left_join(spark, tables):
    orders = tables["orders"].select("order_id", "store_id")
    lines = tables["order_items"].select("order_id", "order_item_id")
    with settings(spark, **EAGER_SPLITS):
        joined = left_join_many(orders, lines, "order_id")
        rows, text = final_plan(joined)
        _, plain = final_plan(orders.join(lines, "order_id", "left"))
    assert "SortMergeJoin(skew=true)" in text
    assert "skew=true" not in plain, "Spark can split this by itself now"
    assert len(rows) == HOT_LINES + ORDERS // 2 + (ORDERS - ORDERS // 2)


def test_hot_order_is_split_among_surrogate_key_ranges(spark, tables):
    lines = tables["order_items"].drop("order_item_id").dropDuplicates(list(LINE_GROUP))
    bounds = surrogate_keys.key_bounds(lines, LINE_GROUP, 16)
    sizes = lines.where("order_id = 7").groupBy(bounds.range_of(lines)).count().collect()
    assert len(sizes) >= 14 and max(r["count"] for r in sizes) < HOT_LINES / 4
    assert bounds.ranges_of_hottest() >= 13
    rows = surrogate_keys.key_order_lines(lines, bounds).orderBy("order_item_id").collect()
    assert [r.order_item_id for r in rows] == list(range(1, lines.count() + 1))
    assert [r[1:6] for r in rows] == sorted(r[1:6] for r in rows) or any(None in r[1:6] for r in rows)


def test_numbers_do_not_depend_on_the_bounds(spark, tables):
    lines = tables["order_items"].drop("order_item_id").dropDuplicates(list(LINE_GROUP))
    prefix = surrogate_keys.key_bounds(tables["order_items"].where("item_id % 3 = 0"), LINE_GROUP[:2], 5)
    one = surrogate_keys.KeyBounds(LINE_GROUP)
    numbered = [values(surrogate_keys.key_order_lines(lines, bounds)) for bounds in (None, prefix, one)]
    assert numbered[0] == numbered[1] == numbered[2]


def test_sizes_and_rows_of_ranges_are_shuffled_once_and_nothing_is_staged(spark, tables):
    lines = tables["order_items"].drop("order_item_id").dropDuplicates(list(LINE_GROUP))
    bounds = surrogate_keys.key_bounds(lines, LINE_GROUP, 16)
    _, text = final_plan(surrogate_keys.key_order_lines(lines, bounds))
    assert text.count("+- Exchange hashpartitioning(_range#") == 1 and "ReusedExchange [order_id#" in text
    assert "scratch" not in text


def test_bounds_are_a_sample_that_does_not_grow(spark, monkeypatch):
    monkeypatch.setattr(surrogate_keys, "SAMPLED_PER_RANGE", 4)
    rows = spark.range(200_000).select((F.col("id") % 50_000).alias("a"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("b"))
    bounds = surrogate_keys.key_bounds(rows, ("a", "b"), 64)
    assert 40 <= len(bounds.codes) <= 63 and list(bounds.codes) == sorted(set(bounds.codes))
    with pytest.raises(TypeError, match="s is string"):
        surrogate_keys.key_bounds(spark.createDataFrame([("x",)], "s string"), ("s",))


def test_hot_order_is_split_when_assignments_meet_their_ends(spark, tmp_path):
    """One order of one file owns nearly all courier history."""
    start = F.lit(at("10:00"))
    feed = spark.range(HOT_LINES + ORDERS, numPartitions=8).select(
        F.lit(0).cast("bigint").alias("file_no"),
        F.col("id").alias("row_no"),
        F.when(F.col("id") < HOT_LINES, -1).otherwise(F.col("id")).alias("order_id"),
        F.xxhash64("id").alias("driver_id"),
        start.alias("delivery_started_at"),
        F.when(F.col("id") % 2 == 0, start).alias("delivered_at"),
        F.lit(None).cast("timestamp_ntz").alias("canceled_at"),
    )
    feed.write.parquet(str(tmp_path / "feed"))
    feed = spark.read.parquet(str(tmp_path / "feed"))
    with settings(spark, **EAGER_SPLITS):
        rows, text = final_plan(delivery_assignments(feed))
    assert "SortMergeJoin(skew=true)" in text
    assert len(rows) == HOT_LINES + ORDERS
    assert sum(r.unassigned_at is None for r in rows) == ORDERS // 2


@pytest.fixture(scope="module")
def raw_feed(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    write_file(folder, "a.parquet", *FEED)
    return read_feed(spark, f"{folder}/*.parquet")


def test_lines_need_no_file_number_and_only_their_columns(spark, raw_feed):
    text = plan(order_lines(raw_feed))
    assert "Join" not in text
    assert "IsNotNull(item_price)" in text
    assert "address_text" not in text
    assert text.count("HashAggregate") == 2 and text.count("Exchange") == 1


def test_each_dimension_and_header_shuffles_its_key_once(spark, raw_feed):
    tables = normalize(raw_feed)
    for name, key in {"users": "user_id", "stores": "store_id", "items": "item_id", "orders": "order_id"}.items():
        exchanges = re.findall(r"Exchange hashpartitioning\((\w+)#", plan(tables[name]))
        assert [e for e in exchanges if e != "path_hash"] == [key], name


def test_file_numbers_never_shuffle_the_feed(spark, raw_feed):
    """Also where broadcasts are not chosen by size: the numbers have a fixed bound."""
    with settings(spark, **NO_BROADCAST):
        for name, table in normalize(raw_feed).items():
            text = plan(table)
            assert "SortMergeJoin [path_hash" not in text, name
            # the only exchange by path is of the list of files
            assert text.count("Exchange hashpartitioning(path_hash") == text.count("BroadcastHashJoin [path_hash"), name


def test_assignment_ends_are_hash_aggregated(spark, raw_feed):
    assert "SortAggregate" not in plan(delivery_assignments(raw_feed))


def test_assignments_shuffle_starts_once_before_their_last_distinct(spark, raw_feed):
    """Starts and ends for the join, ends for their own grouping, and the distinct rows."""
    with settings(spark, **NO_BROADCAST):
        text = plan(delivery_assignments(raw_feed))
    exchanges = [e for e in re.findall(r"Exchange hashpartitioning\((\w+)#", text) if e != "path_hash"]
    assert len(exchanges) == 4
    assert exchanges.count("file_no") == 2 and exchanges.count("order_id") == 1


def test_no_plan_crosses_rows_or_leaves_the_jvm(spark):
    banned = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "MapInArrow")
    for name, query in QUERIES.items():
        text = plan(query(spark, "/root/testdata/sf0.001"))
        assert [b for b in banned if b in text] == [], name
