"""The feed of the named queries, stored once for those that read it often."""

import datetime as dt

import pytest

from delivery_marts.catalog import inputs
from delivery_marts.catalog.queries import QUERIES
from delivery_marts.operators.ordering import FILE, ROW
from delivery_marts.operators.surrogate_keys import LARGEST, KeyBounds
from delivery_marts.plans.normalize import feed_key_bounds, normalize
from delivery_marts.schemas import RAW_FEED
from delivery_marts.session import scratch_path
from delivery_marts.sources.driver_tables import read_feed, store_feed
from tests.conftest import values

SF_DIR = "/root/testdata/sf0.001"
DAY = dt.datetime(2024, 1, 5)
LINE_TYPES = """l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,
    l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,
    l_shipdate timestamp_ntz"""


def line(order, number, part=7, supplier=3, quantity=5.0, shipped=DAY):
    return (order, part, supplier, number, quantity, 10.0, 0.1, 0.0, "R", "F", shipped)


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Repeated lines, lines that differ in their last columns only, NULLs, a repeated order."""
    folder = str(tmp_path_factory.mktemp("odd"))
    lines = [line(1, 1), line(1, 1), line(1, 1, quantity=None), line(1, 1, part=9), line(1, 2, shipped=None)]
    lines += [line(2, None), line(2, 4, supplier=19), line(None, 1), line(99, 1), line(3, 1), line(3, 4)]
    tables = {
        "lineitem": (lines, LINE_TYPES),
        "orders": (
            [(1, 1, "1-URGENT"), (2, 2, None), (3, 1, "5-LOW"), (3, 1, "5-LOW"), (4, 1, "5-LOW"), (5, None, "5-LOW")],
            "o_orderkey long, o_custkey long, o_orderpriority string",
        ),
        "customer": ([(1, 0), (2, 1), (None, 1)], "c_custkey long, c_nationkey int"),
        "nation": ([(0, 0), (1, 1)], "n_nationkey int, n_regionkey int"),
        "region": ([(n, f"R{n}") for n in range(5)], "r_regionkey int, r_name string"),
    }
    for name, (rows, types) in tables.items():
        spark.createDataFrame(rows, types).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_a_stored_feed_has_the_rows_of_the_feed(spark, odd):
    stored = store_feed(spark, odd, scratch_path(spark, "feed"))
    plain = read_feed(spark, odd)
    assert stored.columns == plain.columns
    columns = [*RAW_FEED.names, FILE]
    assert stored.dtypes[:-1] == plain.dtypes[:-1]
    assert sorted(map(repr, stored.select(columns).collect())) == sorted(map(repr, plain.select(columns).collect()))


def test_a_stored_feed_has_the_order_of_the_feed(spark, odd):
    columns = [*RAW_FEED.names, FILE]
    rows = [
        [tuple(r)[:-1] for r in feed.select(*columns, ROW).where("file_no IS NOT NULL").orderBy(FILE, ROW, *columns).collect()]
        for feed in (store_feed(spark, odd, scratch_path(spark, "feed")), read_feed(spark, odd))
    ]
    assert rows[0] == rows[1]


def test_tables_are_alike_from_a_stored_feed(spark, odd):
    stored, plain = normalize(inputs.stored_feed(spark, odd)), normalize(read_feed(spark, odd))
    kept = inputs.kept_tables(spark, stored)
    for name, table in plain.items():
        assert kept[name].dtypes == stored[name].dtypes == table.dtypes
        assert values(kept[name]) == values(table), name


@pytest.mark.parametrize(
    "name",
    ["not_null_violations", "pk_violations", "fk_violations", "constraint_counts", "quality_report", "row_counts",
     "assignments_keyed", "order_items_keyed", "laid_out_orders_mart", "laid_out_items_mart"],
)
def test_joins_of_the_feed_are_not_repeated(spark, name):
    """Queries that read many tables find them stored; before, each table joined the feed anew."""
    assert not [f for f in QUERIES[name](spark, SF_DIR).inputFiles() if "lineitem" in f]


def test_bounds_are_sampled_of_the_tables_asked_for(spark):
    feed = inputs.stored_feed(spark, SF_DIR, "delivery_assignments")
    assert list(feed_key_bounds(feed, "delivery_assignments")) == ["delivery_assignments"]


def test_ranges_by_the_first_column_are_those_of_whole_keys(spark):
    codes = ((2, 5), (2, 9), (4, 1), (7, LARGEST), (LARGEST, 3))
    rows = [(a, b) for a in (None, -3, 1, 2, 3, 4, 7, 8, LARGEST) for b in (None, 0, 1, 3, 5, 9, 10)]
    df = spark.createDataFrame(rows, "a long, b long")

    def code(value):
        return LARGEST if value is None else value

    found = df.select("a", "b", KeyBounds(("a", "b"), codes).range_of(df).alias("r")).collect()
    assert len(found) == len(rows)
    for row in found:
        assert row.r == sum(bound <= (code(row.a), code(row.b)) for bound in codes)
    assert {r.r for r in df.select(KeyBounds(("a", "b")).range_of(df).alias("r")).collect()} == {0}


def test_whole_keys_are_compared_at_bounds_only(spark):
    """The first column settles a row whose value no bound begins with."""
    df = spark.range(3).selectExpr("id AS a", "CAST(raise_error('compared') AS bigint) AS b")
    bounds = KeyBounds(("a", "b"), ((-5, 1), (9, 1)))
    assert [r.r for r in df.select(bounds.range_of(df).alias("r")).collect()] == [1, 1, 1]
