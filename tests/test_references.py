"""References compared as exact bitmaps, against plain sets."""

import random

import pytest
from pyspark.sql import functions as F

from delivery_marts.operators.constraints import dangling, dangling_count, key_words, missing_words
from delivery_marts.schemas import BUCKETS, Reference

REF = Reference("parent_id", "parents", "id")
LEAST, MOST = -(2**63), 2**63 - 1


def frame(spark, column, keys, kind="long"):
    return spark.createDataFrame([(k,) for k in keys], f"{column} {kind}")


def lost_rows(children, parents, keep_null):
    held = set(parents) - {None}
    return sum(keep_null if k is None else k not in held for k in children)


def dense(rng):
    return [rng.randrange(5000) for _ in range(4000)]


def sparse(rng):
    return [rng.randrange(LEAST, MOST) for _ in range(500)]


def around_zero(rng):
    return [rng.randrange(-300, 300) for _ in range(800)]


def ends(rng):
    return [LEAST, LEAST + 1, LEAST + 63, LEAST + 64, MOST, MOST - 1, MOST - 63, MOST - 64, -1, 0, 63, 64, -64, -65]


def hot(rng):
    return [7] * 3000 + [rng.randrange(100) for _ in range(100)]


@pytest.mark.parametrize("keys", [dense, sparse, around_zero, ends, hot])
@pytest.mark.parametrize("share", [0.0, 0.5, 0.99, 1.0])
def test_lost_rows_are_those_of_plain_sets(spark, keys, share):
    rng = random.Random(f"{keys.__name__} {share}")
    children = [*keys(rng), *keys(rng), None, None]
    parents = [k for k in set(children) if k is not None and rng.random() < share] + [None, 12345678901]
    child, parent = frame(spark, "parent_id", children), frame(spark, "id", parents)
    for keep_null in (False, True):
        value = dangling_count(child, parent, REF, keep_null).first().value
        assert value == lost_rows(children, parents, keep_null)
        assert value == dangling(child, parent, REF, keep_null).count()


def test_nothing_lost_at_the_largest_number(spark):
    child, parent = frame(spark, "parent_id", [MOST, MOST, 1]), frame(spark, "id", [1, MOST])
    assert dangling_count(child, parent, REF).first().value == 0


def test_empty_sides_and_nulls_alone(spark):
    none, some = [], [1, 2, 2, None]
    for children, parents in ((none, some), (some, none), (none, none), ([None, None], some), (some, [None])):
        for keep_null in (False, True):
            counted = dangling_count(frame(spark, "parent_id", children), frame(spark, "id", parents), REF, keep_null)
            assert counted.first().value == lost_rows(children, parents, keep_null)


@pytest.mark.parametrize("kinds", [("int", "long"), ("long", "int"), ("short", "byte"), ("string", "string"), ("decimal(20,0)", "decimal(20,0)")])
def test_other_types(spark, kinds):
    make = {"string": str}.get(kinds[0], int)
    if kinds[0].startswith("decimal"):
        from decimal import Decimal as make
    children, parents = [make(k) for k in (1, 2, 2, 100, 120)] + [None], [make(k) for k in (1, 100, 5)]
    child, parent = frame(spark, "parent_id", children, kinds[0]), frame(spark, "id", parents, kinds[1])
    assert dangling_count(child, parent, REF).first().value == 3
    assert dangling_count(child, parent, REF, keep_null=True).first().value == 4


def test_other_columns_with_clashing_names(spark):
    child = spark.createDataFrame([(1, "a", 1, 1), (9, "b", 2, 2)], "parent_id long, word string, bits int, n int")
    parent = spark.createDataFrame([(1, "x", 5)], "id long, held string, key int")
    assert dangling_count(child, parent, REF).first().value == 1


def test_a_word_is_a_run_of_64_numbers(spark):
    words = {r.word: r.bits for r in key_words(frame(spark, "id", [0, 1, 1, 63, 64, -1, None]), "id").collect()}
    assert words == {0: 1 | 2 | -(2**63), 1: 1, -1: -(2**63)}
    lost = missing_words(frame(spark, "parent_id", [0, 1, 70, -1]), frame(spark, "id", [1, -1]), REF).collect()
    assert {(r.word, r.lost) for r in lost} == {(0, 1), (1, 1 << 6)}


def shuffled_rows(spark, counted):
    """Rows that a plan's exchanges took in, once it has run; an exchange used again counts once."""
    counted.collect()
    plan = counted._jdf.queryExecution().executedPlan()
    seen = {}

    def visit(node):
        name = node.nodeName()
        if name == "Exchange":
            seen[node.id()] = node.metrics().apply("shuffleRecordsWritten").value()
        inner = node.executedPlan() if name == "AdaptiveSparkPlan" else node.plan() if "QueryStage" in name else None
        if inner is not None:
            visit(inner)
        if name != "ReusedExchange":
            for part in (node.children(), node.subqueries()):
                for n in range(part.size()):
                    visit(part.apply(n))

    visit(plan)
    return sum(seen.values())


def test_dense_numbers_shuffle_a_row_for_64_of_them(spark, tmp_path):
    for name, column, copies in (("child", "parent_id", 3), ("parent", "id", 1)):
        rows = spark.range(0, 64_000 * copies, 1, 2).select((F.col("id") / copies).cast("long").alias(column))
        rows.write.parquet(str(tmp_path / name))
    child, parent = (spark.read.parquet(str(tmp_path / n)) for n in ("child", "parent"))
    # Two tables of 1000 words, one of which two tasks may share.
    assert 1900 < shuffled_rows(spark, missing_words(child, parent, REF)) < 2100
    # References themselves are shuffled from the first lost word on only.
    assert shuffled_rows(spark, dangling_count(child, parent, REF)) < 10
    # One lost at the end: the words again, and few references.
    assert 1900 < shuffled_rows(spark, dangling_count(child, parent.where("id <> 63990"), REF)) < 2300
    assert dangling_count(child, parent, REF).first().value == 0
    assert dangling_count(child, parent.where("id <> 5"), REF).first().value == 3


def test_sides_stored_in_buckets_of_the_reference_are_not_regrouped(spark):
    def stored(column, keys, buckets):
        return frame(spark, column, keys).select(F.col(column).alias(column, metadata={BUCKETS: buckets}))

    def text(child, parent):
        return dangling_count(child, parent, REF)._jdf.queryExecution().optimizedPlan().toString()

    assert "bit_or" not in text(stored("parent_id", [1, 2], 4), stored("id", [1], 4))
    assert "bit_or" in text(stored("parent_id", [1, 2], 4), stored("id", [1], 5))
    assert "bit_or" in text(frame(spark, "parent_id", [1, 2]), stored("id", [1], 4))
    assert dangling_count(stored("parent_id", [1, 2], 4), stored("id", [1], 4), REF).first().value == 1
