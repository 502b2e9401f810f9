import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from delivery_marts.llm import queries, sharding
from tests.llm.conftest import SF_DIR


def test_shards_follow_weights_and_growth_moves_rows_only_into_the_new_shard(spark):
    tree = {"a": {"x": {0: 1.0, 1: 3.0}}, "b": {"y": {2: 4.0}, "z": {3: 0.0, 4: 8.0}}}
    keys = spark.range(40_000).withColumnRenamed("id", "doc_id")
    placed = sharding.with_shard(keys, "doc_id", tree)
    counts = Counter({r.shard: r["count"] for r in placed.groupBy("shard").count().collect()})
    assert counts[3] == 0
    for shard, weight in {0: 1, 1: 3, 2: 4, 4: 8}.items():
        assert counts[shard] == pytest.approx(40_000 * weight / 16, rel=0.1)
    grown = sharding.with_shard(placed.withColumnRenamed("shard", "old"), "doc_id", sharding.grown_tree(tree, 9, 4.0))
    moved = grown.where("shard <> old").select("shard").distinct().collect()
    assert [r.shard for r in moved] == [9]
    assert grown.where("shard = 9").count() == pytest.approx(40_000 * 4 / 20, rel=0.1)


def test_changed_weight_moves_nothing_inside_other_subtrees(spark):
    before = {"a": {"x": {0: 1.0, 1: 1.0}}, "b": {"y": {2: 1.0, 3: 1.0}}}
    after = {"a": {"x": {0: 1.0, 1: 1.0}}, "b": {"y": {2: 1.0, 3: 2.0}}}
    keys = spark.range(20_000).withColumnRenamed("id", "doc_id")
    old = sharding.with_shard(keys, "doc_id", before).select("doc_id", F.col("shard").alias("old"))
    both = old.join(sharding.with_shard(keys, "doc_id", after), "doc_id")
    moves = {(r.old, r.shard) for r in both.where("old <> shard").select("old", "shard").distinct().collect()}
    assert moves and not [m for m in moves if m[1] in (0, 1)]


def test_query_against_plain_values(spark, texts):
    rows = queries.op6_sharding(spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    slots = {}
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "key")
        assert r.grown_shard in (r.shard, 8)
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(slots) == set(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_odd_rows(spark, odd):
    placed = sharding.with_slot(sharding.with_shard(odd, "doc_id", sharding.even_tree(4)), ["doc_id"])
    rows = placed.collect()
    assert len(rows) == odd.count()
    assert len({r.shard for r in rows if r.doc_id == 9}) == 1
    for shard in {r.shard for r in rows}:
        mine = [r.slot for r in rows if r.shard == shard]
        assert sorted(mine) == list(range(len(mine)))


def test_written_shards_hold_their_rows_in_slot_order(spark, tmp_path):
    keys = spark.range(500).withColumnRenamed("id", "doc_id")
    placed = sharding.with_slot(sharding.with_shard(keys, "doc_id", sharding.even_tree(4)), ["doc_id"])
    sharding.write_shards(placed, str(tmp_path / "shards"))
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "shards")).select("doc_id", "shard", "slot").collect())) == sorted(
        map(tuple, placed.select("doc_id", "shard", "slot").collect())
    )
