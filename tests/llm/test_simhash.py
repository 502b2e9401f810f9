import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from delivery_marts.llm import cells, components, queries, simhash
from tests.llm.conftest import ODD, SF_DIR, documents


def plain_fingerprint(text, width):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(space, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius):
    """Smallest id reachable, by comparing everything with everything."""
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in ids:
        for j in ids:
            if i < j and bin(prints[i] ^ prints[j]).count("1") <= radius:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in ids}


def test_fingerprints_of_odd_texts_also_from_the_engine(spark):
    for _, text in ODD:
        if text is None or len(text) < 20_000:
            assert simhash.fingerprint(text, 3) % (1 << 64) == plain_fingerprint(text, 3)
    one = spark.range(1).select(F.xxhash64(F.lit("a b"))).first()[0]
    assert simhash.fingerprint("A\tb", 3) == one


def test_query_against_brute_force(spark, texts):
    prints = {d: plain_fingerprint(t, 3) for d, t in texts.items()}
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op9_simhash(spark, SF_DIR).collect()}
    want = plain_components(prints, 2)
    assert found == {d: (f"{prints[d]:016x}", want[d]) for d in texts}
    assert any(d != c for d, c in want.items()), "there are copies to be found"


def test_odd_rows(spark, odd):
    rows = simhash.near_duplicates(odd, 3, 2).collect()
    assert len(rows) == len(ODD)
    by_id = {r.doc_id: r.component_id for r in rows if r.doc_id != 9}
    assert by_id[1] == by_id[2] == 1
    assert by_id[3] == by_id[4] == by_id[5] == 3


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 6])
def test_bit_planes_find_exactly_the_close_pairs(radius):
    rng = random.Random(radius)
    runs, values = [], []
    for run, size in enumerate((1, 2, 3, 70, 1, 200, 64, 129)):
        centre = rng.getrandbits(64)
        for _ in range(size):
            flipped = centre
            for _ in range(rng.randrange(5)):
                flipped ^= 1 << rng.randrange(64)
            runs.append(run)
            values.append(flipped)
    values, runs = np.array(values, np.uint64), np.array(runs)
    found = {(int(a), int(b)) for i, j in simhash.close_pairs(values, runs, radius) for a, b in zip(i, j, strict=True)}
    want = {
        (i, j)
        for i in range(len(runs))
        for j in range(i + 1, len(runs))
        if runs[i] == runs[j] and bin(int(values[i] ^ values[j])).count("1") <= radius
    }
    assert found == want and (want or radius == 0)


def test_tables_lose_no_pair(spark):
    """Every pair within the radius shares a code, wherever its bits lie."""
    rng = random.Random(5)
    pairs = []
    for bits in [(0, 1), (63, 62), (15, 16), (0, 63), (31, 32), (5,), *[(rng.randrange(64), rng.randrange(64)) for _ in range(40)]]:
        a = rng.getrandbits(64)
        b = a
        for bit in bits:
            b ^= 1 << bit
        pairs.append(tuple(x - (1 << 64) if x >> 63 else x for x in (a, b)))
    rows = spark.createDataFrame(enumerate(pairs), "pair int, fp struct<a:long,b:long>")
    sides = [simhash.with_tables(rows.select("pair", F.col(f"fp.{s}").alias("fp")), 2, 4).drop("fp") for s in "ab"]
    assert sides[0].join(sides[1], ["pair", "tab", "code"]).select("pair").distinct().count() == len(pairs)


def test_large_buckets_are_split_and_still_compared(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 16)
    monkeypatch.setattr(simhash, "GROUP_ROWS", 50)
    rng = random.Random(1)
    prints = {i: sum(1 << b for b in rng.sample(range(64), 2)) for i in range(150)}
    signed = [(i, f - (1 << 64) if f >> 63 else f) for i, f in prints.items()]
    nodes = spark.createDataFrame(signed, "id long, fp long")
    edges = simhash.linked_fingerprints(nodes.select("fp").distinct(), 2, 4)
    found = components.components(edges)
    roots = {r.node % (1 << 64): r.component for r in found.collect()}
    want = plain_components(prints, 2)
    groups = {}
    for i, c in want.items():
        groups.setdefault(c, set()).add(prints[i])
    for members in groups.values():
        assert len(members) == 1 or len({roots[m] for m in members}) == 1
    big = cells.with_cells(nodes.selectExpr("0 AS k", "fp"), ["k"], ["fp"], 16).groupBy("cell").count()
    assert big.agg(F.max("count")).first()[0] < 60


def test_components_of_chains_stars_and_rings(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 700)] + [(900 + i, 900 + (i + 1) % 7) for i in range(7)]
    edges += [(-5, -4), (-5, -5), (-4, -5)]
    rng.shuffle(edges)
    found = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 161)} | {i: 500 for i in range(500, 700)} | {900 + i: 900 for i in range(7)} | {-5: -5, -4: -5}
    assert found == want


def test_words_are_ascii_words(spark):
    rows = simhash.near_duplicates(documents(spark, (1, "a\x1cb \x85c"), (2, "A\x1cB \x85C"), (3, "a b c")), 3, 0).collect()
    assert {r.doc_id: r.component_id for r in rows} == {1: 1, 2: 1, 3: 3}


EAGER_SPLITS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.files.minPartitionNum": "8",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
}


@pytest.fixture
def eager_splits(spark):
    before = {key: spark.conf.get(key, None) for key in EAGER_SPLITS}
    for key, value in EAGER_SPLITS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def final_plan(df):
    """How many rows, and the plan that adaptive execution ended with."""
    count = len(df.collect())
    return count, df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_a_hot_bucket_is_split_where_it_gets_its_cells(spark, tmp_path, eager_splits):
    rows = spark.range(30_000, numPartitions=8).selectExpr("if(id % 10 < 9, 1, id) AS k", "xxhash64(id) AS fp")
    rows.write.parquet(str(tmp_path / "rows"))
    count, text = final_plan(cells.with_cells(spark.read.parquet(str(tmp_path / "rows")), ["k"], ["fp"], 9_000))
    assert count == 27_000 * 3
    assert "SortMergeJoin(skew=true)" in text


def test_a_hub_is_split_where_its_edges_move(spark, tmp_path, eager_splits):
    edges = spark.range(1, 30_000, numPartitions=8).selectExpr("id * 7 AS a", "if(id % 10 < 9, 0, id) AS b")
    edges.write.parquet(str(tmp_path / "edges"))
    edges = spark.read.parquet(str(tmp_path / "edges"))
    assert "skew=true" in final_plan(components._large_star(edges))[1]
    flipped = edges.selectExpr("100000000 - b AS a", "100000000 - a AS b")
    assert "skew=true" in final_plan(components._small_star(flipped))[1]
