import math

import numpy as np
from pyspark.sql import functions as F

from delivery_marts.llm import topk

SCHEMA = "vec_id long, embedding array<float>, rank string, score string, row string, shard string, ints string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, *["taken"] * 5) for i, v in vectors], SCHEMA)


def whole(vector):
    return None if vector is None else [math.floor(64 * float(np.float32(x))) for x in vector]


def plain(vectors, step, k):
    usable = [(i, whole(v)) for i, v in vectors if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for query_id, q in usable:
        if query_id % step:
            continue
        near = [(-sum(a * b for a, b in zip(q, v)), i) for i, v in usable if i != query_id and len(v) == len(q)]
        out += [(query_id, n + 1, i, -s) for n, (s, i) in enumerate(sorted(near)[:k])]
    return sorted(out)


def answers(spark, vectors, step=10, k=20):
    return sorted(tuple(r) for r in topk.exact_top_k(frame(spark, vectors), F.col("vec_id") % step == 0, k, 64).collect())


def points(rng, n, dim, spread=1.0):
    return [[float(x) for x in np.float32(p)] for p in rng.standard_normal((n, dim)) * spread]


def test_shards_give_what_all_pairs_give(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 100)
    rng = np.random.default_rng(1)
    vectors = list(enumerate(points(rng, 700, 12))) + [(1000 + i, p) for i, p in enumerate(points(rng, 90, 5))]
    assert answers(spark, vectors) == plain(vectors, 10, 20)


def test_sparse_vectors_with_many_ties(spark, monkeypatch):
    monkeypatch.setattr(topk, "LEAST_ROWS", 50)
    rng = np.random.default_rng(2)
    vectors = [(i, [float(x) for x in (rng.random(30) < 0.1) * rng.integers(-2, 3, 30) / 64]) for i in range(600)]
    assert answers(spark, vectors) == plain(vectors, 10, 20)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [(0, [1.0, 0.0]), (7, [1.0, 1.0]), (3, [1.0, 5.0]), (9, [-1.0, 0.0]), (4, [1.0, 1.0]), (4, [1.0, 1.0])]
    vectors += [(20, None), (40, [0.0, 0.0]), (60, [nan, 1.0]), (11, [inf, 1.0]), (12, [None, 1.0]), (13, []), (80, [])]
    vectors += [(14, [1.0]), (None, [1.0, 0.0]), (100, [3.0]), (5, [0.001, -0.001])]
    assert answers(spark, vectors, 20) == plain(vectors, 20, 20)
    assert answers(spark, vectors, 20, 2) == plain(vectors, 20, 2)
    assert answers(spark, []) == []
    large = answers(spark, [(0, [1e30, 1.0]), (1, [1e30, 0.0]), (2, [-1e30, 0.0])])
    assert [r[2:] for r in large] == [(1, 1 << 48), (2, -(1 << 48))]


def test_every_copy_of_a_query_gets_all_its_neighbours(spark):
    vectors = list(enumerate(points(np.random.default_rng(3), 60, 8)))
    alone = answers(spark, vectors, 100)
    assert answers(spark, [vectors[0], vectors[0], *vectors], 100) == sorted(alone * 3) and len(alone) == 20


def test_only_competitive_vectors_are_probed():
    """Few strong terms: most vectors are never looked at beyond the essential postings."""
    rng = np.random.default_rng(4)
    vectors = np.zeros((5000, 40), np.int32)
    for row in vectors:
        row[rng.choice(40, 4, replace=False)] = rng.integers(1, 50, 4)
    shard = topk.Shard(np.arange(5000), vectors)
    query = np.zeros(40, np.int64)
    query[:6] = (100, 90, 80, 1, 1, 1)
    ids, scores = shard.search(query, -1, 20)
    want = sorted(((-int(s), i) for i, s in enumerate(vectors.astype(np.int64) @ query)))[:20]
    assert [(-int(s), int(i)) for i, s in zip(ids, scores)] == want
    touched = {d for d, _ in shard._postings}
    assert touched <= {0, 1, 2}
