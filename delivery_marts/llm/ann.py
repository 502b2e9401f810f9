"""Approximate nearest neighbours by collision-counting hashing.

Largest inner products are turned into smallest distances: a vector x is scaled by the longest
length and gets one more component that makes all of one length; a query is scaled to length one
and gets a zero. Then m random projections are taken, and each is kept as a sorted array.

A query opens a window around its own projection in every array, counts how often each vector
falls into the m windows, and verifies, by the exact inner product, the vectors that collide in
at least ``threshold`` of them. Windows then grow by a factor (virtual rehashing: the same arrays
serve every radius) and only the new ends of each window are counted. The search ends when a
vector at the distance of the k-th best found so far would have reached the threshold with the
stated confidence, or when the windows cover everything.

Rows are numbered and dealt to blocks of vectors by a hash of the number. A block builds its arrays
once, and its queries follow it in the same partition, in Arrow batches; a block has a fixed number
of rows, so memory does not grow with the table. Every vector is shuffled once, every query once per
block. Only where there are fewer blocks than cores are the queries parted, and the blocks copied to
at most ``COPIES`` parts; answers do not depend on that. The k best of all blocks are the answer.

Defined results: vectors that are NULL, empty, zero or hold NULL or non-finite components, and
rows without vec_id, take no part; vectors of another dimension than the query's are no
candidates; rows with the query's vec_id are not its neighbours; query rows that repeat a vec_id each get k
neighbours of their own, ranked from 1; ties go to the smaller vec_id;
fewer candidates than k give all; an empty table gives an empty one. Other columns are not used.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delivery_marts.llm.shared import bucket, written
from delivery_marts.llm.topk import rows_of
from delivery_marts.llm.vectors import usable_rows

BLOCK_ROWS = 32_768
BLOCK_QUERIES = 256  # of a part, about, where a block has several
COPIES = 8  # of a block, at most
FOUND = "query_row long, query_id long, vec_id long, score double"
SCHEMA = pa.schema(
    [("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]
)


@dataclass(frozen=True)
class Search:
    k: int = 20
    projections: int = 32
    threshold: int = 16  # collisions that make a candidate
    confidence: float = 0.9  # that the k-th neighbour reaches the threshold before the end
    first_window: float = 0.6  # half width
    growth: float = 1.15
    seed: int = 7

    def width_per_distance(self) -> float:
        """Half width of windows, per distance, at which a vector reaches the threshold with
        the confidence asked for. One collision has probability 2 * Phi(width / distance) - 1."""

        def reached(ratio: float) -> float:
            p, m = 2 * NormalDist().cdf(ratio) - 1, self.projections
            return sum(math.comb(m, i) * p**i * (1 - p) ** (m - i) for i in range(self.threshold, m + 1))

        low, high = 0.0, 10.0
        for _ in range(50):
            middle = (low + high) / 2
            low, high = (low, middle) if reached(middle) >= self.confidence else (middle, high)
        return high


class Index:
    """Sorted projections of one block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, longest: float, search: Search):
        self.ids, self.vectors, self.longest, self.search = ids, vectors, longest, search
        dim = vectors.shape[1]
        self.directions = np.random.default_rng(search.seed).standard_normal((dim + 1, search.projections))
        scaled = vectors / longest
        rest = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", scaled, scaled)))
        places = scaled @ self.directions[:dim] + rest[:, None] * self.directions[dim]
        self.order = np.ascontiguousarray(np.argsort(places, axis=0, kind="stable").T)
        self.sorted = np.take_along_axis(places.T, self.order, axis=1)
        self.ratio = search.width_per_distance()
        self.rough = vectors.astype(np.float32)

    def _verified(self, candidates: np.ndarray, query: np.ndarray, least: float, slack: float) -> tuple[np.ndarray, np.ndarray]:
        """Candidates that can be among the k best, with exact products.

        All are measured in single precision first, and those that even with ``slack``, far above
        the error of that, fall behind the k-th or behind ``least`` are left out.
        """
        rough = np.take(self.rough, candidates, axis=0) @ query.astype(np.float32)
        if len(rough) > self.search.k:
            least = max(least, float(np.partition(rough, -self.search.k)[-self.search.k]))
        close = candidates[rough >= least - slack]
        return close, self.vectors[close] @ query

    def nearest(self, query_id: int, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids and inner products of the nearest found, best first."""
        s, count = self.search, len(self.ids)
        length = math.sqrt(float(query @ query))
        slack = 1e-4 * length * self.longest
        at = (query / length) @ self.directions[:-1]
        reach = max(float((at - self.sorted[:, 0]).max()), float((self.sorted[:, -1] - at).max()))
        hits = np.zeros(count, np.int64)
        done = self.ids == query_id  # never its own neighbour
        found, scores = np.zeros(0, np.int64), np.zeros(0)
        low = high = None
        width = s.first_window
        while True:
            new_low = [int(np.searchsorted(a, x - width)) for a, x in zip(self.sorted, at, strict=True)]
            new_high = [int(np.searchsorted(a, x + width, "right")) for a, x in zip(self.sorted, at, strict=True)]
            if low is None:
                ends = [o[a:b] for o, a, b in zip(self.order, new_low, new_high, strict=True)]
            else:
                ends = [o[a:b] for o, a, b in zip(self.order, new_low, low, strict=True)]
                ends += [o[a:b] for o, a, b in zip(self.order, high, new_high, strict=True)]
            low, high = new_low, new_high
            hits += np.bincount(np.concatenate(ends), minlength=count)
            candidates = np.flatnonzero((hits >= s.threshold) & ~done)
            done[candidates] = True
            least = float(scores.min()) if len(found) >= s.k else -math.inf
            close, products = self._verified(candidates, query, least, slack)
            found, scores = np.concatenate((found, close)), np.concatenate((scores, products))
            if len(found) > s.k:
                best = np.lexsort((self.ids[found], -scores))[: s.k]
                found, scores = found[best], scores[best]
            if width >= reach:
                break
            if len(found) >= s.k:
                worst = float(scores.min()) / (length * self.longest)
                if width >= self.ratio * math.sqrt(max(0.0, 2.0 - 2.0 * worst)):
                    break
            width *= s.growth
        best = np.lexsort((self.ids[found], -scores))
        return self.ids[found[best]], scores[best]


def _answers(batches: Iterator[pa.RecordBatch], longest: float, search: Search) -> Iterator[pa.RecordBatch]:
    """Every query of a part against its block: the block's vectors come first, then the queries."""
    at, ids, vectors, index = None, [], [], None
    for batch in batches:
        keys = np.stack([batch[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("dim", "place", "is_query")], axis=1)
        changes = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for start, end in zip([0, *changes], [*changes, len(keys)], strict=True):
            if start == end:
                continue
            dim, place, is_query = keys[start].tolist()
            if at != (dim, place):
                at, ids, vectors, index = (dim, place), [], [], None
            part = batch.slice(start, end - start)
            numbers, values = part["vec_id"].to_numpy(), rows_of(part["embedding"]).astype(np.float64)
            if not is_query:
                ids.append(numbers)
                vectors.append(values)
                continue
            if index is None and ids:
                index = Index(np.concatenate(ids), np.concatenate(vectors), longest, search)
                ids, vectors = [], []
            if index is None:
                continue
            found = []
            for row, query_id, query in zip(part["row"].to_numpy(), numbers, values, strict=True):
                near, scores = index.nearest(int(query_id), query)
                found.append((np.full(len(near), row), np.full(len(near), query_id), near, scores))
            yield pa.record_batch([np.concatenate(c) for c in zip(*found, strict=True)], schema=SCHEMA)


def nearest(embeddings: DataFrame, is_query: Column, search: Search | None = None) -> DataFrame:
    """query_id, rank (from 1), vec_id, score for the rows for which ``is_query`` holds."""
    search = search or Search()
    rows = usable_rows(embeddings).withColumn("is_query", F.coalesce(is_query, F.lit(False)))
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "ann-rows")
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda total, x: total + x * x))
    known = rows.agg(
        F.max(norm).alias("longest"), F.count(F.lit(1)).alias("rows"), F.count_if("is_query").alias("queries")
    ).first()
    longest = known["longest"] or 1.0
    blocks = max(1, math.ceil(known["rows"] / BLOCK_ROWS))
    cores = embeddings.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(COPIES, math.ceil(cores / blocks), math.ceil(known["queries"] / BLOCK_QUERIES)))

    def each(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    vectors = rows.withColumns({"is_query": F.lit(False), "block": bucket(blocks, "row"), "part": each(parts)})
    queries = rows.where("is_query").withColumns({"part": bucket(parts, "row"), "block": each(blocks)})
    together = (
        vectors.unionByName(queries)
        .withColumn("place", F.col("block") * parts + F.col("part"))
        .select("dim", "place", "is_query", "row", "vec_id", "embedding")
        .repartitionById(blocks * parts, "place")
        .sortWithinPartitions("dim", "place", "is_query")
    )

    def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _answers(batches, longest, search)

    found = together.mapInArrow(answers, FOUND)
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= search.k)
    return ranked.select("query_id", "rank", "vec_id", "score")
