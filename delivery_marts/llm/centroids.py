"""Centroid clustering of integer vectors with a vantage-point tree over the centroids.

A vector's components become integers, ``floor(scale * x)``. Centroids start as the vectors with the
smallest SHA-256 of ``seed:id``. Every round assigns each vector to the nearest centroid (squared
Euclidean distance, ties to the smaller number) and puts in place of every centroid that has vectors
the floor of their mean, by component; then vectors are assigned once more.

Each round builds a vantage-point tree over the centroids on the driver and sends it with the tasks:
a node holds one centroid, and the others halved by their distance from it, each half with the least
and the largest such distance. A vector searches the tree best first: of the nodes it may still
visit it takes the one with the smallest lower bound, measures its centroid, and opens the halves
with the bounds that the triangle inequality gives. It ends when the smallest bound is beyond the
best distance; a bound equal to it is followed, as a tie may have a smaller number. Bounds are in
floating point and are lowered by more than their error, distances are exact integers. The vectors
of an Arrow batch search side by side, every one with its own queue and its own end.

A round sums vectors per cluster and dimension in each task, then over tasks, and brings centroids
times dimensions numbers to the driver; vectors are written once as integers and read in every
round. The tree holds ``k`` centroids, whatever the number of vectors.

Defined results: vectors that are NULL, of another length, or hold NULL or non-finite components
take no part; rows without an id take part and start as centroids only after all others; rows that
repeat an id count each, the smaller vector first where they start as centroids; fewer vectors than
``k`` give as many centroids; components beyond plus or minus 2^26 after scaling count as that, so
that distances fit a long; an empty table gives an empty one. Other columns are not used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delivery_marts.llm.shared import written
from delivery_marts.llm.topk import rows_of

LIMIT = 1 << 26
ASSIGNED = "vec_id long, cluster int, distance long"


@dataclass(frozen=True)
class Node:
    """A centroid, and for both halves of the others: node (or -1), least and largest distance."""

    centroid: int
    halves: tuple[tuple[int, float, float], ...]


class Tree:
    """A vantage-point tree over centroids; the root is node 0."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.nodes: list[Node | None] = []
        self._grow(list(range(len(centroids))))
        # The same as arrays: per node its centroid, and per half the node, least and largest.
        self.centroid = np.array([n.centroid for n in self.nodes])
        self.half = np.array([[h[0] for h in n.halves] for n in self.nodes])
        self.low = np.array([[h[1] for h in n.halves] for n in self.nodes])
        self.high = np.array([[h[2] for h in n.halves] for n in self.nodes])

    def _grow(self, members: list[int]) -> int:
        if not members:
            return -1
        number = len(self.nodes)
        self.nodes.append(None)
        vantage, others = members[0], members[1:]
        away = {m: float(np.sqrt(float(((self.centroids[m] - self.centroids[vantage]) ** 2).sum()))) for m in others}
        others.sort(key=lambda m: (away[m], m))
        middle = (len(others) + 1) // 2
        halves = []
        for half in (others[:middle], others[middle:]):
            ends = (away[half[0]], away[half[-1]]) if half else (0.0, 0.0)
            halves.append((self._grow(half), *ends))
        self.nodes[number] = Node(vantage, tuple(halves))
        return number

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and squared distance of each vector's nearest centroid, and how many distances
        were measured in all."""
        count = len(vectors)
        best = np.full(count, np.iinfo(np.int64).max)
        number = np.zeros(count, np.int64)
        # A vector's queue: the lower bound of every node it may visit, infinite for all others.
        queue = np.full((count, len(self.nodes)), np.inf)
        queue[:, 0] = 0.0
        active, measured = np.arange(count), 0
        while len(active):
            node = queue[active].argmin(axis=1)
            bound = queue[active, node]
            radius = np.sqrt(best[active].astype(float))
            open_ = bound <= radius  # inclusive: a tie may have a smaller number
            active, node = active[open_], node[open_]
            if not len(active):
                break
            queue[active, node] = np.inf
            centroid = self.centroid[node]
            apart = vectors[active] - self.centroids[centroid]
            distance = np.einsum("ij,ij->i", apart, apart)
            measured += len(active)
            nearer = (distance < best[active]) | ((distance == best[active]) & (centroid < number[active]))
            best[active[nearer]], number[active[nearer]] = distance[nearer], centroid[nearer]
            away = np.sqrt(distance.astype(float))
            for side in (0, 1):
                child = self.half[node, side]
                there = child >= 0
                lower = np.maximum(away - self.high[node, side], self.low[node, side] - away)
                lower = np.maximum(lower - 1e-9 * (1 + away), 0.0)
                queue[active[there], child[there]] = lower[there]
            active = active[np.isfinite(queue[active]).any(axis=1)]
        return number, best, measured


def integer_vectors(embeddings: DataFrame, length: int, scale: int) -> DataFrame:
    """vec_id and ints of the rows that take part."""
    vector = F.col("embedding")
    usable = (F.size(vector) == length) & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    limit = F.lit(float(LIMIT))
    ints = F.transform(vector, lambda x: F.floor(F.greatest(-limit, F.least(limit, x.cast("double") * scale))).cast("int"))
    return embeddings.where(F.coalesce(usable, F.lit(False))).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), ints.alias("ints")
    )


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest hash of seed and id, in ascending order; k rows at most."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(key.alias("key"), "ints").orderBy(F.asc_nulls_last("key"), "ints").limit(k).collect()
    return np.array([row.ints for row in rows], np.int64)


def _summed(vectors: DataFrame, tree: Tree) -> DataFrame:
    """cluster, place, total: sums of components per cluster; place -1 counts the vectors."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, length = tree.centroids.shape
        totals = np.zeros((k, length + 1), np.int64)
        for batch in batches:
            if batch.num_rows:
                ints = rows_of(batch["ints"]).astype(np.int64)
                cluster, _, _ = tree.nearest(ints)
                np.add.at(totals, (cluster, slice(0, length)), ints)
                totals[:, length] += np.bincount(cluster, minlength=k)
        clusters, places = np.divmod(np.arange(k * (length + 1)), length + 1)
        yield pa.record_batch(
            [pa.array(clusters.astype(np.int32)), pa.array(places.astype(np.int32)), pa.array(totals.ravel())],
            names=["cluster", "place", "total"],
        )

    tasks = vectors.select("ints").mapInArrow(sums, "cluster int, place int, total long")
    return tasks.groupBy("cluster", "place").agg(F.sum("total").alias("total"))


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round: floors of the means, those without vectors as they were."""
    k, length = centroids.shape
    totals = [[0] * (length + 1) for _ in range(k)]
    for row in _summed(vectors, Tree(centroids)).collect():  # k times length numbers
        totals[row.cluster][row.place] = row.total
    return np.array(
        [[x // t[length] for x in t[:length]] if t[length] else old for t, old in zip(totals, centroids.tolist(), strict=True)],
        np.int64,
    )


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster and squared distance of every vector."""
    tree = Tree(centroids)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cluster, distance, _ = tree.nearest(rows_of(batch["ints"]).astype(np.int64))
                yield pa.record_batch(
                    [batch["vec_id"], pa.array(cluster.astype(np.int32)), pa.array(distance)],
                    names=["vec_id", "cluster", "distance"],
                )

    return vectors.mapInArrow(nearest, ASSIGNED)


def clusters(
    embeddings: DataFrame, k: int, rounds: int, length: int, scale: int, seed: int
) -> tuple[DataFrame, np.ndarray]:
    """vec_id, cluster, distance of every vector that takes part, and the final centroids."""
    vectors = written(integer_vectors(embeddings, length, scale), "centroid-vectors")
    centroids = first_centroids(vectors, k, seed)
    if not len(centroids):
        return embeddings.sparkSession.createDataFrame([], ASSIGNED), centroids
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    return written(assigned(vectors, centroids), "centroid-clusters"), centroids


def digest(centroid: np.ndarray) -> str:
    """SHA-256 of the components as decimal integers joined by commas."""
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()
