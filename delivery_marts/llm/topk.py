"""Exact top-k inner products of integer vectors by MaxScore.

A vector's components become integers, ``floor(scale * x)``. A term is a dimension with a sign, and
its postings are the vectors of a shard whose component there has that sign. A query's terms are its
non-zero components, and a term's bound is the most that a component of the same sign can add; a
component of the other sign only takes away.

Per query, terms are ordered by bound. Those with the smallest bounds whose sum stays below the k-th
best score so far are non-essential: a vector in none of the other terms' postings cannot get into
the answer. Only the essential postings are traversed; a vector found there gets its partial score,
and the non-essential terms are probed, the largest bound first, only for vectors whose partial
score plus the bounds still open reaches the k-th best. Scores reached by ties are kept, as ties go
to the smaller id. The first threshold comes from the vectors that have the query's strongest terms.

Vectors are dealt to shards by a hash of a written row number and shuffled once; a shard's queries
follow it in the same partition, in Arrow batches, so a task holds one shard of ``SHARD_ROWS`` and a
batch of queries. A query goes to every shard, as the search is exact. The k best of all shards,
cut to k per shard before the shuffle, are merged by a window per query row.

Defined results: vectors that are NULL or hold NULL or non-finite components, and rows without an
id, take no part; zero and empty ones do, with score 0; vectors of another length than the query's
are no candidates, and neither are rows with the query's id; query rows that repeat an id each get k
neighbours of their own, ranked from 1; ties go to the smaller id; fewer candidates than k give all;
components beyond plus or minus 2^24 after scaling count as that, so that scores of up to 2^14 of
them fit a long; an empty table gives an empty one. Other columns are not used.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delivery_marts.llm.shared import bucket, written

SHARD_ROWS = 131_072
LEAST_ROWS = 4_096  # of a shard, where a small table is dealt to as many shards as there are cores
LIMIT = 1 << 24
FOUND = "query_row long, query_id long, vec_id long, score long"
SCHEMA = pa.schema([(name, pa.int64()) for name in ("query_row", "query_id", "vec_id", "score")])


def whole(embedding: Column | str, scale: int) -> Column:
    """floor(scale * x) of every component, NULL for vectors that take no part."""
    vector = F.col(embedding) if isinstance(embedding, str) else embedding
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    cut = F.transform(
        vector, lambda x: F.floor(F.greatest(F.lit(-float(LIMIT)), F.least(F.lit(float(LIMIT)), x.cast("double") * scale))).cast("int")
    )
    return F.when(finite, cut)


def rows_of(column: pa.ListArray) -> np.ndarray:
    """Vectors of one length as rows of a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


class Shard:
    """Postings of a block of vectors of one length, and each dimension as a column to be probed."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        self.columns = np.ascontiguousarray(vectors[order].T)
        self.above = self.columns.max(axis=1, initial=0).astype(np.int64)
        self.under = -self.columns.min(axis=1, initial=0).astype(np.int64)
        self._postings: dict[tuple[int, bool], np.ndarray] = {}

    def postings(self, dimension: int, positive: bool) -> np.ndarray:
        key = (dimension, positive)
        if key not in self._postings:
            column = self.columns[dimension]
            self._postings[key] = np.flatnonzero(column > 0 if positive else column < 0).astype(np.int32)
        return self._postings[key]

    def search(self, query: np.ndarray, query_id: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """ids and scores of the k best, best first; equal scores by id."""
        terms = np.flatnonzero(query)
        weights = query[terms]
        most = np.abs(weights) * np.where(weights > 0, self.above[terms], self.under[terms])
        order = np.argsort(most, kind="stable")
        terms, weights, most = terms[order], weights[order], most[order]
        loss = np.abs(weights) * np.where(weights > 0, self.under[terms], self.above[terms])
        gained = np.concatenate(([0], np.cumsum(most)))  # the most that the first n terms add
        lost = np.concatenate(([0], np.cumsum(loss)))  # the most that they take away

        own = slice(np.searchsorted(self.ids, query_id), np.searchsorted(self.ids, query_id, "right"))
        least = self._first_least(query, terms, own, k)
        split = max(0, int(np.searchsorted(gained, least, "left")) - 1)
        seen = np.full(len(self.ids), least <= 0)
        partial = np.zeros(len(self.ids), np.int64)
        for d, weight in zip(terms[split:], weights[split:], strict=True):
            seen[self.postings(int(d), bool(weight > 0))] = True
            partial += weight * self.columns[d]
        seen[own] = False
        places = np.flatnonzero(seen)
        partial = partial[places]
        for n in range(split, 0, -1):
            if len(places) > k:
                # What open terms may still take away leaves at least this much to k vectors.
                least = max(least, int(np.partition(partial, -k)[-k]) - int(lost[n]))
            competitive = partial + gained[n] >= least
            places, partial = places[competitive], partial[competitive]
            partial = partial + weights[n - 1] * self.columns[terms[n - 1], places]
        return self._best(places, partial, k)

    def _first_least(self, query: np.ndarray, terms: np.ndarray, own: slice, k: int) -> int:
        """A k-th best score to begin with, of vectors good in the strongest terms; where there are
        no more than those, one that every vector reaches."""
        if len(self.ids) - (own.stop - own.start) <= 4 * k or not len(terms):
            return np.iinfo(np.int64).min
        strongest = terms[-4:]
        rough = query[strongest] @ self.columns[strongest]
        rough[own] = np.iinfo(np.int64).min
        places = np.argpartition(rough, -4 * k)[-4 * k :]
        return int(np.partition(query @ self.columns[:, places], -k)[-k])

    def _best(self, places: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        if len(scores) > k:
            kept = scores >= np.partition(scores, -k)[-k]
            places, scores = places[kept], scores[kept]
        best = np.lexsort((self.ids[places], -scores))[:k]
        return self.ids[places[best]], scores[best]


def _answers(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Shards and their queries, one shard after another: vectors first, then queries."""
    at, ids, vectors, shard = None, [], [], None
    for batch in batches:
        shards, dims, asked = (batch[c].to_numpy(zero_copy_only=False) for c in ("shard", "dim", "is_query"))
        keys = np.stack((dims, shards, asked.astype(np.int64)), axis=1)
        changes = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for start, end in zip([0, *changes], [*changes, len(keys)], strict=True):
            if start == end:
                continue
            part = batch.slice(start, end - start)
            dim, number, is_query = keys[start].tolist()
            if at != (dim, number):
                at, ids, vectors, shard = (dim, number), [], [], None
            numbers = part["id"].to_numpy()
            values = rows_of(part["ints"])
            if not is_query:
                ids.append(numbers)
                vectors.append(values)
                continue
            if shard is None and ids:
                shard = Shard(np.concatenate(ids), np.concatenate(vectors))
                ids, vectors = [], []
            if shard is None:
                continue
            found = []
            for row, query_id, query in zip(part["row"].to_numpy(), numbers, values.astype(np.int64), strict=True):
                near, scores = shard.search(query, int(query_id), k)
                found.append((np.full(len(near), row), np.full(len(near), query_id), near, scores))
            columns = [np.concatenate(c).astype(np.int64) for c in zip(*found, strict=True)]
            yield pa.record_batch([pa.array(c) for c in columns], schema=SCHEMA)


def exact_top_k(embeddings: DataFrame, is_query: Column, k: int, scale: int) -> DataFrame:
    """query_id, rank (from 1), vec_id, score for the rows for which ``is_query`` holds."""
    given = embeddings.select(
        F.col("vec_id").cast("bigint").alias("id"), whole("embedding", scale).alias("ints"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
    )
    usable = given.where(F.col("id").isNotNull() & F.col("ints").isNotNull())
    rows = written(usable.select(F.monotonically_increasing_id().alias("row"), "*", F.size("ints").alias("dim")), "topk-rows")
    count, cores = rows.count(), embeddings.sparkSession.sparkContext.defaultParallelism
    shards = max(1, math.ceil(count / SHARD_ROWS), min(cores, math.ceil(count / LEAST_ROWS)))
    vectors = rows.withColumns({"is_query": F.lit(False), "shard": bucket(shards, "row")})
    queries = rows.where("is_query").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    together = (
        vectors.unionByName(queries.select(vectors.columns))
        .repartition("dim", "shard")
        .sortWithinPartitions("dim", "shard", "is_query")
    )

    def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _answers(batches, k)

    found = together.mapInArrow(answers, FOUND)
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
