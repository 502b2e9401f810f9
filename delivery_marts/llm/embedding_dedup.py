"""Near-duplicate embeddings: random-hyperplane signs, exact cosines, connected components.

Equal vectors are one node with a number of copies. A node's signs against ``bits`` random
hyperplanes are its code in a table; nodes with one code in a table are a bucket and compared in
cells (``cells.py``). Two vectors at cosine c agree in
one sign with probability 1 - acos(c) / pi, so the number of tables follows from the number of
bits and the share of links that may be missed at the threshold itself (links above it are
missed more rarely); bits grow with the logarithm of the rows, so that buckets stay small.

Vectors are not sent to all these cells. A cell first gets a signature of each node, the signs
against ``SIGNATURE`` other hyperplanes, and keeps the nodes that have another at a Hamming distance
that a pair at the threshold exceeds with probability ``MISSED`` / 100. Vectors follow to the cells of
those nodes only, where every pair is compared by its exact cosine in double precision.

A pair that meets in several tables counts in the first of them only, which the rows' signs
tell. Every cell returns, per node, how many links it has and one edge into a forest, so a task
returns no more rows than it was given, whatever the number of links.

Defined results: vectors that are NULL, empty, zero or hold NULL or non-finite components link
with nothing and are components of their own, as are vectors of different dimensions to each
other; rows that repeat a vec_id are vectors of their own, with that id; a NULL vec_id gives a
row without links, component NULL and kept NULL; an empty table gives an empty one. Other
columns are not used.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delivery_marts.llm.cells import with_cells
from delivery_marts.llm.components import components
from delivery_marts.llm.shared import per_key, written
from delivery_marts.llm.simhash import forest
from delivery_marts.llm.vectors import matrix, takes_part, usable_rows

BUCKET_ROWS = 32  # about; sets the number of bits
MISSED = 1e-4  # share of links at the threshold that no table finds
BLOCK = 1024  # rows of a bucket in one part
GROUP_ROWS = 20_000  # rows in a call, about
SIGNATURE = 256  # bits, a multiple of 64
CELL_ROWS = 4096  # signatures in a call, about


def plan(rows: int, threshold: float) -> tuple[int, int]:
    """Bits per table and number of tables."""
    bits = min(30, max(4, round(math.log2(max(2, rows) / BUCKET_ROWS))))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(MISSED) / math.log(1 - agree))


def radius(threshold: float) -> int:
    """Differing bits of two signatures that a pair at the threshold exceeds in one of 100 / MISSED cases."""
    p = math.acos(threshold) / math.pi
    beyond, bits = 1.0, -1
    while beyond > MISSED / 100 and bits < SIGNATURE:
        bits += 1
        beyond -= math.comb(SIGNATURE, bits) * p**bits * (1 - p) ** (SIGNATURE - bits)
    return bits


def _signs(vectors: np.ndarray, bits: int, tables: int, seed: int) -> np.ndarray:
    """The code of each vector in each table."""
    planes = np.random.default_rng([seed, vectors.shape[1]]).standard_normal((vectors.shape[1], tables * bits))
    ones = (vectors @ planes > 0).reshape(len(vectors), tables, bits)
    return ones @ (1 << np.arange(bits, dtype=np.int32))


def _signatures(vectors: np.ndarray, seed: int) -> list[bytes]:
    planes = np.random.default_rng([seed, vectors.shape[1], SIGNATURE]).standard_normal((vectors.shape[1], SIGNATURE))
    return [row.tobytes() for row in np.packbits(vectors @ planes > 0, axis=1)]


def _coded(frames: Iterator[pd.DataFrame], bits: int, tables: int, seed: int) -> Iterator[pd.DataFrame]:
    for frame in frames:
        codes, signatures = np.zeros((len(frame), tables), np.int32), np.empty(len(frame), object)
        dims = frame["dim"].to_numpy()
        for dim in np.unique(dims):
            vectors = matrix(frame["embedding"][dims == dim])
            codes[dims == dim] = _signs(vectors, bits, tables, seed)
            signatures[dims == dim] = _signatures(vectors, seed)
        yield frame.assign(codes=list(codes), signature=signatures)


def _whole_cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows that come cell by cell, in pieces that end where a cell does."""
    held, rows = [], 0
    for frame in frames:
        held.append(frame)
        rows += len(frame)
        if rows < CELL_ROWS:
            continue
        frame = pd.concat(held)
        open_cell = (frame["cell"] == frame["cell"].iloc[-1]).to_numpy()
        held, rows = [frame[open_cell]], int(open_cell.sum())
        if rows < len(frame):
            yield frame[~open_cell]
    if rows:
        yield pd.concat(held)


def _with_company(frames: Iterator[pd.DataFrame], most: int) -> Iterator[pd.DataFrame]:
    """Rows whose signature another of their cell is at most ``most`` bits from."""
    for frame in _whole_cells(frames):
        words = np.frombuffer(b"".join(frame["signature"]), np.uint64).reshape(len(frame), -1)
        cells, side = frame["cell"].to_numpy(), frame["side"].to_numpy()
        starts = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1])))
        kept = np.zeros(len(frame), bool)
        for begin, end in zip(starts, [*starts[1:], len(frame)], strict=True):
            apart = np.zeros((end - begin, end - begin), np.uint16)
            for word in words[begin:end].T:
                apart += np.bitwise_count(word[:, None] ^ word)
            near = apart <= most
            if side[begin]:
                near &= side[begin:end, None] != side[begin:end]
            np.fill_diagonal(near, False)
            kept[begin:end] = near.any(axis=1)
        yield frame.loc[kept, ["node", "tab", "cell", "side"]]


def _compared(group: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links of each row and an edge to its root, cell by cell."""
    group = group.sort_values(["cell", "side", "node"], kind="stable")
    cells, nodes = group["cell"].to_numpy(), group["node"].to_numpy()
    side, copies, table = (group[c].to_numpy() for c in ("side", "copies", "tab"))
    starts = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1])))
    links, roots = np.zeros(len(group), np.int64), np.arange(len(group))
    embeddings, codes = group["embedding"].to_numpy(), group["codes"].to_numpy()
    for begin, end in zip(starts, [*starts[1:], len(group)], strict=True):
        if end - begin < 2:
            continue
        vectors = matrix(embeddings[begin:end])
        vectors /= np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]
        # Rows are in the order of their side, so pairs across the sides are a corner.
        cut = int(np.searchsorted(side[begin:end], 2)) if side[begin] else 0
        if side[begin] and not 0 < cut < end - begin:
            continue
        if cut:
            i, j = np.nonzero(vectors[:cut] @ vectors[cut:].T >= threshold)
            j = j + cut
        else:
            i, j = np.nonzero(np.triu(vectors @ vectors.T >= threshold, 1))
        if not len(i):
            continue
        earlier = np.stack(codes[begin:end])[:, : table[begin]]
        new = np.ones(len(i), bool)
        for code in earlier.T:
            new &= code[i] != code[j]
        i, j = i[new], j[new]
        links[begin:end] += np.bincount(i, copies[begin + j], end - begin).astype(np.int64)
        links[begin:end] += np.bincount(j, copies[begin + i], end - begin).astype(np.int64)
        roots[begin:end] = begin + forest(end - begin, iter([(i, j)]))
    return pd.DataFrame({"a": nodes, "links": links, "b": nodes[roots]})[links > 0]


def near_duplicates(embeddings: DataFrame, threshold: float = 0.95, seed: int = 11) -> DataFrame:
    """vec_id, n_links, component_id and kept, one row per row."""
    spark = embeddings.sparkSession
    rows = usable_rows(embeddings)
    nodes = rows.groupBy("embedding", "dim").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    # Numbers that stay, as they are written; vec_ids may repeat.
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "embedding-nodes")
    bits, tables = plan(nodes.count(), threshold)

    kind = dict(nodes.dtypes)["embedding"]
    coded = nodes.select("embedding", "dim", "node", "copies").mapInPandas(
        lambda frames: _coded(frames, bits, tables, seed),
        f"embedding {kind}, dim int, node long, copies long, codes array<int>, signature binary",
    )
    coded = written(coded, "embedding-codes")
    entries = coded.select("dim", "node", "signature", F.posexplode("codes").alias("tab", "code"))
    celled = with_cells(entries, ["dim", "tab", "code"], ["node"], BLOCK).drop("dim", "code")
    most = radius(threshold)

    def with_company(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _with_company(frames, most)

    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    together = celled.repartition(partitions, "cell").sortWithinPartitions("cell")
    celled = written(together.mapInPandas(with_company, "node long, tab int, cell long, side int"), "embedding-cells")
    groups = max(1, math.ceil(celled.count() / GROUP_ROWS), partitions)

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        return _compared(group, threshold)

    compared = written(
        celled.join(coded.drop("dim", "signature"), "node")
        .withColumn("_group", F.pmod(F.xxhash64("cell"), F.lit(groups)))
        .groupBy("_group")
        .applyInPandas(compare, "a long, links long, b long"),
        "embedding-links",
    )

    found = components(compared.select("a", "b")).select(F.col("node"), "component")
    linked = compared.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    known = (
        nodes.join(linked, "node", "left")
        .join(found, "node", "left")
        .select(
            "embedding", "dim", "first",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component"),
        )
    )
    smallest = per_key(known, ["component"], F.min("first").alias("component_id"))
    known = known.join(smallest, "component").drop("component", "first")
    placed = rows.join(known, ["embedding", "dim"]).select("vec_id", "n_links", "component_id")
    out = embeddings.where(~takes_part()).select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.lit(0).cast("bigint").alias("n_links"),
        F.col("vec_id").cast("bigint").alias("component_id"),
    )
    return placed.unionByName(out).withColumn("kept", F.col("vec_id") == F.col("component_id"))
