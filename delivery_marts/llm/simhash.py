"""SimHash near-duplicates, with fingerprints compared as vertical bit planes.

A text's words (A-Z lower-cased, ``[^\\x20\\x09-\\x0D]+``) give shingles of w words, repeats
included; a bit of its fingerprint is set if it is set in over half of the shingles' XXH64.

Fingerprints within the radius agree on whole bands: 64 bits in b bands differ in at most r of
them, so a pair shares the value of some b - r bands. Each choice of b - r bands is a table, and
rows with the same value there are a bucket; no pair within the radius is missed. Buckets are
compared in cells (``cells.py``). Within a group of cells, the fingerprints are stored as 64 bit
planes, one bit of 64 fingerprints in each word, and compared with the same planes shifted by
one, two, … places: xor gives one differing bit of 64 pairs at a time, a carry-save counter of
two planes counts up to 3, and words in which no pair is left within the radius are given up.

Equal fingerprints are one node, so copies are not compared at all. Links are reduced to a
forest where they are found, so a task returns no more edges than it has rows.

Defined results: a text with fewer words than a shingle is one shingle of all its words; NULL
and wordless texts have fingerprint zero, which links like any other; rows that repeat a doc_id
take part each; a row without doc_id has a fingerprint, but its NULL is never a component's
smallest id unless the component has no other; an empty table gives an empty one. Only doc_id
and text are used.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delivery_marts.llm.cells import with_cells
from delivery_marts.llm.components import components
from delivery_marts.llm.shared import per_key, written

SEED = 42
BITS = 64
BLOCK = 2048  # rows of a bucket in one part
GROUP_ROWS = 100_000  # rows in a call, about


def fingerprint(text: str | None, words_in_shingle: int) -> int:
    """The 64-bit fingerprint as a signed number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    data = b" ".join(words)
    if len(words) <= words_in_shingle:
        hashes = np.array([xxhash.xxh64_intdigest(data, SEED)], "<u8")
    else:
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        first, last = starts[: len(words) - words_in_shingle + 1].tolist(), ends[words_in_shingle - 1 :].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(data[a:b], SEED) for a, b in zip(first, last, strict=True)], "<u8")
    # Bits of all hashes, least significant first; a long text goes in slices.
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 4096):
        part = np.unpackbits(hashes[at : at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += part.sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, words_in_shingle: int, carried: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the carried columns and ``fp``, a signed 64-bit number, for every row."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", *(c for c in carried if c != "text"))
    kept = rows.select("doc_id", *carried).schema.fields
    names = [field.name for field in kept]

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text.as_py(), words_in_shingle) for text in batch["text"]]
            yield pa.record_batch([*(batch[name] for name in names), pa.array(found, pa.int64())], names=[*names, "fp"])

    return rows.mapInArrow(prints, T.StructType([*kept, T.StructField("fp", T.LongType())]))


def bands(count: int) -> list[int]:
    """Masks of 64 bits in ``count`` bands, as signed numbers."""
    edges = [BITS * i // count for i in range(count + 1)]
    masks = [((1 << high) - 1) ^ ((1 << low) - 1) for low, high in zip(edges, edges[1:], strict=False)]
    return [m - (1 << BITS) if m >= 1 << (BITS - 1) else m for m in masks]


def with_tables(rows: DataFrame, radius: int, band_count: int) -> DataFrame:
    """Each fingerprint once per choice of bands it may share: ``tab`` and ``code``."""
    masks = bands(band_count)
    entries: list[Column] = []
    for number, chosen in enumerate(combinations(masks, band_count - radius)):
        mask = 0
        for one in chosen:
            mask |= one
        code = F.col("fp").bitwiseAND(F.lit(mask).cast("bigint"))
        entries.append(F.struct(F.lit(number).alias("tab"), code.alias("code")))
    return rows.withColumn("_entry", F.explode(F.array(*entries))).select("*", "_entry.tab", "_entry.code").drop("_entry")


def _planes(values: np.ndarray) -> np.ndarray:
    """64 bit planes of the values, 64 values to a word, with a word of zeros at the end."""
    words = -(-len(values) // BITS)
    padded = np.zeros((words + 1) * BITS, np.uint64)
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def _shifted(plane: np.ndarray, words: np.ndarray, lag: int) -> np.ndarray:
    """The given words of a plane moved down by ``lag`` places."""
    skip, bits = divmod(lag, BITS)
    last = len(plane) - 1
    low = plane[np.minimum(words + skip, last)] >> np.uint64(bits)
    if not bits:
        return low
    return low | (plane[np.minimum(words + skip + 1, last)] << np.uint64(BITS - bits))


def _above(counts: list[np.ndarray], limit: int) -> np.ndarray:
    """Where the number held in bit planes is above a limit."""
    above = np.zeros_like(counts[0])
    equal = ~above
    for place in reversed(range(len(counts))):
        if limit >> place & 1:
            equal &= counts[place]
        else:
            above |= equal & counts[place]
            equal &= ~counts[place]
    return above


def close_pairs(values: np.ndarray, runs: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of pairs in the same run whose values differ in at most ``radius`` bits.

    ``runs`` rises; equal entries are a run. One yield per lag, in which all runs advance.
    """
    planes = _planes(values)
    ends = np.searchsorted(runs, runs, side="right")
    longest = ends - np.arange(len(runs))
    for lag in range(1, int(longest.max(initial=1))):
        paired = np.flatnonzero(longest > lag)
        words = np.unique(paired >> 6)
        live = np.zeros(len(words) * BITS, bool)
        live[np.searchsorted(words, paired >> 6) * BITS + (paired & 63)] = True
        within = np.packbits(live, bitorder="little").view(np.uint64)
        # Counters as bit planes: the differing bits of a pair so far, modulo 2 ** len(counts),
        # and ``over`` where that has overflowed.
        counts = [np.zeros(len(words), np.uint64) for _ in range(max(1, radius.bit_length()))]
        over = np.zeros(len(words), np.uint64)
        for number in range(0, BITS, 2):
            first, second = (p[words] ^ _shifted(p, words, lag) for p in planes[number : number + 2])
            # Carry-save: three bits of one weight make one of that weight and one of the next.
            half = counts[0] ^ first
            carry = (counts[0] & first) | (half & second)
            counts[0] = half ^ second
            for place in range(1, len(counts)):
                counts[place], carry = counts[place] ^ carry, counts[place] & carry
            over |= carry
            if number & 7 == 6:
                beyond = over | _above(counts, radius)
                within &= ~beyond
                left = within != 0
                if not left.all():
                    words, within, over = words[left], within[left], over[left]
                    counts = [c[left] for c in counts]
                    if not len(words):
                        break
        if len(words):
            near = np.unpackbits(within.view(np.uint8), bitorder="little")
            at = np.flatnonzero(near)
            i = words[at >> 6] * BITS + (at & 63)
            yield i, i + lag


def forest(count: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of ``count`` places the smallest place it is linked to, directly or not."""
    root = np.arange(count)
    for i, j in pairs:
        while True:
            a, b = root[i], root[j]
            apart = a != b
            if not apart.any():
                break
            i, j = i[apart], j[apart]
            low, high = np.minimum(a, b)[apart], np.maximum(a, b)[apart]
            np.minimum.at(root, high, low)
            while not np.array_equal(up := root[root], root):
                root = up
    return root


def _links(group: pd.DataFrame, radius: int) -> pd.DataFrame:
    """Edges (a, b) between fingerprints that are linked in this group's cells."""
    group = group.sort_values(["cell", "fp"], kind="stable")
    values = group["fp"].to_numpy(np.int64)
    root = forest(len(group), close_pairs(values.view(np.uint64), group["cell"].to_numpy(), radius))
    linked = root != np.arange(len(root))
    return pd.DataFrame({"a": values[linked], "b": values[root[linked]]})


def linked_fingerprints(nodes: DataFrame, radius: int, band_count: int) -> DataFrame:
    """Edges (a, b) that connect all fingerprints (``fp``, distinct) within the radius.

    In a cell of two parts, pairs inside a part are compared once more than needed; that costs
    time and changes nothing.
    """
    rows = with_cells(with_tables(nodes, radius, band_count), ["tab", "code"], ["fp"], BLOCK)
    rows = written(rows.select("cell", "fp"), "simhash-cells")
    groups = max(1, -(-rows.count() // GROUP_ROWS), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    grouped = rows.withColumn("_group", F.pmod(F.xxhash64("cell"), F.lit(groups)))

    def links(group: pd.DataFrame) -> pd.DataFrame:
        return _links(group, radius)

    return grouped.groupBy("_group").applyInPandas(links, "a long, b long")


def classes(prints: DataFrame, radius: int, band_count: int = 4) -> DataFrame:
    """Every ``fp`` once, with ``component``, the smallest fingerprint reachable by links, and
    ``component_id``, the smallest doc_id of those.

    Fingerprints without a neighbour need no component; the others get the smallest fingerprint
    of theirs, and the smallest doc_id is taken over that.
    """
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("_first"))
    edges = linked_fingerprints(nodes.select("fp"), radius, band_count)
    found = components(edges).select(F.col("node").alias("fp"), "component")
    placed = nodes.join(found, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    smallest = per_key(placed, ["component"], F.min("_first").alias("component_id"))
    return placed.select("fp", "component").join(smallest, "component").select("fp", "component", "component_id")


def near_duplicates(docs: DataFrame, words_in_shingle: int, radius: int, band_count: int = 4) -> DataFrame:
    """doc_id, ``fp`` and ``component_id``, the smallest doc_id reachable by links."""
    prints = written(fingerprints(docs, words_in_shingle), "simhash-fingerprints")
    placed = classes(prints, radius, band_count).select("fp", "component_id")
    return prints.join(placed, "fp").select("doc_id", "fp", "component_id")
