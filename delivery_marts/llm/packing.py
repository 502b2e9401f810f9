"""Harmonic packing of token ids into sequences of one capacity.

Piece sizes are the reciprocals of the capacity, floor(C / k) for k up to 64, and below those
every size down to 1. A document is cut greedily: whole sequences first, then the largest size
that fits what remains, and so on. A size is a class, and a class's bins hold a fixed number of
pieces, floor(C / size), which fills them up to less than one piece. So a bin is known from a
piece's number within its class alone, and all classes are numbered independently and in parallel.

What does not fill a last bin of its class (fewer pieces than a bin, at most C ids, per class;
there are under a hundred classes) is packed first-fit by decreasing size. That remainder has a
fixed bound and is the only thing that one task sees whole.

Defined results: a NULL text is empty; every document has at least its end id; rows that repeat
a doc_id are packed each on its own; an empty table gives an empty one. Input columns other than
doc_id and text are not used.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delivery_marts.llm.shared import bucket, written
from delivery_marts.llm.tokens import encoder

CAPACITY = 2048
CLASSES = 64  # reciprocal classes; smaller sizes are classes of their own
NUMBER_BUCKETS = 1024  # per class, in which its pieces are numbered; whole sequences may be most of all

PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"


def sizes(capacity: int = CAPACITY) -> list[int]:
    """Allowed piece sizes, the largest first."""
    reciprocal = {capacity // k for k in range(1, min(CLASSES, capacity) + 1)}
    return sorted(reciprocal | set(range(1, min(reciprocal))), reverse=True)


def cuts(tokens: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of a document's pieces, which add up to its tokens."""
    whole, rest = divmod(tokens, capacity)
    lengths = [capacity] * whole
    for size in sizes(capacity)[1:]:
        count, rest = divmod(rest, size)
        lengths += [size] * count
    return lengths


def cut(docs: DataFrame, tokenizer: str, spaces: bool, end: int, capacity: int = CAPACITY) -> DataFrame:
    """Documents (doc_id, text) as pieces with their ids, little-endian unsigned 32-bit."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer, spaces)
        of: dict[int, list[int]] = {}
        for batch in batches:
            rows: list[tuple] = []
            encoded = words.ids_of(batch["text"].to_pylist(), end)
            for doc_id, short in zip(batch["doc_id"].to_pylist(), encoded, strict=True):
                ids = short.astype("<u4")
                rest = len(ids) % capacity
                lengths = [capacity] * (len(ids) // capacity) + of.setdefault(rest, cuts(rest, capacity))
                start = 0
                for length in lengths:
                    rows.append((doc_id, start, length, len(ids), ids[start : start + length].tobytes()))
                    start += length
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.int64()] * 4 + [pa.binary()]
            yield pa.record_batch(
                [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
                names=["doc_id", "start", "length", "doc_tokens", "ids"],
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(pieces, PIECES)


def first_fit(lengths: Sequence[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each length, in the order given."""
    used = np.zeros(0, np.int64)
    bins, offsets = [], []
    for length in lengths:
        fits = np.flatnonzero(used + length <= capacity)
        if not len(fits):
            used = np.append(used, 0)
            fits = [len(used) - 1]
        bins.append(int(fits[0]))
        offsets.append(int(used[fits[0]]))
        used[fits[0]] += length
    return bins, offsets


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with ``sequence_id``, from 0 without a gap, and ``offset`` inside it.

    ``pieces`` is read more than once, so it should be a table on disk; it needs ``length`` and
    columns that tell its rows apart. All its columns are kept, and rows shuffle once.
    """
    spark = pieces.sparkSession
    keys = [c for c, kind in pieces.dtypes if c != "length" and kind != "binary"]
    spread = pieces.withColumn("_bucket", bucket(NUMBER_BUCKETS, *keys))

    # Both tables below are small whatever the input: classes times buckets, and classes.
    counts = spread.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("length", "_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first"))
    classes = counts.groupBy("length").agg(F.sum("_rows").alias("_pieces"))
    classes = classes.withColumn("_per", F.expr(f"{capacity} div length"))
    classes = classes.withColumn("_bins", F.expr("_pieces div _per"))
    smaller = Window.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    classes = written(
        classes.withColumn("_base", F.coalesce(F.sum("_bins").over(smaller), F.lit(0))), "packing-classes"
    )

    within = Window.partitionBy("length", "_bucket").orderBy(*keys)
    numbered = (
        spread.withColumn("_place", F.row_number().over(within) - 1)
        .join(F.broadcast(first), ["length", "_bucket"])
        .join(F.broadcast(classes.drop("_pieces")), "length")
        .withColumn("_number", F.col("_first") + F.col("_place"))
    )
    numbered = written(
        numbered.select(*pieces.columns, "_number", "_per", "_bins", "_base"), "packing-numbered"
    )
    full = numbered.where("_number < _bins * _per").select(
        *pieces.columns,
        F.expr("_base + _number div _per").alias("sequence_id"),
        F.expr("(_number % _per) * length").alias("offset"),
    )

    # Fewer than _per pieces of each class are left: at most capacity ids per class.
    bins = classes.agg(F.coalesce(F.sum("_bins"), F.lit(0)).alias("_bins")).first()["_bins"]
    left = numbered.where("_number >= _bins * _per").select(*pieces.columns, F.lit(0).alias("_one"), "_number")

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "_number"], ascending=[False, True], kind="stable")
        found, offsets = first_fit(group["length"].tolist(), capacity)
        group["sequence_id"] = [bins + b for b in found]
        group["offset"] = offsets
        return group.drop(columns=["_one", "_number"])

    fields = ", ".join(f"`{c}` {kind}" for c, kind in pieces.dtypes)
    rest = left.groupBy("_one").applyInPandas(fit, f"{fields}, sequence_id long, offset long")
    return full.unionByName(rest)


def sequences(placed: DataFrame) -> DataFrame:
    """The sequences themselves: sequence_id, ids (binary), and where each document's piece lies."""
    piece = F.struct("offset", "ids", "doc_id", "start", "length")
    joined = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(piece)).alias("pieces"))
    return joined.select(
        "sequence_id",
        F.aggregate("pieces", F.lit(b""), lambda all_ids, p: F.concat(all_ids, p["ids"])).alias("ids"),
        F.transform("pieces", lambda p: p.dropFields("ids")).alias("pieces"),
    )
