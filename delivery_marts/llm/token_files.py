"""Token ids as Arrow IPC files of equal-length sequences that can be read in place.

A table is cut by ranges of doc_id, one file per range. A file is a stream of all ids of its
documents, cut into sequences of one length: record batches of two columns, ``ids`` and
``mask``, both fixed-size lists. All batches but the last have the same number of sequences, so
sequence i is row i % rows of batch i // rows, and a memory-mapped reader gets at it without
copying or decoding anything. The last sequence is padded, its mask says how far it is real.
Beside each file lies an index, also an Arrow file: doc_id, start and n_tokens per document.

Tasks write below the shared folder through ``pyarrow.fs`` (local or mounted paths, hdfs, s3,
gs). File names carry the task attempt, and only the files of attempts that Spark committed get
into the manifest, so a lost executor or a repeated task leaves at most an unused file.

Defined results: a NULL text is empty, a NULL doc_id sorts first; a document with no ids of its
own has its end id; rows that repeat a doc_id are documents of their own, side by side; an empty
table gives a manifest without files. Only doc_id and text are used.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from delivery_marts.llm.tokens import encoder

SEQUENCE = 1024  # ids in a sequence
BATCH = 256  # sequences in a record batch
MANIFEST = "part int, file string, index string, docs long, tokens long"
DOCUMENTS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, also where it is written file:/…, as Hadoop does."""
    return fs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if re.match("file:/[^/]", uri) else uri)


def _schema(dtype: str, length: int) -> pa.Schema:
    ids = pa.uint16() if dtype == "<u2" else pa.uint32()
    return pa.schema([("ids", pa.list_(ids, length)), ("mask", pa.list_(pa.bool_(), length))])


class _Writer:
    """Fills sequences and writes a batch whenever enough are full."""

    def __init__(self, sink: pa.NativeFile, dtype: str, length: int, rows: int):
        self.schema, self.length, self.size = _schema(dtype, length), length, length * rows
        self.file, self.dtype = pa.ipc.new_file(sink, self.schema), dtype
        self.waiting: list[np.ndarray] = []
        self.count = self.total = 0

    def add(self, ids: np.ndarray) -> None:
        self.waiting.append(ids)
        self.count += len(ids)
        self.total += len(ids)
        if self.count >= self.size:
            stream = np.concatenate(self.waiting)
            whole = self.count - self.count % self.size
            for at in range(0, whole, self.size):
                self._write(stream[at : at + self.size], self.size)
            self.waiting, self.count = [stream[whole:].copy()], self.count - whole

    def _write(self, ids: np.ndarray, real: int) -> None:
        mask = pa.array(np.arange(len(ids)) < real)
        lists = [
            pa.FixedSizeListArray.from_arrays(values, self.length)
            for values in (pa.array(ids, self.schema.field("ids").type.value_type), mask)
        ]
        self.file.write_batch(pa.record_batch(lists, schema=self.schema))

    def close(self) -> None:
        if self.count:
            padded = np.zeros(-(-self.count // self.length) * self.length, self.dtype)
            padded[: self.count] = np.concatenate(self.waiting)
            self._write(padded, self.count)
        self.file.close()


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, spaces: bool, end: int, length: int = SEQUENCE, rows: int = BATCH
) -> DataFrame:
    """Writes all documents below ``path`` and returns the manifest, one row per file."""
    system, root = _open(path)
    system.create_dir(root, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        context = TaskContext.get()
        name = f"tokens-{context.partitionId():06d}-{context.taskAttemptId()}"
        file, index = f"{path}/{name}.arrow", f"{path}/{name}.index.arrow"
        words = encoder(tokenizer, spaces)
        here, _ = _open(path)
        start, docs = 0, 0
        with here.open_output_stream(f"{root}/{name}.arrow") as out, here.open_output_stream(
            f"{root}/{name}.index.arrow"
        ) as listed:
            tokens = _Writer(out, words.dtype, length, rows)
            documents = pa.ipc.new_file(listed, DOCUMENTS)
            batch: pa.RecordBatch | None = first
            while batch is not None:
                starts, counts = [], []
                for ids in words.ids_of(batch["text"].to_pylist(), end):
                    tokens.add(ids)
                    starts.append(start)
                    counts.append(len(ids))
                    start += len(ids)
                docs += len(counts)
                documents.write_batch(
                    pa.record_batch(
                        [batch["doc_id"], pa.array(starts, pa.int64()), pa.array(counts, pa.int64())],
                        schema=DOCUMENTS,
                    )
                )
                batch = next(batches, None)
            tokens.close()
            documents.close()
        yield pa.record_batch(
            [[context.partitionId()], [file], [index], [docs], [start]],
            schema=pa.schema(
                [("part", pa.int32()), ("file", pa.string()), ("index", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64())]
            ),
        )

    rows_in = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    ordered = rows_in.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id")
    ordered.mapInArrow(write, MANIFEST).write.parquet(f"{path}/manifest")
    return read_manifest(docs.sparkSession, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


class TokenFile:
    """Random access to one file; arrays are views of the mapped file where it is local."""

    def __init__(self, uri: str):
        system, path = _open(uri)
        local = isinstance(system, fs.LocalFileSystem)
        self._file = pa.ipc.open_file(pa.memory_map(path) if local else system.open_input_file(path))
        self.length = self._file.schema.field("ids").type.list_size
        self.batches = self._file.num_record_batches
        self.rows = self._file.get_batch(0).num_rows if self.batches else 0
        self._last: tuple[int, pa.RecordBatch] | None = None

    def _values(self, batch: int, column: int) -> pa.Array:
        # The last batch is held, as documents come in order: a store fetches each batch once.
        if self._last is None or self._last[0] != batch:
            self._last = (batch, self._file.get_batch(batch))
        return self._last[1].column(column).flatten()

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of sequence i."""
        batch, row = divmod(i, self.rows)
        cut = slice(row * self.length, (row + 1) * self.length)
        return self._values(batch, 0).to_numpy()[cut], self._values(batch, 1).to_numpy(zero_copy_only=False)[cut]

    def pieces(self, start: int, count: int) -> Iterator[np.ndarray]:
        """``count`` ids from position ``start`` of the stream, as one view per batch."""
        size = self.rows * self.length
        while count > 0:
            batch, at = divmod(start, size)
            found = self._values(batch, 0).to_numpy()[at : at + count]
            yield found
            start, count = start + len(found), count - len(found)

    def real_tokens(self) -> int:
        return sum(self._values(b, 1).true_count for b in range(self.batches))


def read_documents(index: str) -> Iterator[pa.RecordBatch]:
    system, path = _open(index)
    with system.open_input_file(path) as source:
        file = pa.ipc.open_file(source)
        for i in range(file.num_record_batches):
            yield file.get_batch(i)


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start among all documents, n_tokens, ids_crc32.

    Raises if a mask does not agree with its index. The window is over the list of files.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select("part", "file", "index", "tokens", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for entry in (row for batch in batches for row in batch.to_pylist()):
            tokens = TokenFile(entry["file"])
            if tokens.real_tokens() != entry["tokens"]:
                raise ValueError(f"{entry['file']} has not the ids its manifest names")
            for docs in read_documents(entry["index"]):
                sums = []
                for start, count in zip(docs["start"].to_pylist(), docs["n_tokens"].to_pylist(), strict=True):
                    crc = 0
                    for piece in tokens.pieces(start, count):
                        crc = zlib.crc32(piece.astype("<u4"), crc)
                    sums.append(crc)
                start = pa.array(docs["start"].to_numpy() + entry["base"])
                yield pa.record_batch(
                    [docs["doc_id"], start, docs["n_tokens"], pa.array(sums, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    # The files are read side by side, one task for each.
    spread = placed.repartition(max(1, manifest.count()), "part")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
