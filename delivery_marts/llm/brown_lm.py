"""Brown class-based bigram model: P(word | before) = P(class | class before) * P(word | class).

1. Words of the training texts are counted over all of them.
2. Exchange clustering. The ``EXCHANGED`` most frequent words start from their frequency rank. In a
   round, every word's neighbours are counted by class in tables of fixed size, and the words that
   gain by it move to the class that makes their neighbours likeliest. The likelihood of the class
   bigrams is taken from the next counts: if it fell, the moves are taken back and only the half of
   them that gained most is made, then a quarter; so it never falls. The exchange has converged
   when a round gains less than ``LEAST_GAIN`` a token, or no part of its moves gains anything.
   Every other word that occurs more than once then moves once, from no class to the one that makes
   its neighbours likeliest. Its neighbours are counted by class within tasks, at most two cells a
   class and word, and summed by word in Spark; what reaches the driver are the classes of the
   ``BROADCAST`` most frequent words, which are at hand in every task. Those of all others stay
   distributed and are joined by word. Words that occur once, or not in training, take the class
   that frequent words with their ending have.
3. Class transitions are counted over all training texts and smoothed towards class frequencies.
   In a class, a word seen n times has (n - d) of the class's N tokens; the d taken from each of its
   words goes to one unknown word, which stands for all words not seen in training. So the
   chances of the V known words and the unknown one add up to 1 after every class.
4. Texts are scored: the ``BROADCAST`` most frequent words have their classes and counts at hand in
   every task, so hot words are never shuffled; those of the rest are joined by word, once, and kept
   beside the text, which is then counted and scored without another join.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, and one end after each text. The history of
a text's first token is a start of its own.

Defined results: NULL and empty texts are an end alone; rows that repeat a doc_id are texts of
their own; without any training text every word is unknown with chance 1; an empty table gives an
empty one; columns other than doc_id and text are not used. Whole texts are read. The two sizes
bound tables that are broadcast or collected, in words and, as none of more than ``LONGEST`` bytes
is among them, in bytes; no word is left out of counts, classes or scores.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delivery_marts.llm.shared import folder, written
from delivery_marts.session import delete_folder

CLASSES = 32
EXCHANGED = 1 << 14
BROADCAST = 1 << 18
LONGEST = 64  # bytes of a word that may be at hand in every task
LEAST_GAIN = 5e-3  # nats a token
SMALLEST_PART = 1 / 4  # of the moves of a round
WEIGHT = 1 << 20  # steps of a unit in whole logarithms
SMOOTHING = 20.0  # tokens that class frequencies weigh in a transition
END = b"\n"  # no word has it
MARKS = b".,;:!?|\"')("
ENDINGS = (3, 2, 1)
FLUSH_WORDS = 1 << 18  # distinct words a counting task holds
FLUSH_TOKENS = 1 << 21  # tokens an exchange task holds
GATHERED = 1 << 23  # bytes of texts that are looked up at once
CELL = 16  # bits of a cell's number
COUNT_STEPS = 16  # steps per doubling in the histogram of counts

RARE = -1


def tokens(text: str | None) -> list[bytes]:
    return [*(text or "").encode("utf-8", "surrogatepass").lower().split(), END]


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """What ``tokens`` gives for texts, one after another and without the ends, and how many of each text."""
    # The ASCII functions work on bytes, and split at \x20 and \x09-\x0D.
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words = parts.flatten().cast(pa.binary())
    there = pc.greater(pc.binary_length(words), 0)
    counts = np.bincount(pc.list_parent_indices(parts).filter(there).to_numpy(), minlength=len(parts))
    return words.filter(there), counts


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of up to ``GATHERED`` bytes, or as they came if they are larger."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if held and size + batch.nbytes > GATHERED:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield pa.concat_batches(held)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def summed(parts: list[tuple[pa.Array, np.ndarray]]) -> tuple[pa.Array, np.ndarray]:
        coded = pa.concat_arrays([words for words, _ in parts]).dictionary_encode()
        n = np.bincount(coded.indices.to_numpy(), np.concatenate([n for _, n in parts]), len(coded.dictionary))
        return coded.dictionary, n.astype(np.int64)

    def rows(parts: list[tuple[pa.Array, np.ndarray]]) -> pa.RecordBatch:
        words, n = summed(parts) if len(parts) > 1 else parts[0]
        return pa.record_batch([words, pa.array(n)], names=["word", "n"])

    parts: list[tuple[pa.Array, np.ndarray]] = []
    texts = 0
    for batch in _gathered(batches):
        texts += len(batch)
        found = _words(batch["text"])[0].value_counts()
        parts.append((found.field("values"), found.field("counts").to_numpy()))
        if sum(len(words) for words, _ in parts) > FLUSH_WORDS:
            parts = [summed(parts)]
            if len(parts[0][0]) > FLUSH_WORDS:
                yield rows(parts)
                parts = []
    if texts:
        parts.append((pa.array([END], pa.binary()), np.array([texts])))
        yield rows(parts)


def count_words(texts: DataFrame) -> DataFrame:
    """word (binary) and n over all texts."""
    return texts.mapInArrow(_count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass(frozen=True, eq=False)
class Frequent(Sequence):
    """Words and counts as columns, as the driver holds many; one by one they are pairs."""

    words: pa.Array
    counts: np.ndarray

    def __len__(self) -> int:
        return len(self.words)

    def __getitem__(self, place: int | slice) -> Frequent | tuple[bytes, int]:
        if isinstance(place, slice):
            return Frequent(self.words[place], self.counts[place])
        return self.words[place].as_py(), int(self.counts[place])


def _frequent(vocabulary: DataFrame, most: int) -> Frequent:
    """The most frequent words and counts, at most ``most``, by falling count; none of more than
    ``LONGEST`` bytes.

    A histogram of counts in steps (about a thousand rows, whatever the vocabulary) gives the
    lowest count at which there are no more words than that.
    """
    vocabulary = vocabulary.where(F.octet_length("word") <= LONGEST)
    step = F.floor(F.log2("n") * COUNT_STEPS).alias("step")
    histogram = sorted(vocabulary.groupBy(step).count().collect(), reverse=True)
    total, lowest = 0, None
    for row in histogram:
        total += row["count"]
        if total > most:
            break
        lowest = row["step"]
    if lowest is None:
        return Frequent(pa.array([], pa.binary()), np.zeros(0, np.int64))
    found = vocabulary.where(step >= lowest).select("word", "n").toArrow()
    found = found.sort_by([("n", "descending"), ("word", "ascending")]).combine_chunks()
    return Frequent(found["word"].chunk(0), found["n"].to_numpy())


def _blobs(numbers: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The bytes of numbers, cut at ``bounds``."""
    offsets = pa.array(numbers.itemsize * bounds, pa.int32())  # fails where they don't fit
    buffers = [None, offsets.buffers()[1], pa.py_buffer(numbers)]
    return pa.BinaryArray.from_buffers(pa.binary(), len(bounds) - 1, buffers)


def _numbers(blobs: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """What ``_blobs`` was given, the bounds beginning with 0; of at least one blob."""
    _, offsets, data = blobs.buffers()
    bounds = np.frombuffer(offsets, "<i4")[blobs.offset : blobs.offset + len(blobs) + 1]
    numbers = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]].view(kind)
    return numbers, (bounds - bounds[0]) // numbers.itemsize


@lru_cache(maxsize=2)
def _index(words: Broadcast) -> pa.Array:
    return pa.array(words.value, pa.binary())


def encode(docs: DataFrame, held_out: Column, words: Broadcast) -> DataFrame:
    """Texts as ids of frequent words (32-bit, RARE for others) and the others joined by spaces."""

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = _index(words)
        end = pc.fill_null(pc.index_in(pa.array([END], pa.binary()), frequent), RARE)[0].as_py()
        for batch in _gathered(batches):
            found, lengths = _words(batch["text"])
            codes = pc.index_in(found, frequent)
            bounds = np.concatenate(([0], np.cumsum(lengths + 1)))
            place = np.full(bounds[-1], len(found))  # in found, or of the end after it
            inside = np.ones(len(place), bool)
            inside[bounds[1:] - 1] = False
            place[inside] = np.arange(len(found))
            ids = np.full(len(place), end, "<i4")
            ids[inside] = pc.fill_null(codes, RARE).to_numpy()
            rare = ids == RARE
            others = pa.concat_arrays([found, pa.array([END], pa.binary())]).take(pa.array(place[rare]))
            left = np.concatenate(([0], np.cumsum(rare)))[bounds]
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(left, pa.int32()), others), b" ")
            yield pa.record_batch(
                [batch["doc_id"], batch["held_out"], _blobs(ids, bounds), joined],
                names=["doc_id", "held_out", "ids", "rare"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out.alias("held_out"), "text")
    return rows.mapInArrow(coded, "doc_id long, held_out boolean, ids binary, rare binary")


def _bare(words: pa.Array) -> pa.Array:
    """Words without the marks at their end; those of marks alone as they are."""
    bare = pc.ascii_rtrim(words.view(pa.string()), MARKS.decode()).cast(pa.binary())
    return pc.if_else(pc.greater(pc.binary_length(bare), 0), bare, words)


@dataclass
class Classes:
    """The class of every word: a table for frequent words, endings for the others."""

    count: int
    of_frequent: np.ndarray
    of_ending: dict[bytes, int] = field(default_factory=dict)
    cache: dict[bytes, int] = field(default_factory=dict)
    rare: DataFrame | None = None  # word, class and n of all other words that occur more than once; stays on the driver

    def __getstate__(self) -> dict:
        return self.__dict__ | {"rare": None, "cache": {}}

    def of_word(self, word: bytes) -> int:
        """The class by its ending of a word that is neither frequent nor in ``rare``."""
        found = self.cache.get(word)
        if found is None:
            bare = word.rstrip(MARKS) or word
            found = next((self.of_ending[bare[-n:]] for n in ENDINGS if bare[-n:] in self.of_ending), 0)
            if len(self.cache) >= 1 << 18:
                self.cache.clear()
            self.cache[word] = found
        return found

    def of_words(self, words: pa.Array) -> np.ndarray:
        """What ``of_word`` gives for every word."""
        coded = pc.binary_slice(_bare(words), -max(ENDINGS)).dictionary_encode()
        found = [self.of_word(ending) for ending in coded.dictionary.to_pylist()]
        return np.array(found, np.int64)[coded.indices.to_numpy()]


def _stream(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a batch's texts one after another, and where texts begin."""
    blobs = batch["ids"]
    if not len(blobs):
        return np.zeros(0, "<i4"), np.zeros(0, bool)
    ids, bounds = _numbers(blobs, "<i4")
    first = np.zeros(len(ids), bool)
    first[bounds[:-1]] = True
    return ids, first


def _rare(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray]:
    """Rare words of a batch's texts one after another, and the text of each."""
    parts = pc.split_pattern(pc.fill_null(batch["rare"], b""), b" ")
    words = parts.flatten()
    there = pc.greater(pc.binary_length(words), 0)
    return words.filter(there), pc.list_parent_indices(parts).filter(there).to_numpy()


def _histories(ids: np.ndarray, first: np.ndarray, classes: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Class of every token, RARE being the last entry of ``classes``, and of its history."""
    own = classes[ids]
    history = np.roll(own, 1)
    history[first] = count + 1
    return own, history


def _neighbours(encoded: DataFrame, classes: np.ndarray, words: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """How often each exchanged word follows each history, and precedes each class.

    Histories are the classes, then words without a class, then the start of a text. No word beyond
    the exchanged ones has a class.
    """
    before, after = count + 2, count + 1
    width = before + after
    kind = "id int, cells binary"
    classes = np.append(classes[:words], count).astype(np.int32)  # as are the cells, of which there are few

    def rows(total: np.ndarray) -> pa.RecordBatch:
        total = total.reshape(words, width)
        seen = np.flatnonzero(total.any(axis=1))
        cells = _blobs(total[seen], width * np.arange(len(seen) + 1))
        return pa.record_batch([pa.array(seen, pa.int32()), cells], names=["id", "cells"])

    def add(total: np.ndarray, batch: pa.RecordBatch) -> None:
        if len(batch):
            cells = _numbers(batch["cells"], "<i8")[0].reshape(len(batch), width)
            for word, own in zip(batch["id"].to_pylist(), cells, strict=True):
                total[word] += own

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, waiting, held = np.zeros(words * width, np.int64), [], 0
        for batch in batches:
            ids, first = _stream(batch)
            if not len(ids):
                continue
            ids = np.minimum(ids.view("<u4"), np.uint32(words)).view("<i4")  # RARE is the largest
            own, history = _histories(ids, first, classes, count)
            known = ids < words
            waiting.append(ids[known] * width + history[known])
            follows = known[:-1] & ~first[1:]
            waiting.append(ids[:-1][follows] * width + before + own[1:][follows])
            held += len(ids)
            if held >= FLUSH_TOKENS:
                total += np.bincount(np.concatenate(waiting), minlength=len(total))
                waiting, held = [], 0
        if waiting:
            total += np.bincount(np.concatenate(waiting), minlength=len(total))
        yield rows(total)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((words, width), np.int64)
        for batch in batches:
            add(total, batch)
        yield rows(total)

    found = encoded.select("ids").mapInArrow(cells, kind).repartition("id").mapInArrow(summed, kind)
    total = np.zeros((words, width))
    for batch in found.toArrow().to_batches():  # as many rows as the exchange has words
        add(total, batch)
    return total[:, :before], total[:, before:]


def _information(pairs: np.ndarray) -> float:
    """Mutual information of a class and its history, in nats a token: what the log likelihood of
    the class bigrams is beyond that of the words alone, which no exchange changes."""
    total = pairs.sum()
    share = pairs / max(total, 1)
    alone = share.sum(axis=1, keepdims=True) * share.sum(axis=0, keepdims=True)
    seen = share > 0
    return float((share[seen] * np.log(share[seen] / alone[seen])).sum())


def exchange(encoded: DataFrame, count: int, words: int, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """Classes of the ``words`` most frequent words, the weight of every cell of a neighbour for
    every class, and the information after each round that was kept."""
    best: tuple[float, np.ndarray, np.ndarray, np.ndarray] | None = None
    kept: list[float] = []
    part = 1.0
    while True:
        left, right = _neighbours(encoded, classes, words, count)
        mine = np.zeros((words, count))
        mine[np.arange(words), classes[:words]] = 1
        into, out = left.T @ mine, mine.T @ right  # history to class, class to next class
        information = _information(into)
        gain = information - best[0] if best else math.inf
        if gain > 0:
            enter = np.log((into + 0.5) / (into.sum(axis=0) + 0.5 * len(into)))
            leave = np.log((out + 0.5) / (out.sum(axis=1, keepdims=True) + 0.5 * out.shape[1]))
            scores = left @ enter + right @ leave.T
            to = scores.argmax(axis=1)
            gains = scores.max(axis=1) - scores[np.arange(words), classes[:words]]
            best = (information, classes, to, gains)
            kept.append(information)
            weights = np.vstack((enter, leave.T))
            part = 1.0
            if gain < LEAST_GAIN:
                return classes, weights, kept
        else:
            part /= 2
        movers = np.flatnonzero(best[3] > 0)
        if part < SMALLEST_PART or not len(movers):
            return best[1], weights, kept
        movers = movers[np.argsort(-best[3][movers], kind="stable")][: max(1, math.ceil(part * len(movers)))]
        classes = best[1].copy()
        classes[movers] = best[2][movers]


def _beside(encoded: DataFrame, classes: np.ndarray, words: int, count: int) -> DataFrame:
    """id (-1 for rare words), word and cells: how often the words beyond the exchanged ones have
    neighbours of a class, summed within tasks to a row a word. A cell has its number in the last
    ``CELL`` bits and how often it was seen in the others."""
    before = count + 2
    width = before + count + 1
    frequent = len(classes) - 1

    def rows(parts: list[tuple[np.ndarray, np.ndarray]], rare: list[pa.Array]) -> pa.RecordBatch:
        ids, first = (np.concatenate(column) for column in zip(*parts, strict=True))
        coded = pa.concat_arrays(rare).dictionary_encode()
        names = pa.concat_arrays([pa.array([b""], pa.binary()), coded.dictionary])
        own, history = _histories(ids, first, classes, count)
        here = ids.astype(np.int64)
        here[ids == RARE] = frequent + coded.indices.to_numpy()
        sought = here >= words
        follows = sought[:-1] & ~first[1:]
        keys = (here[sought] * width + history[sought], here[:-1][follows] * width + before + own[1:][follows])
        found, n = np.unique(np.concatenate(keys), return_counts=True)
        word, cell = np.divmod(found, width)
        begins = np.flatnonzero(np.diff(word, prepend=-1))
        word = word[begins]
        cells = pa.ListArray.from_arrays(pa.array(np.append(begins, len(cell)), pa.int32()), pa.array(n << CELL | cell))
        named = names.take(pa.array(np.maximum(word - frequent + 1, 0)))
        number = pa.array(np.where(word < frequent, word, RARE).astype(np.int32))
        return pa.record_batch([number, named, cells], names=["id", "word", "cells"])

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, rare, held = [], [], 0
        for batch in batches:
            parts.append(_stream(batch))
            rare.append(_rare(batch)[0])
            held += len(parts[-1][0])
            if held >= FLUSH_TOKENS:
                yield rows(parts, rare)
                parts, rare, held = [], [], 0
        if held:
            yield rows(parts, rare)

    return encoded.select("ids", "rare").mapInArrow(cells, "id int, word binary, cells array<long>")


def cluster(encoded: DataFrame, frequent: int, count: int, words: int) -> tuple[np.ndarray, DataFrame | None]:
    """Classes of the frequent words, with ``count`` for RARE at the end, and word, class and n of the
    rare words that occur more than once."""
    words = min(words, frequent)
    classes = np.full(frequent + 1, count, np.int64)
    classes[:words] = np.arange(words) % count
    if not words:
        return classes, None
    classes, weights, _ = exchange(encoded, count, words, classes)
    # Whole numbers, so that sums do not depend on the order of their parts.
    whole = np.rint(weights * WEIGHT).astype(int)
    cell = F.col("cell")
    sums = [F.sum(F.col("n") * F.get(F.array(*map(F.lit, whole[:, k].tolist())), cell)) for k in range(count)]
    beside = _beside(encoded, classes, words, count).repartition("id", "word")
    number = cell.bitwiseAND((1 << CELL) - 1).cast("int")
    each = beside.select("id", "word", F.explode("cells").alias("cell"))
    each = each.select("id", "word", number.alias("cell"), F.shiftright("cell", CELL).alias("n"))
    scored = each.groupBy("id", "word").agg(
        F.array(*sums).alias("scores"), F.sum(F.when(cell < count + 2, F.col("n")).otherwise(0)).alias("seen")
    )
    best = (F.array_position("scores", F.array_max("scores")) - 1).cast("int").alias("class")
    chosen = written(scored.where("id >= 0 OR seen > 1").select("id", "word", best, "seen"), "brown-classes")
    table = chosen.where("id >= 0").select("id", "class").toArrow()
    classes[table["id"].to_numpy()] = table["class"].to_numpy()
    return classes, chosen.where("id < 0").select("word", "class", F.col("seen").alias("n"))


def by_ending(vocabulary: DataFrame, frequent: Frequent, rare: DataFrame | None) -> DataFrame:
    """word and n of the words that are neither frequent nor in ``rare``, the classes of the others."""
    if rare is None:  # there was no exchange, for want of frequent words
        return vocabulary.select("word", "n")
    once = F.col("n") == 1
    if frequent[-1][1] == 1:  # of the words that occur once, the short ones are frequent all or none
        once &= F.octet_length("word") > LONGEST
    return vocabulary.where(once).select("word", "n")


def with_known(encoded: DataFrame, known: DataFrame) -> DataFrame:
    """``known``: word, class and n of the rare words in a text that occur in training."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, text = _rare(batch)
            coded = found.dictionary_encode()
            size = max(1, len(coded.dictionary))
            text, word = np.divmod(np.unique(text.astype(np.int64) * size + coded.indices.to_numpy()), size)
            yield pa.record_batch(
                [batch["row"].take(pa.array(text)), coded.dictionary.take(pa.array(word))], names=["row", "word"]
            )

    found = encoded.select("row", "rare").mapInArrow(words, "row long, word binary").join(known, "word")
    gathered = found.groupBy("row").agg(F.collect_list(F.struct("word", "class", "n")).alias("known"))
    return encoded.join(gathered, "row", "left")


def _classed(batch: pa.RecordBatch, classes: Classes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids of a batch's texts one after another, where texts begin, the class of every token, and
    how often the rare ones occur in training."""
    ids, first = _stream(batch)
    own = classes.of_frequent[ids]
    words, _ = _rare(batch)
    if not len(words):
        return ids, first, own, np.zeros(0, np.int64)
    coded = words.dictionary_encode()
    known = batch["known"].flatten()
    word, of, n = known.flatten()
    place = pc.index_in(coded.dictionary, word)
    of, n = pc.fill_null(of.take(place), RARE).to_numpy().astype(np.int64), pc.fill_null(n.take(place), 0).to_numpy()
    rest = of == RARE
    of[rest] = classes.of_words(coded.dictionary.filter(pa.array(rest)))
    own[ids == RARE] = of[coded.indices.to_numpy()]
    return ids, first, own, n[coded.indices.to_numpy()]


def classify(frequent: Frequent, exchanged: np.ndarray, count: int) -> Classes:
    """Classes for all words, from those of the words that have one."""
    own = exchanged[: len(frequent)]
    clustered = own < count
    bare = _bare(frequent.words.filter(pa.array(clustered)))
    endings = pa.concat_arrays([pc.binary_slice(bare, -length) for length in ENDINGS]).dictionary_encode()
    # A word's endings one after another, so that votes are summed in the order of the words.
    ending = endings.indices.to_numpy().astype(np.int64).reshape(len(ENDINGS), -1).T
    cells, vote = np.unique(ending * count + own[clustered, None], return_inverse=True)
    votes = np.bincount(vote.ravel(), np.repeat(np.sqrt(frequent.counts[clustered]), len(ENDINGS)), len(cells))
    ending, kind = np.divmod(cells, count)
    order = np.lexsort((kind, -votes, ending))
    best = order[np.flatnonzero(np.diff(ending[order], prepend=-1))]
    classes = Classes(count, np.zeros(0, np.int32), dict(zip(endings.dictionary.to_pylist(), kind[best].tolist(), strict=True)))
    known = np.append(own, 0).astype(np.int32)
    known[:-1][~clustered] = classes.of_words(frequent.words.filter(pa.array(~clustered)))
    classes.of_frequent = known
    classes.cache = {}
    return classes


@dataclass
class Model:
    classes: Classes
    counts: np.ndarray  # of frequent words
    tokens: int
    vocabulary: int
    discount: float
    transitions: np.ndarray  # log10 P(class | history), histories are classes and the start
    sizes: np.ndarray  # log10 of a class's tokens
    unknown: np.ndarray  # log10 P(unknown word | history)


def _matrix(rows: DataFrame, size: int) -> np.ndarray:
    """Rows (cell, n) of tasks, summed; as many cells as classes times classes."""
    table = rows.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(size)
    total[table["cell"].to_numpy()] = table["n"].to_numpy()
    return total


def train(
    encoded: DataFrame, vocabulary: DataFrame, frequent: Frequent, classes: Classes
) -> Model:
    """The model of the training texts in ``encoded``, with the classes of their rare words."""
    count = classes.count
    stats = vocabulary.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)), F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
    ).first()
    total, known, once, twice = stats
    discount = min(0.95, max(0.05, once / max(1, once + 2 * twice)))

    def transitions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((count + 1) * count, np.int64)
        for batch in batches:
            _, first, own, _ = _classed(batch, classes)
            history = np.roll(own, 1)
            history[first] = count
            seen += np.bincount(history * count + own, minlength=len(seen))
        yield pa.record_batch([pa.array(np.arange(len(seen))), pa.array(seen)], names=["cell", "n"])

    def types(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(count, np.int64)
        for batch in batches:
            own = batch["class"].to_numpy()
            seen += np.bincount(own[own < count], minlength=count)
            seen += np.bincount(classes.of_words(batch["word"].filter(pa.array(own == count))), minlength=count)
        yield pa.record_batch([pa.array(np.arange(count)), pa.array(seen)], names=["cell", "n"])

    cells = "cell long, n long"
    pairs = _matrix(encoded.select("ids", "rare", "known").mapInArrow(transitions, cells), (count + 1) * count)
    pairs = pairs.reshape(count + 1, count)
    words = np.bincount(classes.of_frequent[:-1], minlength=count).astype(float)
    if known > len(frequent):
        named = by_ending(vocabulary, frequent, classes.rare).select("word", F.lit(count).alias("class"))
        if classes.rare is not None:
            named = named.unionByName(classes.rare.select("word", "class"))
        words += _matrix(named.mapInArrow(types, cells), count)
    size = pairs.sum(axis=0)
    overall = (size + 1) / (size.sum() + count)
    chance = (pairs + SMOOTHING * overall) / (pairs.sum(axis=1, keepdims=True) + SMOOTHING)
    # A class without tokens gives all its chance to the unknown word.
    spare = np.where(size > 0, discount * words / np.maximum(size, 1), 1.0)
    return Model(
        classes,
        frequent.counts,
        total,
        known,
        discount,
        np.log10(chance),
        np.log10(np.maximum(size, 1)),
        np.log10(chance @ spare),
    )


def _scored(encoded: DataFrame, model: Broadcast) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, base_score and score of every text."""

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        counts = np.append(m.counts, 0)
        chances = m.transitions - m.sizes
        for batch in batches:
            if not len(batch):
                continue
            ids, first, own, seen = _classed(batch, m.classes)
            n = counts[ids]
            n[ids == RARE] = seen
            history = np.roll(own, 1)
            history[first] = m.classes.count
            known = n > 0
            chance = m.unknown[history]
            chance[known] = chances[history[known], own[known]] + np.log10(n[known] - m.discount)
            base = np.log10((n + 1) / (m.tokens + m.vocabulary + 1))
            begins = np.flatnonzero(first)
            sums = (np.add.reduceat(x, begins) for x in (known.astype(np.int64), base, chance))
            found = (np.diff(begins, append=len(ids)), *sums)
            yield pa.record_batch(
                [batch["doc_id"], batch["held_out"], *map(pa.array, found)],
                names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
            )

    return encoded.select("doc_id", "held_out", "ids", "rare", "known").mapInArrow(
        scores, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    )


def class_bigram_scores(docs: DataFrame, held_out: Column, count: int = CLASSES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every text.

    ``base_score`` is that of single words with one added to every count.
    """
    spark = docs.sparkSession
    held_out = F.coalesce(held_out, F.lit(False))
    vocabulary = written(count_words(docs.where(~held_out).select("text")), "brown-vocabulary")
    frequent = _frequent(vocabulary, BROADCAST)
    words = spark.sparkContext.broadcast(frequent.words)

    coded = encode(docs, held_out, words).withColumn("row", F.monotonically_increasing_id())
    path = folder(spark, "brown-encoded")
    coded.write.option("compression", "zstd").parquet(path)
    encoded = spark.read.schema(coded.schema).parquet(path)
    exchanged, rare = cluster(encoded.where("NOT held_out"), len(frequent), count, EXCHANGED)
    classes = classify(frequent, exchanged, count)
    classes.rare = rare
    once = by_ending(vocabulary, frequent, rare).select("word", F.lit(None).cast("int").alias("class"), "n")
    named = with_known(encoded, once if rare is None else once.unionByName(rare))
    again = folder(spark, "brown-named")
    named.write.option("compression", "zstd").parquet(again)
    encoded = spark.read.schema(named.schema).parquet(again)
    delete_folder(spark, path)
    model = train(encoded.where("NOT held_out"), vocabulary, frequent, classes)
    total = F.lit(model.tokens).cast("bigint").alias("train_tokens")
    return _scored(encoded, spark.sparkContext.broadcast(model)).select(
        "doc_id", "held_out", "n_tokens", "n_known", total, "base_score", "score"
    )
