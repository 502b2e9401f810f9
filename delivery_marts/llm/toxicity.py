"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

1. Lexicon. Labelled rows, ``LABELLED`` at most, give, for every word and every word beginning of
   3 to 8 letters, how many toxic and clean documents have it. All that are likelier in toxic
   documents by more than chance explains (log-likelihood ratio above the logarithm of the number
   of candidates) are kept, each with its strength, the logarithm of how much likelier; but a
   beginning goes where a longer one has the same counts. The strongest feature of a word is the
   word's strength.
2. Votes. Every document gets features and votes (toxic, clean, none) in one pass over its whole
   text. A lexicon voter votes toxic on a text that has one of its features; features are dealt to
   voters by rank, words apart from beginnings. Pattern voters look at the strongest word, at the
   strongest passage of ``WINDOW`` words, at shouting and at exclamation marks. No voter and no
   feature divides by the length of the text: clean text around an insult does not acquit it.
3. Label model. Two classes; each voter has a chance of each vote in each class. Expectation
   maximisation over the votes of all documents estimates those chances, and the correlation of
   every two voters within a class; a voter's evidence is divided by one plus the correlations it
   has with others, so that ten voters that say the same count once. Vote patterns are grouped and
   stay distributed; a round moves only a table of voters by voters to the driver.
4. Classifier. A logistic regression on the features (lexicon entries that a text has, steps of the
   strongest word and of the strongest passage) is fitted to the posteriors of all documents, as
   distinct rows with weights, by Spark's own distributed trainer, and scores every document.

Gold labels are used for the lexicon and, as one more voter that mostly abstains and whose accuracy
is given, in the label model; only from rows that the caller gives as training labels. A document
without gold label counts ``UNLABELLED`` of one with it, in the label model and in the classifier:
at full weight, the many weak voters would make the two classes something else than toxic and
clean. Language, source and ids are never inputs.

Defined results: NULL and empty texts have no hits and get the clean score; labels that are NULL
are ignored; a document labelled twice counts twice, equal texts count once for the lexicon; rows
that repeat a labelled doc_id each have its label; without any toxic or any clean label, or without
a lexicon, every score is 0; an empty table gives an empty one; columns other than doc_id and text
are not used. Whole texts are read; ``LABELLED`` bounds the labelled rows, nothing else is cut.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delivery_marts.llm.shared import written

LABELLED = 250_000  # most labelled rows in the sample, taken in the order of a hash of their id
BEGINNINGS = range(3, 9)
LIKELIER = 3.0  # times, at least
WINDOW = 100  # words of a passage
STRONGEST = (1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 10.0)  # steps of the strongest word
PASSAGE = (2.0, 4.0, 6.0, 8.0, 10.0, 12.0, 16.0, 24.0, 32.0, 48.0)  # and of the strongest passage
VERY_STRONG = 0.75  # of the greatest strength there is
UNLABELLED = 0.1  # weight of a document without label
RIDGE = 0.1
GOLD_ACCURACY = 0.99
PER_VOTER = 40  # features of a lexicon voter
ROUNDS = 12
TOXIC, CLEAN, NONE = 1, 0, 2
ADDED = (T.StructField("features", T.ArrayType(T.IntegerType())), T.StructField("votes", T.StringType()))
WORD = re.compile(r"[^\W\d_]+")
CACHED = 1 << 18  # words whose features a worker remembers; a full cache starts anew


def _features(word: str) -> list[str]:
    """A word, and its beginnings with a mark."""
    return [word, *(f"{word[:n]}*" for n in BEGINNINGS if len(word) > n)]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per feature, in how many toxic and clean texts of this task it is."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for batch in batches:
        for text, toxic in zip(batch["text"], batch["toxic"].to_pylist(), strict=True):
            words = set(WORD.findall((text.as_py() or "").lower()))
            counts[toxic].update({f for word in words for f in _features(word)})
    names = list(counts[0].keys() | counts[1].keys())
    for at in range(0, len(names), 50_000):
        part = names[at : at + 50_000]
        yield pa.record_batch(
            [pa.array(part), pa.array([counts[1][n] for n in part], pa.int64()), pa.array([counts[0][n] for n in part], pa.int64())],
            names=["feature", "toxic", "clean"],
        )


def lexicon(labelled: DataFrame) -> list[tuple[str, float]]:
    """Features and strengths, the best first; ``labelled`` has text and toxic (0 or 1).

    What comes to the driver are significant features, which labels bound, not documents.
    """
    sample = labelled.dropDuplicates(["text", "toxic"])
    totals = sample.agg(F.count_if(F.col("toxic") == 1).alias("t"), F.count_if(F.col("toxic") == 0).alias("c")).first()
    if not totals["t"] or not totals["c"]:
        return []
    t, c = F.lit(float(totals["t"])), F.lit(float(totals["c"]))
    counts = sample.select("text", "toxic").mapInArrow(_counted, "feature string, toxic long, clean long")
    summed = counts.groupBy("feature").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    summed = written(summed, "toxicity-features")
    share = (F.col("a") + F.col("b")) / (t + c)

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.ln(seen / expected)).otherwise(0.0)

    gain = part(F.col("a"), t * share) + part(F.col("b"), c * share)
    times = ((F.col("a") + 0.5) / (t + 1)) / ((F.col("b") + 0.5) / (c + 1))
    chance = math.log(max(2, summed.count()))
    best = summed.where((times > LIKELIER) & (gain > chance)).select("feature", "a", "b", F.ln(times).alias("strength"), gain.alias("gain"))
    rows = sorted(best.collect(), key=lambda r: (-r.gain, r.feature))
    # Counts of a beginning's longer beginnings: equal ones stand for the same documents.
    longer = {(r.feature[:n] + "*", r.a, r.b) for r in rows if r.feature.endswith("*") for n in range(len(r.feature) - 1)}
    return [(r.feature, r.strength) for r in rows if (r.feature, r.a, r.b) not in longer]


def _passage(hits: list[tuple[int, float]]) -> float:
    """The greatest sum of strengths within ``WINDOW`` words; hits are (place, strength), in order."""
    best = total = 0.0
    first = 0
    for place, strength in hits:
        total += strength
        while hits[first][0] <= place - WINDOW:
            total -= hits[first][1]
            first += 1
        best = max(best, total)
    return best


@dataclass(frozen=True)
class Voters:
    """Lexicon and pattern voters over the features of a text."""

    lexicon: tuple[tuple[str, float], ...]

    def groups(self) -> list[list[int]]:
        """Features of each lexicon voter: words apart from beginnings, the best first."""
        kinds = [[i for i, (f, _) in enumerate(self.lexicon) if f.endswith("*") is marked] for marked in (False, True)]
        return [kind[at : at + PER_VOTER] for kind in kinds for at in range(0, len(kind), PER_VOTER)]

    @property
    def count(self) -> int:
        return len(self.groups()) + 5

    @property
    def features(self) -> int:
        return len(self.lexicon) + len(STRONGEST) + len(PASSAGE)


class Reader:
    """What a task needs to read texts: features by name and word, the voter of each feature."""

    def __init__(self, voters: Voters):
        self.lexicon = voters.lexicon
        self.index = {feature: i for i, (feature, _) in enumerate(voters.lexicon)}
        self.voter = {i: number for number, group in enumerate(voters.groups()) for i in group}
        self.voters = len(voters.groups())
        self.very = VERY_STRONG * max((s for _, s in voters.lexicon), default=0.0)
        self.known: dict[str, tuple[float, tuple[int, ...]]] = {}

    def _entry(self, word: str) -> tuple[float, tuple[int, ...]]:
        mine = tuple(self.index[f] for f in _features(word) if f in self.index)
        if len(self.known) >= CACHED:
            self.known.clear()
        entry = self.known[word] = (max((self.lexicon[i][1] for i in mine), default=0.0), mine)
        return entry

    def read(self, text: str | None) -> tuple[list[int], str]:
        """Features that a text has, and the voters' votes on it, a digit each."""
        whole, found, hits = text or "", set(), []
        words = WORD.findall(whole.lower())
        for place, word in enumerate(words):
            strength, mine = self.known.get(word) or self._entry(word)
            if mine:
                found.update(mine)
                hits.append((place, strength))
        strongest = max((strength for _, strength in hits), default=0.0)
        passage = _passage(hits)
        letters = sum(map(len, words))
        votes = [NONE] * self.voters
        for feature in found:
            votes[self.voter[feature]] = TOXIC
        votes += [
            TOXIC if strongest >= self.very else NONE if found else CLEAN,
            TOXIC if passage >= self.very else NONE,
            TOXIC if passage >= 2 * self.very else CLEAN if passage < 1.0 else NONE,
            TOXIC if letters > 20 and sum(map(str.isupper, whole)) > 0.5 * letters else NONE,
            TOXIC if "!!" in whole else NONE,
        ]
        steps = [strongest >= step for step in STRONGEST] + [passage >= step for step in PASSAGE]
        found.update(len(self.lexicon) + i for i, above in enumerate(steps) if above)
        return sorted(found), "".join(map(str, votes))


@lru_cache(maxsize=2)
def _reader(voters: Voters) -> Reader:
    return Reader(voters)


def read(docs: DataFrame, voters: Voters, carried: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the carried columns, ``features`` (indices) and ``votes`` (one digit per voter) of every text."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", *(c for c in carried if c != "text"))
    kept = rows.select("doc_id", *carried).schema.fields
    names = [field.name for field in kept]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _reader(voters)
        for batch in batches:
            pairs = [reader.read(text.as_py()) for text in batch["text"]]
            yield pa.record_batch(
                [
                    *(batch[name] for name in names),
                    pa.array([p[0] for p in pairs], pa.list_(pa.int32())),
                    pa.array([p[1] for p in pairs], pa.string()),
                ],
                names=[*names, "features", "votes"],
            )

    return rows.mapInArrow(scan, T.StructType([*kept, *ADDED]))


@dataclass
class LabelModel:
    """Chances of votes by class, and the weight of each voter's evidence."""

    prior: float
    chances: np.ndarray  # class, voter, vote
    weights: np.ndarray  # voter

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Chance of toxic for rows of votes."""
        voter = np.arange(votes.shape[1])
        evidence = np.log(self.chances[1, voter, votes]) - np.log(self.chances[0, voter, votes])
        return 1 / (1 + np.exp(-np.clip(math.log(self.prior / (1 - self.prior)) + evidence @ self.weights, -30, 30)))


def _parsed(votes: list[str]) -> np.ndarray:
    return np.frombuffer("".join(votes).encode(), np.uint8).reshape(len(votes), -1).astype(np.int64) - ord("0")


def _weights(pairs: np.ndarray, sums: np.ndarray, total: np.ndarray) -> np.ndarray:
    """One over one plus a voter's correlations with others, within classes.

    Per class: ``sums`` of votes as +1 (toxic), -1 (clean) and 0, and of their products in pairs.
    """
    mean = sums / total[:, None]
    joint = pairs / total[:, None, None] - mean[:, :, None] * mean[:, None, :]
    spread = np.sqrt(np.maximum(np.einsum("kii->ki", joint), 1e-9))
    correlation = joint / (spread[:, :, None] * spread[:, None, :])
    share = total / total.sum()
    both = np.clip(np.tensordot(share, correlation, 1), 0, 1)
    np.fill_diagonal(both, 0)
    return 1 / (1 + both.sum(axis=1))


def label_model(patterns: DataFrame, voters: int, prior: float, gold: bool = False) -> LabelModel:
    """Fitted to ``patterns`` (votes, n) by expectation maximisation.

    The start: toxic votes are likelier in toxic documents and clean votes in clean ones. With
    ``gold`` the last voter's votes are labels, whose accuracy is given and not estimated, and
    patterns without one weigh ``UNLABELLED``.
    """
    chances = np.empty((2, voters, 3))
    chances[1], chances[0] = (0.1, 0.6, 0.3), (0.4, 0.05, 0.55)
    labels = np.array([[GOLD_ACCURACY, 1 - GOLD_ACCURACY, 1], [1 - GOLD_ACCURACY, GOLD_ACCURACY, 1]])
    if gold:
        chances[:, -1] = labels
    model = LabelModel(prior, chances, np.full(voters, 1 / math.sqrt(voters)))
    for _ in range(ROUNDS):

        def summed(batches: Iterator[pa.RecordBatch], model: LabelModel = model) -> Iterator[pa.RecordBatch]:
            votes_by_class, pairs = np.zeros((2, voters, 3)), np.zeros((2, voters, voters))
            for batch in batches:
                if not batch.num_rows:
                    continue
                votes = _parsed(batch["votes"].to_pylist())
                toxic = model.posterior(votes)
                n = batch["n"].to_numpy().astype(float)
                if gold:
                    n *= np.where(votes[:, -1] == NONE, UNLABELLED, 1.0)
                signed = (votes == TOXIC).astype(float) - (votes == CLEAN)
                for k, weight in enumerate((n * (1 - toxic), n * toxic)):
                    for vote in (CLEAN, TOXIC, NONE):
                        votes_by_class[k, :, vote] += weight @ (votes == vote)
                    pairs[k] += (signed * weight[:, None]).T @ signed
            row = np.concatenate((votes_by_class.ravel(), pairs.ravel()))
            yield pa.record_batch([pa.array(np.arange(len(row), dtype=np.int32)), pa.array(row)], names=["i", "x"])

        # A few thousand sums, whatever the number of documents.
        total = np.zeros(6 * voters + 2 * voters * voters)
        for row in patterns.mapInArrow(summed, "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).collect():
            total[row.i] = row.x
        by_class = total[: 6 * voters].reshape(2, voters, 3)
        pairs = total[6 * voters :].reshape(2, voters, voters)
        size = by_class[:, 0, :].sum(axis=1) + 1e-6
        chances = (by_class + 0.1) / (size[:, None, None] + 0.3)
        sums = by_class[:, :, TOXIC] - by_class[:, :, CLEAN]
        weights = _weights(pairs, sums, size)
        if gold:
            chances[:, -1], weights[-1] = labels, 1.0
        before, model = model, LabelModel(float(np.clip(size[1] / size.sum(), 1e-4, 0.5)), chances, weights)
        if np.abs(before.chances - model.chances).max() < 1e-4:
            break
    return model


def fit(examples: DataFrame, features: int, ridge: float = RIDGE) -> np.ndarray:
    """Weights of a logistic regression on presence of features, the last one constant.

    ``examples`` has features (indices), weight and target (chance of toxic). A target between 0 and
    1 is a toxic and a clean row that share the weight.
    """
    target = F.col("target")
    halves = F.array(
        F.struct(F.lit(1.0).alias("label"), (F.col("weight") * target).alias("w")),
        F.struct(F.lit(0.0).alias("label"), (F.col("weight") * (1 - target)).alias("w")),
    )
    names = [str(i) for i in range(features)]
    rows = examples.select(F.col("features").cast("array<string>").alias("names"), F.inline(halves)).where("w > 0")
    present = CountVectorizerModel.from_vocabulary(names, inputCol="names", outputCol="x").setBinary(True)
    total = examples.agg(F.sum("weight")).first()[0]
    trainer = LogisticRegression(
        featuresCol="x", labelCol="label", weightCol="w", maxIter=200, tol=1e-9,
        regParam=ridge / total, elasticNetParam=0.0, standardization=False,
    )
    model = trainer.fit(present.transform(rows).select("x", "label", "w"))
    return np.append(model.coefficients.toArray(), model.intercept)


def _examples(scanned: DataFrame, model: LabelModel) -> DataFrame:
    """features, weight and target of distinct rows (features, votes, the label last)."""

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                votes = _parsed(batch["votes"].to_pylist())
                weight = batch["n"].to_numpy() * np.where(votes[:, -1] == NONE, UNLABELLED, 1.0)
                columns = [batch["features"], pa.array(weight), pa.array(model.posterior(votes))]
                yield pa.record_batch(columns, names=["features", "weight", "target"])

    grouped = scanned.groupBy("features", "votes").agg(F.count(F.lit(1)).alias("n"))
    return grouped.mapInArrow(weighed, "features array<int>, weight double, target double")


def toxicity(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, carried: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the carried columns and ``score`` for every row of ``docs``; of ``labels`` (doc_id, toxic), which
    are all meant for training, ``labelled`` at most are used."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", *(c for c in carried if c != "text"))
    gold = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")
    )
    # The sample is bounded, so its ids may be broadcast, and no text is shuffled to meet its label.
    gold = F.broadcast(written(gold.orderBy(F.xxhash64("doc_id"), "toxic").limit(labelled), "toxicity-labels"))
    voters = Voters(tuple(lexicon(docs.select("doc_id", "text").join(gold, "doc_id"))))
    if not voters.lexicon:
        return docs.select("doc_id", *carried, F.lit(0.0).alias("score"))

    scanned = written(read(docs, voters, carried), "toxicity-votes")
    label = F.coalesce(F.col("toxic").cast("string"), F.lit(str(NONE)))
    marked = scanned.select("doc_id", "features", "votes").join(gold, "doc_id", "left")
    marked = marked.select("features", F.concat("votes", label).alias("votes"))
    patterns = written(marked.groupBy("votes").agg(F.count(F.lit(1)).alias("n")), "toxicity-patterns")
    known = gold.agg(F.avg("toxic").alias("toxic")).first()["toxic"]
    model = label_model(patterns, voters.count + 1, float(np.clip(known, 1e-3, 0.5)), gold=True)
    weights = fit(written(_examples(marked, model), "toxicity-examples"), voters.features)

    table = F.lit(weights[:-1])
    logit = F.aggregate("features", F.lit(float(weights[-1])), lambda total, i: total + F.get(table, i))
    return scanned.select("doc_id", *carried, (1 / (1 + F.exp(-logit))).alias("score"))
