import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from delivery_marts.llm import brown_lm, queries
from tests.llm.conftest import ODD, SF_DIR, documents


def plain_base(texts, held_out):
    counts = Counter(w for d, t in texts for w in brown_lm.tokens(t) if not held_out(d))
    total, known = sum(counts.values()), len(counts)
    return {
        d: (
            len(words := brown_lm.tokens(t)),
            sum(counts[w] > 0 for w in words),
            total,
            sum(math.log10((counts[w] + 1) / (total + known + 1)) for w in words),
        )
        for d, t in texts
    }


def test_query_against_plain_counts_and_better_than_single_words(spark, texts):
    def held_out(doc_id):
        return zlib.crc32(str(doc_id).encode()) % 7 == 2

    rows = {r.doc_id: r for r in queries.op10_brown_lm(spark, SF_DIR).collect()}
    want = plain_base(texts.items(), held_out)
    assert set(rows) == set(texts)
    for doc_id, (n, known, total, base) in want.items():
        r = rows[doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held_out(doc_id), n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
    held = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


@pytest.fixture
def small(monkeypatch):
    """Sizes at which most words are rare and most tasks flush."""
    monkeypatch.setattr(brown_lm, "EXCHANGED", 12)
    monkeypatch.setattr(brown_lm, "BROADCAST", 20)
    monkeypatch.setattr(brown_lm, "FLUSH_WORDS", 5)
    monkeypatch.setattr(brown_lm, "FLUSH_TOKENS", 5)


def two_languages(n=120):
    rng = random.Random(3)
    kinds = [[f"{a}{b}ing" for a in "abcd" for b in "xyz"], [f"{a}{b}heit" for a in "pqrs" for b in "xyz"]]
    return [(i, " ".join(rng.choices(kinds[i % 2], k=30))) for i in range(n)]


@pytest.mark.parametrize("sizes", ["small", "whole"])
def test_scores_are_the_models_and_its_chances_add_up_to_one(spark, sizes, request, monkeypatch):
    if sizes == "small":
        request.getfixturevalue("small")
    seen = {}
    train = brown_lm.train
    monkeypatch.setattr(brown_lm, "train", lambda *a: seen.setdefault("model", train(*a)))
    texts = [*two_languages(), (500, "axing new words aXing"), (501, None), (502, "")]
    rows = brown_lm.class_bigram_scores(documents(spark, *texts), F.col("doc_id") % 10 == 0, 4).collect()
    model = seen["model"]
    counts = Counter(w for d, t in texts for w in brown_lm.tokens(t) if d % 10)
    frequent = sorted(counts, key=lambda w: (-counts[w], w))[: len(model.counts)]
    place = {w: i for i, w in enumerate(frequent)}

    rare = {bytes(r["word"]): r["class"] for r in model.classes.rare.collect()}

    def kind(word):
        return model.classes.of_frequent[place[word]] if word in place else rare.get(word, model.classes.of_word(word))

    def chance(word, history):
        if word not in counts:
            return 10 ** model.unknown[history]
        c = kind(word)
        return 10 ** (model.transitions[history, c] - model.sizes[c]) * (counts[word] - model.discount)

    for history in range(5):
        total = sum(chance(w, history) for w in counts) + chance(b"never seen", history)
        assert total == pytest.approx(1, abs=1e-9)
    got = {r.doc_id: r.score for r in rows}
    for doc_id, text in texts:
        words = brown_lm.tokens(text)
        history = [4, *map(kind, words[:-1])]
        want = sum(math.log10(chance(w, h)) for w, h in zip(words, history, strict=True))
        assert got[doc_id] == pytest.approx(want, rel=1e-9, abs=1e-9)


def test_exchange_separates_words_that_keep_apart(spark):
    texts = two_languages()
    docs = documents(spark, *texts)
    vocabulary = brown_lm.written(brown_lm.count_words(docs.select("text")), "test-vocabulary")
    frequent = brown_lm._frequent(vocabulary, 100)
    words = spark.sparkContext.broadcast([w for w, _ in frequent])
    encoded = brown_lm.written(brown_lm.encode(docs, F.lit(False), words), "test-encoded")
    classes, _ = brown_lm.cluster(encoded, len(frequent), 3, 100)
    of = {w: c for (w, _), c in zip(frequent, classes, strict=False)}
    ing = {c for w, c in of.items() if w.endswith(b"ing")}
    heit = {c for w, c in of.items() if w.endswith(b"heit")}
    assert ing and heit and not ing & heit


def test_most_frequent_words_within_the_bound(spark):
    rows = [(f"w{i}".encode(), 1 + i // 3) for i in range(300)]
    frequent = brown_lm._frequent(spark.createDataFrame(rows, "word binary, n long"), 50)
    assert 0 < len(frequent) <= 50
    assert min(n for _, n in frequent) > max(n for w, n in rows if (w, n) not in frequent)


def test_odd_rows_and_nothing_to_learn_from(spark, odd, small):
    rows = brown_lm.class_bigram_scores(odd, F.col("doc_id") == 6).collect()
    assert len(rows) == len(ODD) and all(np.isfinite(r.score) and r.score < 0 for r in rows)
    assert sorted(r.n_tokens for r in rows if r.doc_id == 9) == [2, 2, 5]
    assert [r.n_tokens for r in rows if r.doc_id in (3, 4, 5)] == [1, 1, 1]
    nothing = brown_lm.class_bigram_scores(odd, F.lit(True)).collect()
    assert {(r.n_known, r.train_tokens, r.base_score, r.score) for r in nothing} == {(0, 0, 0.0, 0.0)}


def test_words_beyond_the_most_frequent_are_exchanged_too(spark):
    """Few words are in the tables of fixed size, some at hand, some rare; all keep to their kind."""
    rng = random.Random(4)
    kinds = [[f"a{i}x" for i in range(12)], [f"b{i}x" for i in range(12)]]
    texts = [(i, " ".join(rng.choices(kinds[i % 2], range(40, 28, -1), k=30))) for i in range(200)]
    texts.append((999, "once"))
    docs = documents(spark, *texts)
    vocabulary = brown_lm.written(brown_lm.count_words(docs.select("text")), "test-vocabulary")
    frequent = brown_lm._frequent(vocabulary, 18)
    words = spark.sparkContext.broadcast([w for w, _ in frequent])
    encoded = brown_lm.written(brown_lm.encode(docs, F.lit(False), words), "test-encoded")
    classes, rare = brown_lm.cluster(encoded, len(frequent), 3, 9)
    of = {w: int(c) for (w, _), c in zip(frequent, classes, strict=False)}
    others = {bytes(r["word"]): r["class"] for r in rare.collect()}
    assert len(of) > 9 and len(others) > 4 and b"once" not in others
    of |= others
    assert len(of) == 25 and 3 not in of.values()
    first, second = ({c for w, c in of.items() if w.startswith(kind)} for kind in (b"a", b"b"))
    assert not first & second


def test_the_exchange_never_loses_likelihood_and_stops_by_itself(spark, texts):
    docs = documents(spark, *texts.items())
    vocabulary = brown_lm.written(brown_lm.count_words(docs.select("text")), "test-vocabulary")
    frequent = brown_lm._frequent(vocabulary, 300)
    words = spark.sparkContext.broadcast([w for w, _ in frequent])
    encoded = brown_lm.written(brown_lm.encode(docs, F.lit(False), words), "test-encoded")
    start = np.append(np.arange(len(frequent)) % 8, 8)
    classes, _, kept = brown_lm.exchange(encoded, 8, len(frequent), start)
    assert len(kept) >= 3 and all(b > a for a, b in zip(kept, kept[1:]))
    left, _ = brown_lm._neighbours(encoded, classes, len(frequent), 8)
    mine = np.eye(8)[classes[:-1]]
    assert brown_lm._information(left.T @ mine) == pytest.approx(kept[-1])


def test_long_words_are_never_at_hand(spark):
    long = "y" * 200
    texts = [(i, f"a b {long} a {long}z{i}") for i in range(30)]
    docs = documents(spark, *texts)
    counts = brown_lm.count_words(docs.select("text"))
    assert {w for w, _ in brown_lm._frequent(counts, 100)} == {b"a", b"b", b"\n"}
    rows = brown_lm.class_bigram_scores(docs, F.col("doc_id") % 5 == 0, 2).collect()
    assert [r.n_known for r in rows if r.doc_id % 5 == 0] == [5] * 6 and all(r.n_tokens == 6 for r in rows)


def test_words_of_a_batch_are_those_of_its_texts():
    texts = [" a  B\x0bÄc\t", "", None, "x\x85y\xa0Z\x1cq\u3000 ", "\n \r\x0c", "end"]
    found, counts = brown_lm._words(pa.array(texts, pa.string()))
    each = [brown_lm.tokens(text)[:-1] for text in texts]
    assert found.to_pylist() == [w for words in each for w in words]
    assert counts.tolist() == [*map(len, each)]
    sliced, counts = brown_lm._words(pa.array(texts, pa.string())[3:])
    assert sliced.to_pylist() == [w for words in each[3:] for w in words] and counts.tolist() == [1, 0, 1]


def test_classes_by_ending_in_one_go():
    endings = {b"ing": 1, b"ng": 2, b"g": 3, b"t": 2, b"!": 3, "ß".encode(): 1}
    words = [w.encode() for w in ("sing", "sing!?", "Wang", "g", "t", "!!", "x", "", "Spaß.", "ing")]
    classes = brown_lm.Classes(4, np.zeros(1, np.int64), endings)
    assert classes.of_words(pa.array(words, pa.binary())).tolist() == [classes.of_word(w) for w in words]


def test_neighbours_are_a_row_a_word_and_texts_are_scored_without_a_join(spark, texts):
    docs = documents(spark, *texts.items())
    vocabulary = brown_lm.written(brown_lm.count_words(docs.select("text")), "test-vocabulary")
    frequent = brown_lm._frequent(vocabulary, 300)
    words = spark.sparkContext.broadcast([w for w, _ in frequent])
    encoded = brown_lm.written(brown_lm.encode(docs, F.lit(False), words), "test-encoded").coalesce(1)
    classes = np.append(np.arange(len(frequent)) % 4, 4)
    beside = brown_lm._beside(encoded, classes, 100, 4)
    assert beside.count() == vocabulary.count() - 100
    cell = F.col("cell")
    cells = beside.select(F.explode("cells").alias("cell"))
    cells = cells.select(cell.bitwiseAND(0xFFFF).alias("cell"), F.shiftright("cell", 16).alias("n"))
    exchanged = sum(n for _, n in frequent[:100])
    assert cells.where("cell < 6").agg(F.sum("n")).first()[0] == vocabulary.agg(F.sum("n")).first()[0] - exchanged
    scored = brown_lm.class_bigram_scores(docs, F.col("doc_id") % 5 == 0, 4)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_rare_words_keep_their_counts_in_every_text(spark, small):
    """Words that occur once, twice or not in training, long ones and repeated ones, most of them rare."""
    long = "y" * 200
    texts = [*two_languages(60), (300, f"once {long} {long} twice once2"), (301, f"twice {long}\ttwice"), (302, "never once never once")]
    docs = documents(spark, *texts, *texts[:7])
    rows = brown_lm.class_bigram_scores(docs, F.col("doc_id") == 302, 4).collect()
    want = plain_base([*texts, *texts[:7]], lambda d: d == 302)
    assert len(rows) == len(texts) + 7
    for r in rows:
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:3]
        assert r.base_score == pytest.approx(want[r.doc_id][3], rel=1e-9)
        assert np.isfinite(r.score) and r.score < 0


def test_the_driver_holds_frequent_words_as_columns_and_counts_as_one(spark, texts, monkeypatch):
    n = 40_000
    words = spark.range(n).select(F.concat(F.lit("word"), "id").cast("binary").alias("word"), F.lit(7).cast("long").alias("n"))
    brown_lm._frequent(words.limit(9), n)  # what is loaded once
    tracemalloc.start()
    frequent = brown_lm._frequent(words, n)
    classes = brown_lm.classify(frequent, np.append(np.arange(n) % 4, 4), 4)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(frequent) == len(classes.of_frequent) - 1 == n
    assert peak < 250 * n, peak

    docs = documents(spark, *texts.items())
    frequent = brown_lm._frequent(brown_lm.written(brown_lm.count_words(docs.select("text")), "test-vocabulary"), 300)
    at_hand = spark.sparkContext.broadcast([w for w, _ in frequent])
    encoded = brown_lm.written(brown_lm.encode(docs, F.lit(False), at_hand), "test-encoded")
    frames, to_arrow = [], type(docs).toArrow
    monkeypatch.setattr(type(docs), "toArrow", lambda df: frames.append(df) or to_arrow(df))
    brown_lm.exchange(encoded, 32, 200, np.append(np.arange(len(frequent)) % 32, 32))
    assert frames and all(df.columns == ["id", "cells"] for df in frames)


def test_votes_for_endings_are_summed_word_by_word():
    rng = random.Random(5)
    found = {bytes(rng.choices(b"abcde.,", k=rng.randint(1, 5))): rng.randint(1, 10**6) for _ in range(500)}
    pairs = sorted(found.items(), key=lambda pair: (-pair[1], pair[0]))
    exchanged = np.array([rng.randint(0, 4) for _ in pairs] + [4])
    votes = {}
    for (word, n), c in zip(pairs, exchanged, strict=False):
        bare = word.rstrip(brown_lm.MARKS) or word
        for length in brown_lm.ENDINGS if c < 4 else ():
            votes.setdefault(bare[-length:], np.zeros(4))[c] += math.sqrt(n)
    words, counts = zip(*pairs, strict=True)
    classes = brown_lm.classify(brown_lm.Frequent(pa.array(words, pa.binary()), np.array(counts)), exchanged, 4)
    assert classes.of_ending == {ending: v.argmax() for ending, v in votes.items()}
    want = [c if c < 4 else classes.of_word(word) for word, c in zip(words, exchanged, strict=False)]
    assert classes.of_frequent.tolist() == [*want, 0]
