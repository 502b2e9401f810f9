import random
import zlib

import numpy as np

from delivery_marts.llm import queries, toxicity
from tests.llm.conftest import documents

INSULTS, STEM = ["idiot", "moron", "scum", "trash", "loser"], "vequ"
SYLLABLES = ["an", "er", "th", "on", "in", "es", "re", "st", "ou", "ha"]


def corpus(rng, n):
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choices(SYLLABLES, k=rng.randrange(1, 4))) for _ in range(rng.randrange(5, 120))]
        toxic = i % 5 == 0
        for _ in range(rng.randrange(1, 5) if toxic else 0):
            bad = rng.choice(INSULTS) if i % 2 else STEM + rng.choice(SYLLABLES) + rng.choice(SYLLABLES)
            words.insert(rng.randrange(len(words)), bad.upper() if rng.random() < 0.2 else bad)
        rows.append((i, " ".join(words) + "."))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_texts_in_words_and_stems_not_seen(spark):
    rows, labels = corpus(random.Random(0), 900)
    train = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 3 != 1]
    scores = toxicity.toxicity(documents(spark, *rows), spark.createDataFrame(train, "doc_id long, toxic int"))
    got = {r.doc_id: r.score for r in scores.collect()}
    truth = dict(labels)
    assert set(got) == set(truth) and all(0 <= s <= 1 for s in got.values())
    wrong = [i for i, s in got.items() if (s >= 0.7) != truth[i]]
    assert len(wrong) <= 5


def test_label_model_finds_accuracies_and_correlated_voters(spark):
    """Without gold: two copies of a voter count about as one, a random voter hardly at all."""
    rng = np.random.default_rng(1)
    truth = rng.random(6000) < 0.3
    def voter(accuracy):
        return np.where(rng.random(6000) < accuracy, truth, ~truth).astype(int)
    good, other, third, noise = voter(0.9), voter(0.8), voter(0.85), rng.integers(0, 2, 6000)
    votes = np.stack([good, good, other, third, noise], axis=1)
    patterns = {}
    for row in votes:
        key = "".join(map(str, row))
        patterns[key] = patterns.get(key, 0) + 1
    model = toxicity.label_model(spark.createDataFrame(list(patterns.items()), "votes string, n long"), 5, 0.3)
    assert 0.2 < model.prior < 0.4
    hit = [(model.chances[1, j, 1] + model.chances[0, j, 0]) / 2 for j in range(5)]
    assert hit[0] > hit[2] > hit[4] and abs(hit[4] - 0.5) < 0.1
    assert max(model.weights[:2]) < 0.6 < 0.75 < min(model.weights[2:])
    assert ((model.posterior(votes) > 0.5) == truth).mean() > 0.9


def test_odd_rows_labels_and_texts(spark, odd):
    labels = [(1, 0), (2, 0), (6, None), (7, 1), (None, 1), (404, 1), (9, 1)]
    frame = spark.createDataFrame(labels, "doc_id long, toxic int")
    rows = toxicity.toxicity(odd, frame).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    none = toxicity.toxicity(odd, frame.where("toxic = 0")).collect()
    assert {r.score for r in none} == {0.0}


def test_query_marks_the_held_out_and_follows_the_score(spark, db):
    rows = queries.op2_toxicity(spark, "/root/testdata/sf0.1").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(r.predicted == int(r.score >= 0.7) for r in rows)
    truth = dict(db.sql("SELECT doc_id, toxic FROM '/root/testdata/sf0.1/labels.parquet'").fetchall())
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([p == y for p, y in held]) >= 0.95


def test_fit_against_plain_gradient(spark):
    rng = np.random.default_rng(2)
    rows = [sorted(set(rng.integers(0, 4, 2).tolist())) for _ in range(400)]
    targets = np.clip(0.2 + 0.5 * np.array([0 in r for r in rows]) + rng.normal(0, 0.1, 400), 0, 1)
    shares = rng.choice([1.0, 0.1, 3.0], 400)
    examples = [(r, float(w), float(t)) for r, w, t in zip(rows, shares, targets)]
    weights = toxicity.fit(spark.createDataFrame(examples, "features array<int>, weight double, target double"), 4)
    x = np.array([[f in r for f in range(4)] + [True] for r in rows], float)
    gradient = x.T @ (shares * (1 / (1 + np.exp(-x @ weights)) - targets)) + np.array([0.1] * 4 + [0]) * weights
    assert np.abs(gradient).max() < 1e-2


def test_clean_text_around_toxic_text_does_not_acquit_it(spark, db):
    """Held-out toxic texts at the end of ten clean ones, and clean ones alone: recall at 0.7."""
    folder, rng = "/root/testdata/sf0.1", random.Random(6)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    train = labels.where("crc32(cast(cast(doc_id as string) as binary)) % 3 <> 1")
    held = {r.doc_id: (r.text, r.toxic) for r in docs.join(labels, "doc_id").collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1}
    toxic = [text for text, y in held.values() if y == 1]
    clean = [text for text, y in held.values() if y == 0]
    made = {f"given {i}": t for i, t in enumerate(toxic)} | {f"clean {i}": t for i, t in enumerate(clean)}
    made |= {f"diluted {i}": " ".join([*rng.choices(clean, k=10), rng.choice(toxic)]) for i in range(200)}
    made |= {f"insult {i}": f"{rng.choice(clean)} idiot {rng.choice(clean)}" for i in range(100)}
    names = list(made)
    added = documents(spark, *((-1 - i, made[name]) for i, name in enumerate(names)))
    scores = toxicity.toxicity(docs.unionByName(added), train).where("doc_id < 0").collect()
    found = {}
    for r in scores:
        found.setdefault(names[-1 - r.doc_id].split()[0], []).append(r.score >= 0.7)
    share = {kind: np.mean(marks) for kind, marks in found.items()}
    assert share["given"] >= 0.9 and share["diluted"] >= 0.9 and share["insult"] >= 0.9
    assert share["clean"] <= 0.01


def test_strongest_passage():
    assert toxicity._passage([]) == 0.0
    hits = [(0, 1.0), (99, 2.0), (100, 4.0), (500, 3.0), (599, 3.0), (600, 0.5)]
    assert toxicity._passage(hits) == 6.0
    rng = random.Random(3)
    for _ in range(50):
        hits = sorted({rng.randrange(400): rng.random() for _ in range(20)}.items())
        plain = max(sum(s for q, s in hits if p <= q < p + toxicity.WINDOW) for p, _ in hits)
        assert abs(toxicity._passage(hits) - plain) < 1e-9


def test_beginnings_with_equal_counts_are_kept_once(spark):
    rows = [(f"idiots here {i}", 1) for i in range(30)] + [(f"all calm {i}", 0) for i in range(200)]
    found = dict(toxicity.lexicon(spark.createDataFrame(rows, "text string, toxic int")))
    assert {"idiots", "idiot*"} <= set(found) and not {"idi*", "idio*"} & set(found)
