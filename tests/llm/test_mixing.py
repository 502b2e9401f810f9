import hashlib
import re
from collections import Counter, defaultdict
from fractions import Fraction

from pyspark.sql import functions as F

from delivery_marts.llm import mixing
from tests.llm.conftest import documents


def share(given, children):
    """Shares by weight, what a full child leaves going to the others: plain rounds."""
    quota = {}
    while True:
        total = sum(w for name, (cap, w) in children.items() if name not in quota)
        left = given - sum(quota.values())
        full = [n for n, (cap, w) in children.items() if n not in quota and cap * total <= w * left]
        if not full:
            return quota | {n: w * left // total if w else 0 for n, (cap, w) in children.items() if n not in quota}
        quota |= {n: children[n][0] for n in full}


def plain(rows, weights, epochs, seed, budget=None, domain_of=lambda s: "web" if (s or "").startswith("w") else "unknown"):
    size = lambda text: len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    leaves = defaultdict(list)
    for doc_id, text, lang, source in rows:
        leaves[domain_of(source), lang or "unknown", source or "unknown"].append((doc_id, size(text)))
    tokens = {leaf: sum(n for _, n in docs) for leaf, docs in leaves.items()}
    weight = lambda level, name: weights.get(("domain", "lang", "source")[level], {}).get(name, 1)
    caps = {leaf: n * epochs if all(weight(i, x) for i, x in enumerate(leaf)) else 0 for leaf, n in tokens.items()}
    quotas = {(): min(sum(caps.values()), sum(tokens.values()) if budget is None else budget)}
    for depth in range(3):
        below = {}
        for parent, given in quotas.items():
            names = {leaf[depth] for leaf in leaves if leaf[:depth] == parent}
            children = {
                n: (sum(c for leaf, c in caps.items() if leaf[: depth + 1] == (*parent, n)), weight(depth, n)) for n in names
            }
            below |= {(*parent, n): q for n, q in share(given, children).items()}
        quotas = below
    taken = Counter()
    for leaf, docs in leaves.items():
        whole, rest = divmod(quotas[leaf], tokens[leaf]) if tokens[leaf] else (0, 0)
        key = lambda d: hashlib.md5(":".join(map(str, [seed, whole, *([d] if d is not None else [])])).encode()).hexdigest()  # noqa: E731,B023
        start, last, groups = 0, None, defaultdict(int)
        for doc_id, n in docs:
            groups[key(doc_id)] += n
        for k in sorted(groups):
            if start < rest:
                last = k
            start += groups[k]
        for doc_id, _ in docs:
            for epoch in range(whole + (last is not None and key(doc_id) <= last)):
                taken[doc_id, epoch] += 1
    return taken, quotas


def plain_by(rows, domain_of, weights, epochs, seed):
    return plain(rows, weights, epochs, seed, None, domain_of)[0]


def run(spark, rows, weights, epochs, seed, budget=None):
    domain = F.when(F.col("source").startswith("w"), "web")
    mixed = mixing.mix(documents(spark, *rows), domain, weights, epochs, seed, budget)
    return Counter((r.doc_id, r.epoch) for r in mixed.collect())


ROWS = [
    (i, "w " * (1 + i * 7 % 13), ("en", "de", None)[i % 3], f"{'wx'[i % 2]}{i % 5}" if i % 11 else None) for i in range(300)
] + [(900, None, "en", "w0"), (901, "", "en", "w0"), (902, "a b", "en", "w0"), (902, "a b", "en", "w0"), (None, "x", "en", "w0")]
WEIGHTS = {"domain": {"web": 3, "unknown": 1}, "lang": {"en": 5, "de": 0}, "source": {"w0": 7}}


def test_mix_against_plain_rounds(spark):
    for weights, epochs, budget in ((WEIGHTS, 3, None), (WEIGHTS, 1, 500), ({}, 2, 10**9), (WEIGHTS, 4, 0)):
        want, _ = plain(ROWS, weights, epochs, 5, budget)
        assert run(spark, ROWS, weights, epochs, 5, budget) == want, (epochs, budget)


def test_shortage_goes_to_siblings_before_ancestors(spark):
    rows = [(i, "t " * 100, "en", "w1") for i in range(1)] + [(10 + i, "t " * 100, "en", "w2") for i in range(9)]
    rows += [(30 + i, "t " * 100, "en", "other") for i in range(10)]
    got = run(spark, rows, {"source": {"w1": 9, "w2": 1}}, 1, 0, 1000)
    # Half of the budget is the web's: w1 has 100 of its 450, w2 takes the other 400.
    assert sum(doc < 20 for doc, _ in got) == 5
    assert sum(doc >= 30 for doc, _ in got) == 5


def test_quotas_meet_the_budget(spark):
    _, quotas = plain(ROWS, WEIGHTS, 3, 5, 700)
    assert 0 <= 700 - sum(quotas.values()) < len(quotas)
    assert Fraction(sum(q for leaf, q in quotas.items() if leaf[0] == "web"), 700) > Fraction(7, 10)


def test_odd_rows_and_clashing_names(spark, odd):
    mixed = mixing.mix(odd, F.lit("all"), {}, 1)
    assert set(odd.columns) <= set(mixed.columns)
    assert {r.epoch for r in mixed.collect()} == {0}
    assert mixed.count() == odd.count()
