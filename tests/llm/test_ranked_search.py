"""Ranked search against a plain loop, the bounds of the ball tree, and edge frames."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from ebbtide.llm.ranked_search import BallTree, ranked_search, terms_of

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def brute(docs, items, k):
    words = [(d, TERM.findall((t or "").translate(LOWER))) for d, t in docs]
    words = [(d, w) for d, w in words if w]
    n_all, l_all = len(words), sum(len(w) for _, w in words)
    df = Counter(t for _, w in words for t in set(w))
    weight = {t: math.floor(1000 * math.log((2 * n_all + 2) / (2 * c + 1))) for t, c in df.items()}
    wanted = {}
    for i, t in items:
        if i is not None:
            wanted.setdefault(i, set()).update(TERM.findall((t or "").translate(LOWER)))
    out = []
    for i, terms in wanted.items():
        scored = []
        for d, w in words:
            tf, m = Counter(w), 100 - 50 + (50 * len(w) * n_all) // l_all
            score = sum(weight[t] * (10**9 * tf[t] // (1000 * tf[t] + 20 * m)) for t in terms if tf[t])
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(i, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def searched(spark, docs, items, k):
    d = spark.createDataFrame([(i, t, "x", None, 1) for i, t in docs], "doc_id long, text string, term string, row string, n int").repartition(3)
    q = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, tid string")
    return sorted((tuple(r) for r in ranked_search(d, q, k).collect()), key=str)


def test_terms():
    assert terms_of("Ab-c É1ß x _\x7f\x80".encode()) == [w.encode() for w in TERM.findall("ab-c É1ß x _\x7f\x80")]
    assert terms_of(None) == terms_of(b" ,") == []


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_a_plain_loop(spark, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["É", "straße"]
    text = lambda n: " ".join(rng.choice(words).upper() if rng.random() < 0.2 else words[int(rng.paretovariate(0.6)) % len(words)] for _ in range(n))
    docs = [(i, text(rng.choice([1, 5, 30, 200]))) for i in range(300)] + [(7, "w1 w2 w2"), (7, "w1 w2 w2"), (None, "w1 w2 w2"), (900, None), (901, " .,"), (902, "w5 " * 40000)]
    items = [(i, text(8)) for i in range(12)] + [(3, "w1 W2"), (50, None), (51, ""), (52, "unheardof"), (None, "w1")]
    assert searched(spark, docs, items, 20) == brute(docs, items, 20)


def test_empty_tables(spark):
    assert searched(spark, [], [(1, "a")], 5) == searched(spark, [(1, "a b")], [], 5) == searched(spark, [(1, None)], [(1, "a")], 5) == []


def test_many_blocks(spark, monkeypatch):
    monkeypatch.setattr("ebbtide.llm.ranked_search.DOC_BLOCK", 16)
    monkeypatch.setattr("ebbtide.llm.ranked_search.ITEM_TERMS", 5)
    rng = random.Random(5)
    docs = [(i, " ".join(rng.choices("abcdefghij", k=6))) for i in range(150)]
    items = [(i, " ".join(rng.choices("abcdefghij", k=3))) for i in range(9)]
    assert searched(spark, docs, items, 7) == brute(docs, items, 7)


def test_tree_prunes_clustered_data():
    rng = np.random.default_rng(0)
    n, width = 4000, 8
    cluster = rng.integers(0, 40, n)
    cols = (cluster[:, None] * width + np.arange(width)).ravel()
    vals = rng.integers(900, 1000, n * width)
    tree = BallTree(np.arange(n), np.arange(0, n * width + 1, width), cols, vals, 40 * width, leaf=20)
    query = np.zeros(40 * width, dtype=np.int64)
    query[3 * width : 4 * width] = 50
    ids, scores = tree.search(query, 10)
    own = (vals.reshape(n, width).sum(1) * 50) * (cluster == 3)
    best = np.lexsort((np.arange(n), -own))[:10]
    assert ids.tolist() == best.tolist() and scores.tolist() == own[best].tolist()
    assert tree.read < n / 3


def test_tree_takes_equal_documents():
    tree = BallTree(np.arange(500)[::-1].copy(), np.arange(501), np.zeros(500, dtype=np.int64), np.full(500, 7), 1, leaf=4)
    ids, scores = tree.search(np.array([3]), 3)
    assert ids.tolist() == [0, 1, 2] and scores.tolist() == [21] * 3
