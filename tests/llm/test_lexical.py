"""Ranked search against scores of all pairs."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tileframe.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain(docs, items, k):
    counted = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs if terms(t)]
    n, total = len(counted), sum(x[2] for x in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, size in counted:
            m = 100 - 75 + (75 * size * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in terms(text) if t in c
            )
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def made(seed, size):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["É", "Straße", "x1", "日本", "A.b"]
    weights = [1 / (i + 1) for i in range(len(words))]
    text = lambda n: " ".join(rng.choices(words, weights, k=rng.randrange(1, n)))
    docs = [(i, text(50)) for i in range(size)]
    docs += [(1, docs[1][1]), (1, docs[1][1]), (None, docs[2][1]), (5000, None), (5001, ""), (5002, "!?\x00 ~"), (5003, "w1 " * 20_000)]
    items = [(i, text(12)) for i in range(40)] + [(7, "w1 w1 w1 w2"), (7, "w1"), (None, "w3"), (90, None), (91, "nowhere"), (92, "")]
    return docs, items


@pytest.mark.parametrize("seed, size, postings", [(1, 700, 50_000), (2, 60, 50)])
def test_against_all_pairs(spark, seed, size, postings):
    docs, items = made(seed, size)
    found = lexical.search(
        spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, score int, `row` string").repartition(3),
        spark.createDataFrame([(*r, 1, "x") for r in items], "item_id long, text string, rank int, `item` string"), postings=postings,
    )
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain(docs, items, 10)


def test_empty(spark):
    docs, items = spark.createDataFrame(made(1, 5)[0], "doc_id long, text string"), spark.createDataFrame([(1, "w1")], "item_id long, text string")
    assert lexical.search(docs.where("false"), items).collect() == []
    assert lexical.search(docs, items.where("false")).collect() == []


def test_batches_are_left_out():
    """Documents about other things than the items are not scored, and the best ones are found all the same."""
    rng = np.random.default_rng(1)
    items = lexical.Items(np.repeat(np.arange(20), 2) * 3 + np.tile([0, 1], 20), np.full(40, 9.0), np.arange(0, 41, 2))
    one, weight = lexical.Search(items, 3), np.where(np.arange(64) < 60, 9.0, 0.0)
    for start in range(0, 2000, 500):
        owner = np.repeat(np.arange(500), 3)
        terms = np.stack([rng.integers(0, 20, 500) * 3, np.full(500, 61), np.full(500, 62)], axis=1).ravel()
        one.batch(list(range(start, start + 500)), np.arange(start, start + 500), owner, terms, rng.integers(1, 1000, 1500).astype(float), weight)
    assert all(len(x) == 3 for x in one.best.kept)
    assert one.scored < 0.5 * 2000 * 20
