from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from sightline.llm import lexical


def plain_terms(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def plain_search(docs, items, k=10):
    counts = [(i, Counter(plain_terms(t))) for i, t in docs]
    n_docs = sum(1 for _, c in counts if c)
    total = sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(plain_terms(text))
    out = []
    for item, terms in asked.items():
        scored = []
        for i, c in counts:
            if not c:
                continue
            m = 100 - 90 + 90 * c.total() * n_docs // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m))
                for t in terms
                if c[t]
            )
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return out


def made(seed, n=400):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["É", "ünder", "7", "The"]
    weights = [1 / (1 + k) for k in range(len(words))]
    text = lambda size: " ".join(rng.choices(words, weights, k=size))
    docs = [(i, text(rng.choice([1, 3, 8, 30, 200]))) for i in range(n)]
    docs += [(2000 + i, docs[5][1]) for i in range(60)]  # one large group of ties
    docs += [docs[3], docs[3], (None, docs[5][1]), (None, None), (3000, None), (3001, ""), (3002, " .,;"), (3003, "w1 " * 30000)]
    items = [(f"i{k}", text(rng.choice([1, 2, 5, 20]))) for k in range(25)]
    items += [("i0", "w7 w9"), ("empty", ""), ("null", None), ("unknown", "zzz yyy"), ("Case", "THE w3!W5"), ("tie", docs[5][1])]
    return docs, items


def found(spark, docs, items, **options):
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, item_id string, score int")
    q = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id string, text string, rank int")
    return sorted(map(str, map(tuple, lexical.search(d, q, **options).select("item_id", "rank", "doc_id", "score").collect())))


@pytest.mark.parametrize("seed,options,sizes", [(1, {}, {}), (2, {"block_bytes": 700, "k": 3}, {"MOST": 16, "LEAST": 4, "FIRST": 20})])
def test_results_are_those_of_scoring_every_pair(spark, monkeypatch, seed, options, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(lexical, name, value)
    docs, items = made(seed)
    assert found(spark, docs, items, **options) == sorted(map(str, plain_search(docs, items, options.get("k", 10))))


def test_empty_tables(spark):
    docs, items = made(3, 20)
    assert found(spark, [], items) == [] == found(spark, docs, [])
    assert found(spark, [(1, None), (2, "..")], items) == []


def test_bucket_scores_equal_the_products():
    rng = np.random.default_rng(0)
    rows, terms = 200, 30
    dense = rng.integers(1, 1000, (rows, terms)) * (rng.random((rows, terms)) < 0.2)
    row, term = np.nonzero(dense)
    lengths = np.sqrt((dense.astype(float) ** 2).sum(axis=1)) * (1 + 1e-9)
    bucket = lexical.Bucket(lengths, np.searchsorted(row, np.arange(rows + 1)), term, dense[row, term])
    for size in (1, 3, 10, 30):
        query = np.sort(rng.choice(terms + 5, size, replace=False))
        exact = dense[:, query[query < terms]].sum(axis=1)
        for least in (1, *np.unique(exact)[-5:], exact.max() + 1):
            if least < 1:
                continue
            got, scores = bucket.scores(query, int(least))
            assert got.tolist() == np.flatnonzero(exact >= least).tolist()
            assert (scores == exact[got]).all()


def test_cuts_cover_all_in_order():
    lengths = np.sort(np.random.default_rng(1).exponential(50, 5000))[::-1]
    cuts = list(lexical._cuts(lengths))
    assert [c[0] for c in cuts] == [0] + [c[1] for c in cuts[:-1]] and cuts[-1][1] == 5000
    assert all(b - a <= lexical.MOST for a, b in cuts)


def test_a_long_text_is_counted_whole(monkeypatch):
    monkeypatch.setattr(lexical, "_PIECE", 50)
    text = "alpha Beta,gamma " * 40
    assert lexical.counts_of(text.encode()) == Counter({b"alpha": 40, b"beta": 40, b"gamma": 40})
