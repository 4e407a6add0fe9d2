from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from sightline.llm import mixing


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > most * sizes[s]}
        if not over:
            return target | {s: weight[s] * level for s in open_}
        for s in over:
            target[s] = float(most * sizes[s])
            left -= target[s]
        open_ -= over
    return target


def table(spark, seed=1):
    rng = random.Random(seed)
    sources = ["b", "a", "c", None, "ä", "Z", "d"]
    rows = []
    for i in range(400):
        source = rng.choice(sources) if i % 3 else "hot"
        rows.append((i, "w " * rng.choice([0, 1, 7, 50, 300]), source, "x"))
    rows += [(7, None, "a", "x"), (None, "p q", "b", "x"), (9, "same text", "c", "x"), (9, "same text", "c", "x"), (1000, "", "empty", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, taken string")


def test_targets_and_words_taken(spark):
    docs = table(spark)
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
    target = plain_targets(sizes)
    taken = {}
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source], rel=1e-12)
        assert 0 <= r.taken <= 2 * r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert taken == {s: int(t + 1e-9) for s, t in target.items()}


def test_order_and_positions(spark, monkeypatch):
    def once(rows):
        return [tuple(r) for r in rows.collect()]

    few = once(mixing.mix(table(spark)))
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 3)
    assert once(mixing.mix(table(spark).repartition(5))) == few
    due = [p for *_, p, _ in few if p is not None]
    assert due == sorted(due) and [p for *_, p, _ in few][: len(due)] == due
    by_source = {}
    for doc, source, size, *_, p, _ in few:
        if p is not None and size:
            by_source.setdefault(source, []).append(hashlib.md5(str(doc).encode()).hexdigest() if doc is not None else "")
    for keys in by_source.values():
        assert keys == sorted(keys)


@pytest.mark.parametrize("course", mixing.COURSES)
def test_time_inverts_the_integral(spark, course):
    def demand(t):
        total, area = 0.0, sum((a[1] + b[1]) / 2 * (b[0] - a[0]) for a, b in zip(course, course[1:]))
        for (t0, f0), (t1, f1) in zip(course, course[1:]):
            d = max(0.0, min(t, t1) - t0)
            total += f0 * d + (f1 - f0) / (t1 - t0) * d * d / 2
        return total / area

    times = [i / 20 for i in range(20)]
    rows = spark.createDataFrame([(t, demand(t)) for t in times], "t double, d double")
    for t, got in rows.select("t", mixing.time_of(F.col("d"), course)).collect():
        assert got == pytest.approx(t, abs=1e-9)


def test_small_tables(spark):
    schema = "doc_id long, text string, source string"
    assert mixing.mix(spark.createDataFrame([], schema)).count() == 0
    row = mixing.mix(spark.createDataFrame([(1, None, None)], schema)).first()
    assert (row["size"], row.source_size, row.target, row.taken, row.position) == (0, 0, 0.0, 0, None)
    row = mixing.mix(spark.createDataFrame([(1, "long " * 100_000, "a")], schema)).first()
    assert (row["size"], row.taken, row.position) == (100_000, 150_000, 0.0)
