from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sightline.llm import ftrl, quality_model, toxicity, training
from sightline.llm.common import PLAIN

SF = "/root/testdata/sf0.1"
BATCH = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("at", pa.list_(pa.int32())), ("x", pa.list_(pa.float32()))])


def test_ftrl_learns_and_stays_sparse():
    rng = np.random.default_rng(0)
    rows = []
    for _ in range(400):
        label = int(rng.integers(2))
        at = np.unique(np.append(rng.integers(2, 50, 5), label))
        rows.append((at, np.ones(len(at)), label))
    w = ftrl.train(rows, 50, l1=1.0)
    right = [(ftrl.sigmoid(w[at] @ x + w[-1]) > 0.5) == label for at, x, label in rows]
    assert np.mean(right) > 0.98 and w[0] < 0 < w[1] and (w[2:50] == 0).sum() > 20
    assert ftrl.prior_shift((10, 10), (90, 10)) == pytest.approx(np.log(1 / 9))
    assert ftrl.prior_shift((0, 5), (1, 1)) == 0


def plain_grams(text, bits):
    data, found = b" " + text.translate(PLAIN) + b" ", set()
    for order in toxicity.ORDERS:
        for i in range(len(data) - order + 1):
            value = order
            for k in range(order):
                value = (value ^ data[i + k]) * int(toxicity._MIX[k]) % (1 << 32)
                value ^= value >> 15
            found.add(value >> (32 - bits))
    return found


@pytest.mark.parametrize("piece", [16, 1 << 18])
def test_character_features(monkeypatch, piece):
    monkeypatch.setattr(toxicity, "_PIECE", piece)
    present = toxicity.Present(16)
    for text in ["", "a", "You FOOL, you fool!", "été " * 20, "x" * 100]:
        got = present.of(text.encode())
        assert len(got) == len(set(got.tolist()))
        assert set(got.tolist()) == plain_grams(text.encode(), 16)


def test_log_count_ratios():
    rows = [(np.array([0, 1]), None, 1), (np.array([1]), None, 0), (np.array([1, 2]), None, 0)]
    ratio = toxicity.log_count_ratios(rows, 4)
    assert ratio[0] == pytest.approx(np.log((2 / 6) / (1 / 7)))
    assert ratio[1] == pytest.approx(np.log((2 / 6) / (3 / 7)))
    assert ratio[3] == 0


def test_word_features(monkeypatch):
    at, x = quality_model.features(b"a b a b")
    assert len(at) == 4 and x @ x == pytest.approx(1)
    one, _ = quality_model.features(b"spam spam spam")
    other, _ = quality_model.features(b"eggs eggs eggs")
    assert len(set(one.tolist()) & set(other.tolist())) == 1  # the pair of equal words
    assert len(quality_model.features(b" \t")[0]) == 0
    long = b"one two three " * 50
    whole = quality_model.features(long)
    monkeypatch.setattr(quality_model, "_PIECE", 64)
    parts = quality_model.features(long)
    assert whole[0].tolist() == parts[0].tolist()


def accuracy(spark, query, label):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = query(spark.read.parquet(f"{SF}/documents.parquet"), labels).filter("held_out").join(labels, "doc_id")
    rows = rows.select(F.col(label).alias("y"), "predicted", "score").collect()
    assert all(0 <= r.score <= 1 for r in rows)
    return Counter((r.y, r.predicted) for r in rows)


def test_quality_on_held_out_rows(spark):
    found = accuracy(spark, quality_model.quality, "quality")
    assert found[1, 1] >= 0.99 * (found[1, 1] + found[1, 0])
    assert found[0, 0] >= 0.9 * (found[0, 0] + found[0, 1])


def test_toxicity_on_held_out_rows(spark):
    found = accuracy(spark, toxicity.toxicity, "toxic")
    assert found[0, 0] >= 0.995 * (found[0, 0] + found[0, 1])
    assert found[1, 1] >= 0.7 * (found[1, 1] + found[1, 0])


ROWS = [(i, "you are a perfect idiot sir" if i % 2 else "the garden is lovely today", "s") for i in range(40)]


@pytest.mark.parametrize("query,label", [(quality_model.quality, "quality"), (toxicity.toxicity, "toxic")])
def test_edge_cases(spark, query, label):
    schema = "doc_id long, text string, score string"
    odd = [(100, None, "s"), (101, "", "s"), (None, "the garden", "s"), (3, ROWS[3][1], "s"), (102, "word " * 60000, "s")]
    docs = spark.createDataFrame(ROWS + odd, schema)
    marks = [(i, i % 2, "s") for i in range(40)] + [(3, 1, "s"), (5, None, "s"), (None, 1, "s"), (7, 9, "s"), (100, 0, "s"), (555, 1, "s")]
    labels = spark.createDataFrame(marks, f"doc_id long, {label} int, text string")
    found = query(docs, labels)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = found.collect()
    assert len(rows) == len(ROWS) + len(odd) and all(0 <= r.score <= 1 for r in rows)
    for r in rows:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    assert {r.predicted for r in rows if r.doc_id in range(1, 40, 2)} == {1}
    assert query(docs.limit(0), labels).count() == 0
    assert query(docs, labels.limit(0)).count() == len(rows)
    assert {r.predicted for r in toxicity.toxicity(docs, labels.withColumn("toxic", F.lit(0))).collect()} == {0}


def test_accepted_keeps_columns(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    kept = toxicity.accepted(docs, labels)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == list(range(0, 40, 2))


def plain_features(text, bits):
    words = [zlib.crc32(w.encode()) for w in quality_model._TOKEN.findall(text)]
    pairs = [0x5EED if a == b else (a * 0x9E3779B1 ^ b * 0x85EBCA77) % (1 << 32) for a, b in zip(words, words[1:])]
    n = Counter((v * 0xC2B2AE3D % (1 << 32)) >> (32 - bits) for v in words + pairs)
    values = np.log1p([n[k] for k in sorted(n)])
    return sorted(n), values / np.sqrt(values @ values)


@pytest.mark.parametrize("piece", [1, 64, 1000, 1 << 20])
def test_word_features_are_the_plain_ones_in_any_pieces(monkeypatch, piece):
    rng = np.random.default_rng(piece)
    text = " ".join(f"w{k}" if k % 7 else "\n!?" for k in rng.integers(0, 4000, 5000))
    expected, values = plain_features(text, quality_model.BITS)
    monkeypatch.setattr(quality_model, "_PIECE", piece)
    at, x = quality_model.features(text.encode())
    assert at.tolist() == expected
    assert x == pytest.approx(values)


def test_the_sample_is_bounded_in_rows(spark):
    rows = [(1, f"text {k % 3}") for k in range(300)] + [(k, f"other {k}") for k in range(2, 60)] + [(None, "nobody")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("label", F.lit("x"))
    labels = spark.createDataFrame([(k, k % 2, 1) for k in range(1, 60)] + [(1, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    found, counts = training.sample(docs, labels, "quality", 5)
    got = found.collect()
    assert len(got) == 10 and len({r.doc_id for r in got}) == 10 and sum(r.label for r in got) == 5
    known = [k for k in range(1, 60) if zlib.crc32(str(k).encode()) % 5]
    assert counts == (sum(k % 2 == 0 for k in known), sum(k % 2 for k in known))
    all_rows = training.sample(docs, labels, "quality", 1000)[0]
    texts = {r.doc_id: r.text for r in all_rows.collect()}
    assert sorted(texts) == known and all(t.startswith("text") if k == 1 else t == f"other {k}" for k, t in texts.items())


def test_rows_are_views_in_order():
    batches = [
        pa.RecordBatch.from_pydict({"doc_id": [7, 3], "label": [1, 0], "at": [[5, 6], []], "x": [[0.5, 1.5], []]}, BATCH),
        pa.RecordBatch.from_pydict({"doc_id": [], "label": [], "at": [], "x": []}, BATCH),
        pa.RecordBatch.from_pydict({"doc_id": [1], "label": [1], "at": [[2]], "x": [[2.5]]}, BATCH),
    ]
    rows = training.rows_of(batches)
    assert [(at.tolist(), x.tolist(), label) for at, x, label in rows] == [([2], [2.5], 1), ([], [], 0), ([5, 6], [0.5, 1.5], 1)]
    assert [x.tolist() for _, x, _ in rows.valued(np.arange(10) / 10)] == [[0.2], [], [0.5, 0.6]]
    assert len(training.rows_of([])) == 0
