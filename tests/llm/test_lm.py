from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
from conftest import SF_DIR

from sightline.llm import lm


def plain_log_prob(net, symbols):
    total, padded = 0.0, [0] * lm.SIDE + list(symbols) + [0] * lm.SIDE
    for i, s in enumerate(symbols):
        around = padded[i : i + lm.SIDE] + padded[i + lm.SIDE + 1 : i + 2 * lm.SIDE + 1]
        h = [float(x) for x in net.hidden]
        for k, a in enumerate(around):
            h = [x + float(e) for x, e in zip(h, net.embed[k][a])]
        h = np.maximum(h, 0)
        logits = [float(np.dot(h, net.out[:, j]) + net.bias[j]) for j in range(lm.SYMBOLS)]
        top = max(logits)
        total += logits[s] - top - math.log(sum(math.exp(x - top) for x in logits))
    return total


def test_score_is_the_sum_of_conditionals(monkeypatch):
    monkeypatch.setattr(lm, "_CHUNK", 4)
    net = lm.Network(seed=3)
    symbols = np.random.default_rng(1).integers(0, lm.SYMBOLS, 11)
    assert abs(net.log_prob(symbols) - plain_log_prob(net, symbols)) < 1e-3
    assert net.log_prob(symbols[:0]) == 0


def test_gradient_is_the_slope():
    net = lm.Network(seed=1)
    rng = np.random.default_rng(2)
    around, target = rng.integers(0, lm.SYMBOLS, (6, 2 * lm.SIDE)), rng.integers(0, lm.SYMBOLS, 6)
    loss = lambda v: -float(np.mean(lm.Network(v).forward(around)[1][np.arange(6), target]))
    start = net.vector.copy()
    past = np.zeros(len(start), np.float32)
    net.train(around, target, past)
    size = np.sqrt(past)
    for i in np.argsort(-size)[[0, 5, 50]]:
        moved = start.copy()
        moved[i] += 1e-2
        back = start.copy()
        back[i] -= 1e-2
        assert abs(abs(loss(moved) - loss(back)) / 2e-2 - size[i]) < 0.1 * size[i] + 1e-3


def test_training_beats_the_untrained_network_and_frequencies(spark):
    docs = spark.createDataFrame([(i, "red fish blue fish one two " * 30) for i in range(40)], "doc_id long, text string")
    words = lm.vocabulary(docs)
    assert words[0] == b"fish" and set(words) == {b"red", b"fish", b"blue", b"one", b"two"}
    symbols = lm.encoded(docs, words)
    before = lm.score(symbols, lm.Network()).first().mean_log_prob
    after = lm.score(symbols, lm.fit(symbols, rounds=6)).first().mean_log_prob
    assert after > before + 1

    text = np.frombuffer(symbols.first().symbols, np.uint8).astype(np.int64)
    net, past = lm.Network(), np.zeros(len(lm.Network().vector), np.float32)
    at = np.arange(len(text))
    for _ in range(150):
        net.train(lm.windows_at(lm.padded_of(text), at), text, past)
    counts = np.array([2, 1, 1, 1, 1]) / 6
    assert net.log_prob(text) / len(text) > 0.5 * (counts * np.log(counts)).sum()


def test_averages_in_groups_equal_one_average(spark):
    rng = np.random.default_rng(0)
    rows = [(k, int(rng.integers(1, 9)), rng.normal(size=4).astype(np.float32)) for k in range(10)]
    import pyarrow as pa

    table = pa.Table.from_batches([lm._averaged_batch(*r) for r in rows])
    got = lm._average(table).to_pylist()[0]
    mean = sum(w * v for _, w, v in rows) / sum(w for _, w, _ in rows)
    assert got["windows"] == sum(w for _, w, _ in rows)
    assert np.allclose(np.frombuffer(got["vector"], np.float32), mean, atol=1e-6)


def test_edge_cases(spark):
    rows = [(1, None, 0.0), (2, "", 0.0), (None, "a b", 0.0), (3, "A b", 0.0), (3, "A b", 0.0), (4, "... !", 0.0), (5, "long " * 20000, 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, log_prob double")
    found = sorted((str(r.doc_id), r.n_words, r.log_prob <= 0, r.mean_log_prob is None) for r in lm.lm_scores(docs).collect())
    assert found == [("1", 0, True, True), ("2", 0, True, True), ("3", 2, True, False), ("3", 2, True, False), ("4", 0, True, True), ("5", 20000, True, False), ("None", 2, True, False)]
    assert lm.lm_scores(docs.limit(0)).count() == 0


def test_real_texts_run_alike_twice(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    first, second = (sorted(map(tuple, lm.lm_scores(docs).collect())) for _ in range(2))
    assert first == second and len(first) == docs.count()


def test_every_position_is_a_target_in_one_round(spark, monkeypatch):
    texts = ["one", "two words", "a few words of a text", "seven words that are in no rest", "fish " * 5000]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 3)], "doc_id long, text string")
    symbols = lm.encoded(docs, lm.vocabulary(docs))
    staged, plain = [], lm.stage
    monkeypatch.setattr(lm, "stage", lambda df, label: staged.append(plain(df, label)) or staged[-1])
    for rounds in (1, 2, 3):
        staged.clear()
        lm.fit(symbols, rounds)
        assert sum(r.windows for t in staged for r in t.collect()) == 3 * sum(len(t.split()) for t in texts)
        for text in (b"", b"a", b"abcdefg", bytes(5000)):
            seen = np.concatenate([[], *(at for number in range(rounds) for at in lm.positions(text, number, rounds))])
            assert sorted(seen) == list(range(len(text)))


def test_every_word_has_its_share_of_its_group(spark, monkeypatch):
    rng = np.random.default_rng(4)
    texts = [" ".join(f"{'xyz'[k % 3] * (k % 5)}{k % 40}ing" for k in rng.integers(0, 300, 60)) + " a of é" for _ in range(30)]
    texts += ["bring", "qqqing", None, "a", "bring bring"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    monkeypatch.setattr(lm, "fit", lambda symbols, rounds: lm.Network(np.zeros_like(lm.Network().vector)))

    size = 5
    plain = lm.frequent
    monkeypatch.setattr(lm, "frequent", lambda counted: plain(counted, size))
    split = [lm.words_of((t or "").encode()) for t in texts]
    counts = Counter(w for words in split for w in words)
    known = sorted(counts, key=lambda w: (-counts[w], w))[:size]
    group = {w: zlib.crc32(w[-3:]) % (lm.SYMBOLS - size - 1) for w in counts if w not in known}
    total = Counter()
    for w, g in group.items():
        total[g] += counts[w] + 1
    expected = [sum(-math.log(lm.SYMBOLS) + (math.log(counts[w] / total[group[w]]) if w in group else 0) for w in words) for words in split]
    assert expected[30] != expected[31]
    for common in (1 << 16, 20, 0):
        monkeypatch.setattr(lm, "COMMON", common)
        got = {r.doc_id: r.log_prob for r in lm.lm_scores(docs).collect()}
        assert all(abs(got[i] - e) < 1e-3 for i, e in enumerate(expected)), common


def test_words_of_many_texts_are_those_of_each():
    rng = np.random.default_rng(6)
    pieces = [b" ", b"a", b"B", b"\n", b"\x00", b"9", b"-", "é".encode(), "中".encode(), b"\x85"]
    for _ in range(200):
        texts = [b"".join(pieces[k] for k in rng.integers(0, len(pieces), rng.integers(0, 12))) for _ in range(rng.integers(1, 6))]
        distinct, places, sizes = lm.words_in(texts)
        split = [lm.words_of(t) for t in texts]
        assert [distinct[int(k)].as_py() for k in places] == [w for words in split for w in words]
        assert len(set(distinct.to_pylist())) == len(distinct) and sizes.tolist() == [len(words) for words in split]


def test_texts_share_passes_and_score_alike_among_any_others(monkeypatch):
    rng = np.random.default_rng(7)
    texts = [bytes(rng.integers(1, lm.SYMBOLS, n).astype(np.uint8)) for n in (0, 1, 3, 0, 40, 700, 1, 2 * lm.SIDE, 1)]
    net, passes, plain = lm.Network(seed=5), [], lm.Network.unscaled
    alone = [net.log_prob(np.frombuffer(t, np.uint8).astype(np.int64)) for t in texts]
    assert abs(alone[4] - plain_log_prob(net, texts[4])) < 1e-3
    monkeypatch.setattr(lm.Network, "unscaled", lambda *args: passes.append(1) or plain(*args))
    assert np.allclose(net.log_probs(texts), alone, rtol=1e-6) and len(passes) == 2
    assert net.log_probs([]) == [] and net.log_probs([b"", b""]) == [0, 0]


def test_a_step_is_plain_adagrad():
    rng = np.random.default_rng(8)
    net = lm.Network(seed=2)
    vector, past = net.vector.astype(float), np.zeros(len(net.vector), np.float32)
    sums = np.zeros(len(vector))
    for n in (600, 512, 7, 600):
        # Few symbols, so that a cell has many windows, and many, so that it has one.
        around, target = rng.integers(0, rng.choice([3, 40, lm.SYMBOLS]), (n, 2 * lm.SIDE)), rng.integers(0, lm.SYMBOLS, n)
        before = lm.Network(vector)
        h, logs = before.forward(around)
        error = np.exp(logs.astype(float))
        error[np.arange(n), target] -= 1
        error /= n
        back = (error @ before.out.T) * (h > 0)
        embed = np.zeros(before.embed.shape)
        for k in range(2 * lm.SIDE):
            np.add.at(embed[k], around[:, k], back)
        slope = np.concatenate([embed.ravel(), back.sum(axis=0), (h.T @ error).ravel(), error.sum(axis=0)])
        sums += slope * slope
        vector -= lm.RATE * slope / (np.sqrt(sums) + 1e-4)
        net.train(around, target, past)
        assert np.allclose(past, sums, rtol=1e-2, atol=1e-9)
        assert np.abs(net.vector - vector).max() < 2e-3
        vector = net.vector.astype(float)
