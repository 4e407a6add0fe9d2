from __future__ import annotations

import random
import re
from fractions import Fraction
from math import comb

import pytest
from pyspark.sql import functions as F

from sightline.llm import rules


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    places = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i : i + 8]), []).append(i)
    hit = {i + k for found in places.values() if len(found) > 1 for i in found for k in range(8)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), len(re.findall("[A-Z]", text)),
    )


def texts():
    rng = random.Random(2)
    out = [None, "", " \n\t\x0b\n ", "a", "a b c d e f g h", "x " * 40, "A#b|c <d>\nA#b|c <d>\n \n \nend", "é🙂 " * 9, "w\x1cv\x85u"]
    for _ in range(40):
        phrase = [rng.choice("abcd") for _ in range(rng.choice([8, 9, 12]))]
        body = [rng.choice("abcdefghijklmnop") * rng.choice([1, 2]) for _ in range(rng.choice([10, 60]))]
        for _ in range(rng.choice([0, 1, 2, 3])):
            at = rng.randrange(len(body))
            body[at:at] = phrase
        out.append(rng.choice([" ", "  ", " \n"]).join(body))
    return out + ["one two three four " * 5000]


def test_base_counts(spark):
    rows = texts()
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(rows)], "doc_id long, text string, rule_step string")
    found = rules.with_counts(docs, name="got").orderBy("doc_id").collect()
    assert [tuple(r.got[c] for c in rules.COUNTS) for r in found] == [plain_counts(t) for t in rows]
    assert {r.rule_step for r in found} == {"x"}


@pytest.mark.parametrize("n,rate", [(0, 0.02), (10, 0.02), (500, 0.02), (3000, 0.1), (50_000, 0.02)])
def test_binomial_tail_is_exact(spark, n, rate):
    ks = sorted({k for k in (0, 1, 2, int(n * rate / 2), int(n * rate), n) if k <= n})
    rows = spark.createDataFrame([(k, n) for k in ks], "k long, n long")
    for k, p in rows.select("k", rules.tail(F.col("k"), F.col("n"), rate)).collect():
        if k > n * rate:
            assert p == 1
        elif n <= 3000:
            q = Fraction(rate)
            exact = sum(comb(n, i) * q**i * (1 - q) ** (n - i) for i in range(k + 1))
            assert p == pytest.approx(float(exact), rel=1e-9)
        else:
            assert 0 <= p <= 1


def corpus(spark, good, bad, noisy):
    """Clean texts, texts full of marks (label 0), and a few good texts with some marks."""
    plain = " ".join(f"word{i}" for i in range(40))
    rows, marks = [], []
    for i in range(good + bad + noisy):
        text = f"{plain} tail{i}"
        if good <= i < good + bad:
            text = "".join(f"word{k}### " for k in range(60)) + str(i)
        elif i >= good + bad:
            text = f"{plain} # # # # tail{i}"
        rows.append((i, text, "en", "x"))
        marks.append((i, int(not good <= i < good + bad), "x"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, kept string")
    return docs, spark.createDataFrame(marks, "doc_id long, quality int, text string")


def test_a_certified_cutoff_catches_bad_and_spares_good(spark):
    docs, labels = corpus(spark, 900, 60, 30)
    found = rules.quality_rules(docs, labels).collect()
    assert {r.doc_id for r in found if not r.kept} == set(range(900, 960))
    kept = rules.accepted(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 930


def test_too_few_labels_certify_nothing(spark):
    docs, labels = corpus(spark, 60, 20, 0)
    assert all(r.kept for r in rules.quality_rules(docs, labels).collect())
    assert all(r.kept for r in rules.quality_rules(docs, labels.limit(0)).collect())


def test_strata_are_judged_apart(spark):
    docs, labels = corpus(spark, 900, 60, 0)
    other = docs.filter("doc_id >= 900").withColumn("doc_id", F.col("doc_id") + 10_000).withColumn("lang", F.lit(None).cast("string"))
    found = rules.quality_rules(docs.unionByName(other), labels).collect()
    assert {r.doc_id for r in found if not r.kept} == set(range(900, 960))


def test_edge_cases(spark):
    docs, labels = corpus(spark, 5, 0, 0)
    odd = [(None, None, None, "x"), (7, "", "en", "x"), (7, "", "en", "x"), (8, "a b c d e f g h " * 10, "en", "x")]
    found = rules.quality_rules(docs.unionByName(spark.createDataFrame(odd, docs.schema)), labels).collect()
    assert len(found) == 9 and sorted(str(r.doc_id) for r in found if r.base_failed) == ["7", "7", "8", "None"]
    assert rules.quality_rules(docs.limit(0), labels).count() == 0
    assert rules.accepted(docs.limit(0), labels).count() == 0
