from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sightline.llm import simhash
from sightline.llm.components import components


def plain_fingerprint(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [words[i : i + size] for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(values, max_bits):
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a in values:
        for b in values:
            if (a ^ b).bit_count() <= max_bits:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {v: root(v) for v in values}


TEXTS = [
    "", " \n\t", None, "one", "One\x0btwo", "a b c", "a  b c d", "É é É é", "x " * 500, "the cat sat on the mat " * 3,
]


@pytest.mark.parametrize("size", [1, 3, 5])
def test_fingerprint_is_the_plain_one(size, monkeypatch):
    monkeypatch.setattr(simhash, "SHINGLES", 7)
    monkeypatch.setattr(simhash, "PIECE", 40)
    for text in TEXTS:
        content = (text or "").encode()
        assert simhash.fingerprint_of(content, size) % (1 << 64) == plain_fingerprint(text, size), text


@pytest.mark.parametrize("blocks,max_bits", [(8, 2), (4, 1), (6, 3)])
def test_links_connect_what_brute_force_connects(spark, blocks, max_bits):
    rng = random.Random(blocks)
    values = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(rng.choice([1, 3, 25])):
            value = centre
            for _ in range(rng.choice([0, 1, 2, 3, 4])):
                value ^= 1 << rng.randrange(64)
            values.add(value)
    values = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    rows = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    found = {r.node: r.root for r in components(simhash.links(rows, max_bits, blocks)).collect()}
    unsigned = {v % (1 << 64): v for v in values}
    expected = plain_classes(list(unsigned), max_bits)
    groups = {}
    for v, root in expected.items():
        groups.setdefault(root, []).append(unsigned[v])
    for members in groups.values():
        assert {found.get(v, v) for v in members} == {min(members)}


def test_a_dense_key_is_a_forest():
    members = np.sort(np.random.default_rng(0).choice(1 << 12, 900, replace=False)).astype(np.uint64)
    label = simhash.forest(members, 2, rows=100)
    expected = plain_classes([int(m) for m in members], 2)
    assert [int(members[i]) for i in label] == [expected[int(m)] for m in members]


def test_chain_of_links_is_one_component(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1001), (5, 5), (None, 3)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(201)} | {1000: 1000, 1001: 1000}


ROWS = [
    (3, "a b c d", "x"), (1, "A b C d", "x"), (1, "A b C d", "x"), (7, None, "x"), (5, "", None),
    (None, "a b c d", "y"), (None, "nobody else says this", "y"), (None, "nobody else says this", "y"), (9, "w " * 5000, "y"),
]
SCHEMA = "doc_id long, text string, fingerprint string"


def test_edge_cases(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    found = sorted((str(r.doc_id), str(r.component_id)) for r in simhash.near_duplicates(docs).collect())
    assert found == sorted([("3", "1"), ("1", "1"), ("1", "1"), ("7", "5"), ("5", "5"), ("None", "1"), ("None", "None"), ("None", "None"), ("9", "9")])
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_one_of_each_group_stays(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == ["1", "5", "9", "None"]
    assert simhash.keep_one(docs.limit(0)).count() == 0


def test_a_repeated_id_with_two_texts_keeps_the_right_row(spark):
    docs = spark.createDataFrame([(2, "a b c", "x"), (5, "a b c", "x"), (5, "quite another text here", "x")], SCHEMA)
    assert sorted((r.doc_id, r.text[:5]) for r in simhash.keep_one(docs).collect()) == [(2, "a b c"), (5, "quite")]


def test_hex(spark):
    row = spark.range(1).select(simhash.hex_of(F.lit(-1).cast("long")), simhash.hex_of(F.lit(255).cast("long"))).first()
    assert tuple(row) == ("f" * 16, "0" * 14 + "ff")


def test_an_id_of_two_groups_stays_in_both(spark):
    rows = [(5, "a b c"), (5, "quite another text"), (9, "quite another text"), (7, "a b c"), (5, "a b c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, simhash.keep_one(docs).collect())) == [(5, "a b c"), (5, "quite another text")]


def test_a_linked_group_without_ids_keeps_one_row(spark):
    rows = [(None, "one two three"), (None, "quite another text"), (None, "one two three"), (3, "a b c"), (None, "a b c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert simhash.near_duplicates(docs, max_bits=63, blocks=64).select("component_id").distinct().count() == 1
    nameless = docs.filter("doc_id is null")
    assert simhash.keep_one(nameless, max_bits=63, blocks=64).count() == 1
    assert [r.doc_id for r in simhash.keep_one(docs, max_bits=63, blocks=64).collect()] == [3]


def test_ties_are_kept_by_a_rule(spark):
    """Rows of one id and fingerprint that differ elsewhere: the same one stays in any order."""
    rows = [(1, "a b c d", f"x{k}") for k in range(20)] + [(None, "nobody says this", f"y{k}") for k in range(20)] + [(1, "A b  c d", "x3")]
    schema = "doc_id long, text string, fingerprint string"
    kept = [
        sorted(map(str, map(tuple, simhash.keep_one(spark.createDataFrame(order, schema).repartition(n)).collect())))
        for n, order in ((1, rows), (7, rows[::-1]), (3, rows[10:] + rows[:10]))
    ]
    assert len(kept[0]) == 2 and kept[0] == kept[1] == kept[2]


def test_a_large_key_is_compared_in_bounded_blocks(monkeypatch):
    members = np.sort(np.random.default_rng(1).choice(1 << 14, 3000, replace=False)).astype(np.uint64)
    whole = simhash.forest(members, 2)
    monkeypatch.setattr(simhash, "_COMPARED", 1 << 12)
    assert (simhash.forest(members, 2) == whole).all()


@pytest.mark.parametrize("broadcast", [0, 1 << 16])
def test_components_of_stars_need_no_round(spark, monkeypatch, broadcast):
    from sightline.llm import components as c

    written, stage = [], c.stage
    monkeypatch.setattr(c, "stage", lambda df, label: written.append(label) or stage(df, label))
    monkeypatch.setattr(c, "BROADCAST_NODES", broadcast)
    stars = [(k, k % 7) for k in range(7, 60)] + [(3, 10), (8, 8), (None, 4)]
    found = {r.node: r.root for r in components(spark.createDataFrame(stars, "a long, b long")).collect()}
    assert found == {k: k % 7 for k in range(60)} and len(written) == 1
    chain = [(k, k + 1) for k in range(100, 140)] + [(300, 100), (300, 200), (300, 201), (201, 202)]
    rows = components(spark.createDataFrame(chain, "a long, b long")).collect()
    nodes = [*range(100, 141), 200, 201, 202, 300]
    assert sorted((r.node, r.root) for r in rows) == [(k, 100) for k in nodes]


def test_comparing_a_large_key_takes_little_memory():
    import tracemalloc

    members = np.random.default_rng(5).integers(0, 1 << 16, 3000).astype(np.uint64)
    members = np.unique(members)
    tracemalloc.start()
    label = simhash.forest(members, 2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 << 20
    assert (label == simhash.forest(members, 2, rows=7)).all()
