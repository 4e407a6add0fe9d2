from __future__ import annotations

import random
import re

import numpy as np
import pytest

from sightline.llm import minhash


def plain_set(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def plain_roots(sets, percent):
    """Smallest index reachable through links, by comparing all pairs."""
    root = list(range(len(sets)))

    def of(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[max(of(i), of(j))] = min(of(i), of(j))
    return [of(i) for i in range(len(sets))]


def expected(rows, size, percent):
    sets = [plain_set(t, size) for _, t in rows]
    roots = plain_roots(sets, percent)
    ids = {}
    for (i, _), r in zip(rows, roots):
        ids.setdefault(r, []).append(i)
    out = []
    for (i, _), s, r in zip(rows, sets, roots):
        named = [x for x in ids[r] if x is not None]
        component = (min(named) if named else None) if s else i
        out.append((i, len(s), component, i == component))
    return sorted(map(str, out))


def edited(rng, words, vocabulary, edits):
    out = list(words)
    for _ in range(edits):
        out[rng.randrange(len(out))] = rng.choice(vocabulary)
    return out


def made(seed):
    """Groups whose members are chained, spread around a base, or share one passage."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(3000)]
    text = lambda n: rng.choices(vocabulary, k=n)
    out = []
    for _ in range(4):
        base = text(rng.choice([20, 60, 300]))
        out += [edited(rng, base, vocabulary, rng.choice([0, 1, 1, 2, 4, 8])) for _ in range(rng.choice([2, 5, 30]))]
    chain = text(150)
    for _ in range(25):
        chain = edited(rng, chain, vocabulary, 3)
        out.append(chain)
    base = text(120)
    out += [edited(rng, base, vocabulary, 5) for _ in range(60)]
    passage = text(90)
    out += [passage + text(rng.choice([5, 12, 30])) for _ in range(50)]
    out += [text(rng.choice([1, 2, 3, 4, 100])) for _ in range(60)]
    rng.shuffle(out)
    return [(rng.randrange(100_000), " ".join(w)) for w in out]


def found(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, 7, "x") for i, t in rows], "doc_id long, text string, n long, component_id string")
    return sorted(map(str, map(tuple, minhash.near_duplicates(docs, **options).collect())))


@pytest.mark.parametrize("seed,size,percent,cells", [(1, 3, 85, {}), (2, 5, 80, {"half": 8, "partners": 2})])
def test_components_are_those_of_all_pairs(spark, seed, size, percent, cells):
    rows = made(seed)
    rows += rows[:10] + [(i + 200_000, t) for i, t in rows[:10]]
    assert found(spark, rows, shingle=size, percent=percent, **cells) == expected(rows, size, percent)


def test_odd_rows(spark):
    rows = [
        (3, "a b c d"), (1, "A  b\tC d"), (1, "A b C d"), (7, None), (5, ""), (6, " \n"), (None, "a b c d"), (None, "nobody says this"),
        (None, "nobody says this"), (None, None), (9, "w " * 200_000), (8, "w w w w"), (4, "one"), (2, "One"), (11, "one two"), (11, "x y z"),
    ]
    assert found(spark, rows, shingle=3, percent=85) == expected(rows, 3, 85)
    assert found(spark, [], shingle=3, percent=85) == []
    assert found(spark, [(1, None)], shingle=3, percent=85) == [str((1, 0, 1, True))]


def test_a_long_text_is_one_set(monkeypatch):
    text = " ".join(f"W{k % 97} x{k % 31}" for k in range(3000)).encode()
    (whole,) = minhash.shingle_sets([text], 3)
    monkeypatch.setattr(minhash, "_PIECE", 100)
    assert (next(minhash.shingle_sets([text], 3)) == whole).all()
    assert len(whole) == len(plain_set(text.decode(), 3))
    monkeypatch.setattr(minhash, "_BLOCK", 7)
    assert (minhash.signature(whole) == minhash.signature(whole[::-1])).all()


def test_sets_of_texts_hashed_together_are_those_of_each():
    rng = random.Random(9)
    texts = [" ".join(rng.choices(["a", "B", "ab", "ba", "É", "aa"], k=rng.choice([0, 1, 2, 3, 40]))) for _ in range(200)]
    texts += ["\t a\x0bb\r\n c", "", " ", "\x1cx\x85 y", "a\u3000b"]
    together = list(minhash.shingle_sets([t.encode() for t in texts], 3))
    assert len(together) == len(texts)
    seen = {}
    for text, members in zip(texts, together):
        assert (next(minhash.shingle_sets([text.encode()], 3)) == members).all()
        assert len(members) == len(plain_set(text, 3))
        # Equal sets, and only they, have equal hashes.
        assert seen.setdefault(members.tobytes(), plain_set(text, 3)) == plain_set(text, 3)
    assert len(seen) == len({plain_set(t, 3) for t in texts})


def test_signatures_agree_as_often_as_sets():
    rng = np.random.default_rng(3)
    members = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    a, b = minhash.signature(members[:2000], 4096), minhash.signature(members[1000:], 4096)
    assert abs((a == b).mean() - 1 / 3) < 0.03


@pytest.mark.parametrize("coordinates,percent", [(64, 85), (64, 80), (16, 85)])
def test_fewer_matches_are_as_rare_as_stated(coordinates, percent):
    from math import comb

    t, p = minhash.least_matches(coordinates, percent), percent / 100
    chance = lambda t: sum(comb(coordinates, k) * p**k * (1 - p) ** (coordinates - k) for k in range(t))
    assert chance(t) <= minhash.MISS < chance(t + 1)


def test_prefixes_of_sets_with_enough_collisions_meet(spark):
    rng = np.random.default_rng(4)
    sig = rng.integers(0, 3, (60, 8))
    sets = spark.createDataFrame([(i, s.tolist()) for i, s in enumerate(sig)], "id long, sig array<int>")
    for matches in (2, 4, 6):
        lists = {}
        for r in minhash.posts(sets, matches).collect():
            lists.setdefault(r.list, set()).add(r.id)
        for i in range(60):
            for j in range(i):
                if (sig[i] == sig[j]).sum() >= matches:
                    assert any({i, j} <= members for members in lists.values())


def test_turns_of_all_lists_give_each_pair_once():
    rng = np.random.default_rng(6)
    n, k = 60, 6
    sig = rng.integers(0, 2, (n, k))
    prefix = rng.random((n, k)) < 0.7
    masks = (prefix << np.arange(k)).sum(axis=1)
    first = rng.integers(0, 4, n)
    sizes, half = rng.integers(5, 9, n), rng.integers(0, 2, n)
    for split in (False, True):
        seen, turns, leaders = [], 0, set()
        for coordinate in range(k):
            for value in (0, 1):
                members = np.flatnonzero((sig[:, coordinate] == value) & prefix[:, coordinate])
                leader, turn, more = members[0], 0, True
                leaders |= {(leader, m) for m in members}
                while more:
                    columns = [members, *(c[members] for c in (first, first, sizes, half, masks, sig))]
                    same = minhash.Sketches(np.zeros(8 * len(members), np.int64), 8 * np.arange(len(members) + 1))
                    a, b, more = minhash.cell_pairs(*columns, same, leader, coordinate, split, 3 * turn, 3 * turn + 3, 4, 80)
                    seen += list(zip(np.concatenate([[], *a]).astype(int).tolist(), np.concatenate([[], *b]).astype(int).tolist()))
                    turn += 1
                turns = max(turns, turn)
        common = (sig[:, None] == sig[None]) & prefix[:, None] & prefix[None]
        wanted = [
            (i, j)
            for i in range(n)
            for j in range(i + 1, n)
            if first[i] != first[j]
            and common[i, j].any()
            and (sig[i] == sig[j]).sum() >= 4
            and 100 * min(sizes[i], sizes[j]) >= 80 * max(sizes[i], sizes[j])
            and (not split or half[i] != half[j])
        ]
        # A pair is left out only where a leader has met it.
        assert len(seen) == len(set(seen)) and set(seen) <= set(wanted) and turns > 1
        assert {p for p in wanted if p not in set(seen)} <= {tuple(sorted(map(int, p))) for p in leaders}


def test_sketches_never_differ_in_more_bits_than_sets_in_members():
    rng = np.random.default_rng(7)
    pool = rng.integers(0, 1 << 63, 40_000).astype(np.uint64)
    sets = []
    for n in (3, 200, 255, 256, 257, 300, 520, 5000, 8000, 8192, 8200, 16_400, 20_000):
        start = rng.integers(0, 100)
        sets += [np.sort(pool[start : start + n]), np.sort(np.append(pool[start : start + n - 2], pool[-7:]))]
    words = [minhash.odd_sketch(s) for s in sets]
    sketches = minhash.Sketches(np.concatenate(words), np.append(0, np.cumsum([len(w) for w in words])))
    assert sorted({64 * len(w) for w in words}) == [512, 1024, 2048, 16384, 32768]
    filtered = 0
    for i, a in enumerate(sets):
        for j, d in enumerate(sketches.differing(i, np.arange(len(sets)))):
            b = sets[j]
            apart = len(np.setxor1d(a, b))
            similar = 100 * min(len(a), len(b)) >= 85 * max(len(a), len(b))
            assert d <= apart and (d + apart) % 2 == 0 or not similar
            links = 100 * len(np.intersect1d(a, b)) >= 85 * len(np.union1d(a, b))
            assert not links or minhash._may_link(d, len(a) + len(b), 85)
            filtered += similar and not links and not minhash._may_link(d, len(a) + len(b), 85)
    assert filtered > 5


def test_a_turn_takes_only_the_lists_with_more():
    rng = np.random.default_rng(8)
    sig = np.zeros((30, 4), np.int32)
    rows = []
    for name, size in ((7, 5), (9, 20)):
        for i in range(size):
            rows.append({"list": name, "low": 0, "high": 0, "id": i, "first": i, "current": i, "n": 100, "half": 0, "mask": 15, "leader": 0, "sig": sig[i].tolist(), "odd": rng.integers(0, 2, 8).tolist()})
    schema = minhash.pa.schema([(c, minhash.pa.int64()) for c in minhash._CELL.split(", ")[:-2]] + [("sig", minhash.pa.list_(minhash.pa.int32())), ("odd", minhash.pa.list_(minhash.pa.int64()))])
    batch = minhash.pa.RecordBatch.from_pylist(rows, schema)
    left = [r["b"] for out in minhash._cells(0, 8, 4, 85)(iter([batch])) for r in out.to_pylist() if r["a"] is None]
    assert left == [9]
