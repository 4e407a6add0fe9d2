from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from sightline.llm import centroids


def plain_clusters(rows, k, rounds, dims, scale=64, seed="1:"):
    kept = [
        (i, [math.floor(scale * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    hashed = [(hashlib.sha256(f"{seed}{i}".encode()).hexdigest() if i is not None else "~", v) for i, v in kept]
    current = [v for _, v in sorted(hashed)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(current))

    for _ in range(rounds):
        of = [nearest(v)[1] for _, v in kept]
        for n in range(len(current)):
            mine = [v for (_, v), c in zip(kept, of) if c == n]
            if mine:
                current[n] = [sum(x) // len(mine) for x in zip(*mine)]
    return [(i, *nearest(v)[::-1]) for i, v in kept], current


@pytest.mark.parametrize("dims,k,spread", [(1, 3, 4), (4, 5, 3), (64, 16, 50), (8, 1, 10), (3, 40, 2)])
def test_the_walk_finds_the_nearest_and_the_first_of_equals(dims, k, spread):
    rng = np.random.default_rng(dims)
    made = rng.integers(-spread, spread, (k, dims))
    made[k // 2] = made[0]  # two centroids in one place
    vectors = np.vstack([rng.integers(-2 * spread, 2 * spread, (300, dims)), made])
    number, distance = centroids.Lists(made).nearest(vectors)
    exact = ((vectors[:, None] - made[None]) ** 2).sum(axis=2)
    assert (distance == exact.min(axis=1)).all()
    assert (number == exact.argmin(axis=1)).all()


def test_the_walk_stops_early():
    measured = []

    class Counted(np.ndarray):
        def __getitem__(self, at):
            measured.append(np.size(at))
            return np.asarray(super().__getitem__(at))

    made = np.array([[10 * i, 10 * i] for i in range(100)])
    lists = centroids.Lists(made)
    lists.centroids = made.view(Counted)
    vectors = made + 1
    number, distance = lists.nearest(vectors)
    assert (number == np.arange(100)).all() and (distance == 2).all()
    # Two or three centroids a vector of one hundred.
    assert sum(measured) <= 3 * len(vectors)


def rows_of(spark, rows, extra="x"):
    return spark.createDataFrame([(i, v, extra) for i, v in rows], "vec_id long, embedding array<float>, cluster string")


def test_rounds_agree_with_a_plain_version(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=4)]) for i in range(300)]
    rows += rows[:20]  # repeated rows
    rows += [(900, None), (901, [1.0, 2.0]), (902, [1.0, None, 0.0, 0.0]), (903, [float("nan"), 0.0, 0.0, 0.0]), (904, [float("inf"), 0.0, 0.0, 0.0]), (None, [0.0, 0.5, -0.5, 0.25])]
    found, final = centroids.clusters(rows_of(spark, rows), k=7, rounds=3, dims=4)
    expected, plain = plain_clusters(rows, 7, 3, 4)
    assert final.tolist() == plain
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected))


def test_sums_and_digests(spark):
    rows = [(1, [0.0, 0.0]), (2, [0.0, 1.0]), (3, [5.0, 5.0]), (4, [5.0, 5.5])]
    out = centroids.clustering(rows_of(spark, rows), k=2, rounds=2, dims=2).collect()
    expected, final = plain_clusters(rows, 2, 2, 2)
    per = {c: sum(d for _, n, d in expected if n == c) for c in (0, 1)}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in final]
    assert sorted(map(tuple, ((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in out))) == [
        (i, c, d, per[c], sum(per.values()), digest[c]) for i, c, d in expected
    ]


def test_few_and_no_vectors(spark):
    few = rows_of(spark, [(1, [0.0, 1.0]), (2, [3.0, 4.0])])
    assert {(r.vec_id, r.distance) for r in centroids.clustering(few, k=16, dims=2).collect()} == {(1, 0), (2, 0)}
    for none in (few.limit(0), rows_of(spark, [(1, None), (2, [1e30, 0.0])])):
        out = centroids.clustering(none, k=16, dims=2)
        assert out.count() == 0 and "centroid_sha256" in out.columns


def test_empty_centroids_stay():
    # Equal vectors: the first of equal centroids takes all, the others keep their place.
    made = np.array([[1, 1], [1, 1], [9, 9]])
    number, _ = centroids.Lists(made).nearest(np.array([[1, 1], [2, 2], [8, 8]]))
    assert number.tolist() == [0, 0, 2]
