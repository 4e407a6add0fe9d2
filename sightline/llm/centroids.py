"""Centroid clustering in whole numbers, with nearest centroids by the threshold algorithm.

Every dimension keeps its centroid values sorted. A vector walks each of these lists
outward from its own value; a centroid met for the first time is measured exactly. The
next values the walks would reach, the frontier, bound every centroid not yet met from
below: their squared gaps add up to at most its distance. A vector is done when that sum
strictly exceeds its best exact distance, so that an equally near centroid with a smaller
number is still met, or when all centroids are met.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.session import stage

#: Components beyond it have squared distances that may not fit 64 bits.
LARGEST = 1 << 27
#: Vectors a task walks at a time; the walk holds a few arrays of this many vectors.
ROWS = 4096
_FAR = np.int64(1) << 62


class Lists:
    """The sorted lists of a set of centroids, one a dimension."""

    def __init__(self, centroids: np.ndarray) -> None:
        self.centroids = centroids
        k, dims = centroids.shape
        order = np.argsort(centroids, axis=0, kind="stable")
        edge = np.full((1, dims), -1)
        # Position 0 and k + 1 stand for the ends, which no walk passes.
        self.number = np.vstack([edge, order, edge])
        self.value = np.take_along_axis(centroids, order, axis=0)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest centroid of each vector; of equally near ones the first."""
        n, dims = vectors.shape
        k = len(self.centroids)
        column = np.arange(dims)
        high = np.empty((n, dims), np.int64)
        for j in range(dims):
            high[:, j] = np.searchsorted(self.value[:, j], vectors[:, j]) + 1
        low = high - 1
        best = np.full(n, _FAR)
        winner = np.full(n, k, np.int64)
        met = np.zeros((n, k + 1), bool)
        met[:, k] = True
        active = np.arange(n)
        while len(active):
            at, v = (active[:, None], column), vectors[active]
            below, above = low[at], high[at]
            gap_low = np.where(below > 0, v - self.value[np.maximum(below - 1, 0), column], _FAR)
            gap_high = np.where(above <= k, self.value[np.minimum(above, k) - 1, column] - v, _FAR)
            # The frontier before this step bounds what is not met yet.
            gap = np.minimum(gap_low, gap_high)
            ended = gap == _FAR
            bound = np.where(ended, 0, gap * np.where(ended, 0, gap)).sum(axis=1)
            going = (bound <= best[active]) & ~ended.any(axis=1) & ~met[active].all(axis=1)
            active, below, above = active[going], below[going], above[going]
            if not len(active):
                break
            down = (gap_low <= gap_high)[going]
            reached = self.number[np.where(down, below, above), column]
            new = np.zeros((len(active), k + 1), bool)
            new[np.arange(len(active))[:, None], reached] = True
            new &= ~met[active]
            met[active] |= new
            rows, numbers = np.nonzero(new)
            exact = np.full((len(active), k), _FAR)
            exact[rows, numbers] = ((vectors[active[rows]] - self.centroids[numbers]) ** 2).sum(axis=1)
            number, least = exact.argmin(axis=1), exact.min(axis=1)
            nearer = (least < best[active]) | ((least == best[active]) & (number < winner[active]))
            best[active[nearer]], winner[active[nearer]] = least[nearer], number[nearer]
            at = (active[:, None], column)
            low[at], high[at] = below - down, above + ~down
        return winner, best


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _sums(lists: Lists, dims: int):
    """Per task: a row (cluster, size, sums) for each cluster it has vectors of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(lists.centroids)
        sizes, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = _matrix(batch.column(0).slice(start, ROWS), dims)
                winner, _ = lists.nearest(part)
                np.add.at(sizes, winner, 1)
                np.add.at(sums, winner, part)
        used = np.flatnonzero(sizes)
        if len(used):
            rows = [pa.array(used, pa.int32()), pa.array(sizes[used]), pa.array(sums[used].tolist(), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(rows, names=["cluster", "size", "sums"])

    return run


def _assigned(lists: Lists, dims: int, vector: Column) -> Column:
    kind = T.StructType([T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])

    @F.arrow_udf(kind)
    def of(vectors: pa.Array) -> pa.Array:
        winner, best = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for start in range(0, len(vectors), ROWS):
            numbers, distances = lists.nearest(_matrix(vectors.slice(start, ROWS), dims))
            winner.append(numbers)
            best.append(distances)
        columns = [pa.array(np.concatenate(winner), pa.int32()), pa.array(np.concatenate(best))]
        return pa.StructArray.from_arrays(columns, names=["cluster", "distance"])

    return of(vector)


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """(vec_id, vector): ``floor(scale * x)`` of the vectors with ``dims`` finite components.

    Other rows are left out: null vectors, other lengths, null or non-finite components,
    and components whose whole number is beyond 2^27, as their squared distances do not
    fit the long result.
    """
    x = F.col("x")
    numbers = F.transform(F.col(vector_col), lambda v: v.cast("double"))
    scaled = F.transform("x", lambda v: F.floor(v * F.lit(float(scale))).cast("long"))
    # A null component makes the predicate null, which is no pass.
    usable = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) * scale <= float(LARGEST)))
    picked = rows.select(F.col(id_col).alias("vec_id"), numbers.alias("x"))
    return picked.filter((F.size(x) == dims) & usable).select("vec_id", scaled.alias("vector"))


def starts(vectors: DataFrame, k: int, seed: str) -> np.ndarray:
    """The ``k`` vectors with the smallest hashes of ``seed`` and their ids, in that order.

    Rows that repeat an id follow each other in the order of their components; rows
    without an id come last.
    """
    name = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    picked = vectors.select("vector", name.alias("h")).orderBy(F.col("h").asc_nulls_last(), "vector").limit(k)
    return np.array([r.vector for r in picked.collect()], np.int64)


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: each centroid with vectors becomes their mean, rounded down per component."""
    k, dims = centroids.shape
    tasks = vectors.select("vector").mapInArrow(_sums(Lists(centroids), dims), "cluster int, size long, sums array<long>")
    totals = [F.sum(F.col("sums")[j]).alias(f"s{j}") for j in range(dims)]
    out = centroids.copy()
    for row in tasks.groupBy("cluster").agg(F.sum("size").alias("size"), *totals).collect():
        out[row.cluster] = [row[f"s{j}"] // row.size for j in range(dims)]
    return out


def clusters(
    rows: DataFrame,
    k: int = 16,
    rounds: int = 3,
    dims: int = 64,
    scale: int = 64,
    seed: str = "1:",
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every usable vector, and the final centroids.

    The driver sees ``k`` centroids of ``dims`` numbers a round; tasks sum their own
    vectors first. With fewer than ``k`` usable vectors there are as many centroids as
    vectors; without any there are no rows. Repeated rows are vectors of their own; equal
    distances go to the smaller number; only the two columns named are read.
    """
    vectors = stage(whole_vectors(rows, id_col, vector_col, dims, scale), "centroids")
    centroids = starts(vectors, k, seed).reshape(-1, dims)
    if not len(centroids):
        return vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).limit(0), centroids
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    found = vectors.withColumn("found", _assigned(Lists(centroids), dims, F.col("vector")))
    return found.select("vec_id", "found.cluster", "found.distance"), centroids


def clustering(rows: DataFrame, **options) -> DataFrame:
    """Every usable vector with its cluster, distance, both inertias and its centroid's digest.

    The options are those of ``clusters``, whose docstring has the odd cases.
    """
    found, centroids = clusters(rows, **options)
    found = stage(found, "centroids-found")
    sums = {r.cluster: r.total for r in found.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    inertia = sum(sums.values())
    named = [
        (i, sums.get(i, 0), inertia, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
        for i, c in enumerate(centroids.tolist())
    ]
    kind = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    per_cluster = rows.sparkSession.createDataFrame(named, kind)
    return found.join(F.broadcast(per_cluster), "cluster")
