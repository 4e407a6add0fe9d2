"""The bounded, labelled training sample of a text classifier."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.llm.common import held_out

FEATURES = T.StructType(
    [
        T.StructField("at", T.ArrayType(T.IntegerType())),
        T.StructField("x", T.ArrayType(T.FloatType())),
    ]
)


def labelled(labels: DataFrame, label_col: str) -> DataFrame:
    """(doc_id, label) of training rows: an id, a label of 0 or 1, not held out.

    An id labelled more than once counts once, with its largest label.
    """
    rows = labels.select(F.col("doc_id").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    rows = rows.filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
    return rows.groupBy("doc_id").agg(F.max("label").alias("label"))


def sample(docs: DataFrame, labels: DataFrame, label_col: str, per_class: int) -> tuple[DataFrame, tuple[int, int]]:
    """At most ``per_class`` documents of each label, and how many labels there are of each.

    The ids with the smallest hashes are taken, so the sample does not depend on the
    order of rows. The ids are joined to the texts as a list whose length is bounded. Of
    several texts of an id the one with the smallest hash is read.
    """
    rows = labelled(labels, label_col)
    counts = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [rows.filter(F.col("label") == k).orderBy(*order).limit(per_class) for k in (0, 1)]
    both = F.broadcast(chosen[0].unionByName(chosen[1]))
    texts = docs.select(F.col("doc_id"), F.col("text")).join(both, "doc_id")
    # A row for each id, whatever the number of rows that repeat it.
    one = F.min_by("text", F.struct(F.xxhash64("text"), F.length("text"))).alias("text")
    return texts.groupBy("doc_id", "label").agg(one), (counts.get(0, 0), counts.get(1, 0))


class Rows(Sequence):
    """(feature numbers, values, label) of each row, as views of whole columns."""

    def __init__(self, at: np.ndarray, x: np.ndarray, ends: tuple[np.ndarray, np.ndarray], labels: np.ndarray, order: np.ndarray, scale: np.ndarray | None = None) -> None:
        self._at, self._x, self._ends, self._labels, self._order, self._scale = at, x, ends, labels, order, scale

    def __len__(self) -> int:
        return len(self._order)

    def __getitem__(self, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        row = self._order[k]
        (a, b), (c, d) = (e[row : row + 2] for e in self._ends)
        at = self._at[a:b]
        x = self._x[c:d].astype(float) if self._scale is None else self._scale[at]
        return at, x, int(self._labels[row])

    def valued(self, scale: np.ndarray) -> Rows:
        """The same rows, with the value of a feature looked up in ``scale``."""
        return Rows(self._at, self._x, self._ends, self._labels, self._order, scale)


def rows_of(batches: Iterable[pa.RecordBatch]) -> Rows:
    """Rows of batches (doc_id, label, at, x) in order of id, then features.

    The columns are put together once, in arrays large enough to go back to the system
    when the task is done with them.
    """
    batches = [b for b in batches if b.num_rows]
    if not batches:
        none = np.zeros(1, np.int64)
        return Rows(np.empty(0, np.int32), np.empty(0, np.float32), (none, none), np.empty(0), np.empty(0, np.int64))

    def joined(k: int, flat: bool) -> np.ndarray:
        columns = [b.column(k).flatten() if flat else b.column(k) for b in batches]
        return np.concatenate([c.to_numpy(zero_copy_only=False) for c in columns])

    ids = [i for b in batches for i in b.column(0).to_pylist()]
    sizes = [np.concatenate([b.column(k).value_lengths().to_numpy(zero_copy_only=False) for b in batches]) for k in (2, 3)]
    at, x, labels = joined(2, True), joined(3, True), joined(1, False)
    ends = tuple(np.concatenate([[0], np.cumsum(n, dtype=np.int64)]) for n in sizes)
    order = sorted(range(len(ids)), key=lambda r: (ids[r], sizes[0][r], at[ends[0][r] : ends[0][r] + 1].tolist()))
    return Rows(at, x, ends, labels, np.array(order, np.int64))


def learned(rows: DataFrame, size: int, learn: Callable[[Rows], np.ndarray]) -> np.ndarray:
    """The ``size + 1`` weights that ``learn`` finds from a bounded sample, in one task.

    Expects ``doc_id``, ``label`` and ``f`` (a FEATURES struct). The learners go through
    their rows one after the other, so the sample, whose length is bounded, meets in one
    task; the driver gets the weights that are not zero.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = learn(rows_of(batches)).astype(np.float32)
        # The worker lives on after the task: it gives back what the sample took.
        pa.default_memory_pool().release_unused()
        at = np.flatnonzero(weights).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(weights[at])], names=["at", "w"])

    narrow = rows.select("doc_id", "label", "f.at", "f.x").repartition(1)
    got = narrow.mapInArrow(run, "at int, w float").toArrow()
    if not got.num_rows:  # an empty sample may be planned as no task at all
        return learn(rows_of([])).astype(np.float32)
    weights = np.zeros(size + 1, np.float32)
    weights[got.column("at").to_numpy()] = got.column("w").to_numpy()
    return weights


def struct_array(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.Array:
    """FEATURES structs of (feature numbers, values)."""
    columns = []
    for k, kind in ((0, np.int32), (1, np.float32)):
        offsets = pa.array(np.cumsum([0, *(len(f[k]) for f in found)]), pa.int32())
        values = np.concatenate([np.empty(0, kind), *(f[k].astype(kind) for f in found)])
        columns.append(pa.ListArray.from_arrays(offsets, pa.array(values)))
    return pa.StructArray.from_arrays(columns, ["at", "x"])
