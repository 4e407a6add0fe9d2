"""Ranked lexical search over buckets of impact vectors, ordered by length.

A document's impact vector has, for each query term it holds, the whole number the term
adds to a score; a query is the vector of ones at its terms, so a score is their inner
product. Every task orders its vectors by length and cuts them into buckets of similar
length. A query skips a bucket, and all after it, once the Cauchy-Schwarz bound, the
length of the query times that of the bucket's longest vector, is below its threshold,
the k-th best score known so far. Inside a bucket the largest value of each coordinate
bounds it: the coordinates are read from the largest down until those left over cannot
reach the threshold alone, so a vector none of them touched is out. For the others what
is left is bounded by both the coordinates' largest values and the rest of the vector's
length. Survivors get their exact score, in integers. Bounds are rounded up, and a vector
at the threshold survives, so no result depends on them.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.llm.common import PLAIN, byte_chunks, byte_slices
from sightline.session import stage

#: Bytes of distinct terms in one block of queries, with what a worker's table adds to each.
BLOCK_BYTES, TERM_BYTES = 16 << 20, 100
#: Vectors in a bucket; below the least size it is not cut for the sake of length.
MOST, LEAST, RATIO = 2048, 64, 0.9
#: Longest vectors that are scored first, for the thresholds all tasks begin with.
FIRST = 1024
#: Floating-point bounds are raised by it.
_UP = 1 + 1e-9
_PIECE = 1 << 20
_COUNTED = T.StructType(
    [T.StructField("n", T.LongType()), T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("tfs", T.ArrayType(T.LongType()))]
)
_VECTOR = T.StructType([T.StructField("length", T.DoubleType()), T.StructField("impacts", T.ArrayType(T.LongType()))])


def counts_of(text: bytes) -> Counter[bytes]:
    """Terms of a text with their numbers; a long text is split piece by piece."""
    plain = text.translate(PLAIN)
    if len(plain) <= _PIECE:
        return Counter(plain.split())
    found: Counter[bytes] = Counter()
    for piece in byte_chunks(plain, _PIECE):
        found.update(piece.split())
    return found


def _terms(text: Column) -> Column:
    """Distinct terms of a text."""

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def of(texts: pa.Array) -> pa.Array:
        lists = [[t.decode() for t in counts_of(x)] for run in byte_slices(texts, 4 * _PIECE) for x in run]
        return pa.array(lists, pa.list_(pa.string()))

    return of(text)


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *parts]), kind))


def _counted(vocabulary, text: Column) -> Column:
    """Number of terms of a text, and the query terms among them with their numbers."""

    @F.arrow_udf(_COUNTED)
    def of(texts: pa.Array) -> pa.Array:
        numbers = vocabulary.value
        size, terms, tfs = [], [], []
        for run in byte_slices(texts, 4 * _PIECE):
            for content in run:
                found = counts_of(content)
                size.append(found.total())
                held = sorted((numbers[t], found[t]) for t in found.keys() & numbers.keys())
                pairs = np.array(held, np.int64).reshape(-1, 2)
                terms.append(pairs[:, 0])
                tfs.append(pairs[:, 1])
        columns = [pa.array(size, pa.int64()), _lists(terms, pa.int32()), _lists(tfs, pa.int64())]
        return pa.StructArray.from_arrays(columns, names=["n", "terms", "tfs"])

    return of(text)


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _vectors(weights, documents: int, total: int, counted: list[Column]) -> Column:
    """Impacts of the query terms of a document, and the length of that vector."""

    @F.arrow_udf(_VECTOR)
    def of(n: pa.Array, terms: pa.Array, tfs: pa.Array) -> pa.Array:
        of_term = weights.value
        # Python numbers, as 90 * n * N may pass 64 bits in a corpus of a few very long texts.
        m = np.array([10 + 90 * x * documents // total for x in n.to_pylist()], np.int64)
        ends = terms.offsets.to_numpy() - terms.offsets[0].as_py()
        row = np.repeat(np.arange(len(n)), np.diff(ends))
        tf = tfs.flatten().to_numpy()
        impacts = of_term[terms.flatten().to_numpy()] * (1_000_000_000 * tf // (1000 * tf + 8 * m[row]))
        squares = np.bincount(row, impacts.astype(np.float64) ** 2, len(n))
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(impacts, pa.int64()))
        return pa.StructArray.from_arrays([pa.array(np.sqrt(squares) * _UP), lists], names=["length", "impacts"])

    return of(*counted)


class Bucket:
    """Vectors of similar length by coordinate: who has a term, with which impact."""

    def __init__(self, lengths: np.ndarray, ends: np.ndarray, terms: np.ndarray, impacts: np.ndarray) -> None:
        self.lengths = lengths
        order = np.argsort(terms, kind="stable")
        self.rows = np.repeat(np.arange(len(lengths)), np.diff(ends))[order]
        self.impacts = impacts[order]
        self.terms, starts = np.unique(terms[order], return_index=True)
        self.starts = np.append(starts, len(terms))
        self.most = np.maximum.reduceat(self.impacts, starts) if len(starts) else np.empty(0, np.int64)

    def scores(self, query: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows with a score of at least ``least``, which is above 0, and the exact scores."""
        none = np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.flatnonzero(np.isin(self.terms, query))
        at = at[np.argsort(-self.most[at], kind="stable")]
        # What the coordinates from each one on can add at most.
        left = np.append(np.cumsum(self.most[at][::-1])[::-1], 0)
        if left[0] < least:
            return none
        focus = int(np.argmax(left < least))
        total, squares = np.zeros(len(self.lengths), np.int64), np.zeros(len(self.lengths))
        for k in at[:focus]:
            span = slice(self.starts[k], self.starts[k + 1])
            total[self.rows[span]] += self.impacts[span]
            squares[self.rows[span]] += self.impacts[span].astype(np.float64) ** 2
        rest = np.sqrt(np.maximum(self.lengths**2 * _UP - squares, 0) * (len(at) - focus)) * _UP
        alive = (squares > 0) & (total + np.minimum(rest, left[focus]) >= least)
        if not alive.any():
            return none
        for k in at[focus:]:
            span = slice(self.starts[k], self.starts[k + 1])
            total[self.rows[span]] += self.impacts[span]
        rows = np.flatnonzero(alive & (total >= least))
        return rows, total[rows]


def _cuts(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """Buckets of vectors ordered by falling length."""
    start = 0
    while start < len(lengths):
        similar = int(np.searchsorted(-lengths, -lengths[start] * RATIO, side="right"))
        end = min(max(similar, start + LEAST), start + MOST, len(lengths))
        yield start, end
        start = end


def _scan(queries, thresholds: np.ndarray, k: int):
    """The ``k`` best documents of each query among a task's vectors, longest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = queries.value
        least = np.maximum(thresholds, 1)
        best: list[list] = [[] for _ in wanted]
        roots = np.sqrt([len(q) for q in wanted]) * _UP
        open_ = np.arange(len(wanted))
        id_type = None
        for batch in batches:
            ids, lengths = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
            id_type = ids.type
            ends = batch.column(2).offsets.to_numpy() - batch.column(2).offsets[0].as_py()
            terms, impacts = batch.column(2).flatten().to_numpy(), batch.column(3).flatten().to_numpy()
            for start, end in _cuts(lengths):
                # Lengths only fall from here on and thresholds only rise: what is out stays out.
                open_ = open_[roots[open_] * lengths[start] >= least[open_]]
                if not len(open_):
                    break
                part = slice(ends[start], ends[end])
                bucket = Bucket(lengths[start:end], ends[start : end + 1], terms[part], impacts[part])
                for q in open_:
                    rows, scores = bucket.scores(wanted[q], least[q])
                    if not len(rows):
                        continue
                    if len(rows) > k:
                        near = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
                        rows, scores = rows[near], scores[near]
                    held = ids.take(pa.array(start + rows)).to_pylist()
                    fresh = [(-s, d is None, d) for s, d in zip(scores.tolist(), held)]
                    best[q] = heapq.nsmallest(k, best[q] + fresh)
                    if len(best[q]) == k:
                        least[q] = max(least[q], -best[q][-1][0])
        if id_type is not None and any(best):
            rows = [(q, s, d) for q, found in enumerate(best) for s, _, d in found]
            columns = [pa.array([r[0] for r in rows], pa.int32()), pa.array([-r[1] for r in rows], pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([r[2] for r in rows], id_type)], names=["item", "score", "doc_id"])

    return run


def _blocks(items: DataFrame, limit: int) -> Iterator[tuple[list[tuple], dict[bytes, int]]]:
    """Items with their term numbers, and the numbers, in blocks of bounded size.

    The driver reads item after item and holds one block.
    """
    block: list[tuple] = []
    numbers: dict[bytes, int] = {}
    used = 0
    for row in items.toLocalIterator():
        terms = [t.encode() for t in row.terms]
        more = sum(len(t) + TERM_BYTES for t in terms)
        if block and used + more > limit:
            yield block, numbers
            block, numbers, used = [], {}, 0
        used += more
        block.append((row.item_id, np.array(sorted(numbers.setdefault(t, len(numbers)) for t in terms), np.int32)))
    if block:
        yield block, numbers


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents with a score above 0 of each item.

    All documents count and all are searched. Null and empty texts have no terms; items
    without terms, or none, find nothing, and so does an empty table. Rows that repeat an
    item's id, or have none, are one item of all their terms. Rows that repeat a document
    are documents of their own; equal scores go by ascending id, rows without an id last.
    Only the columns named are read. The queries are a stated set, taken in blocks of
    bounded size: the driver and a worker hold one block, and each block reads the
    documents once.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    asked = items.select(F.col(item_col).alias("item_id"), F.explode(_terms(F.col(item_text_col))).alias("term")).distinct()
    asked = stage(asked.groupBy("item_id").agg(F.sort_array(F.collect_list("term")).alias("terms")), "lexical-items")
    results = [_search(texts, block, numbers, asked.schema["item_id"].dataType, k) for block, numbers in _blocks(asked.orderBy("item_id"), block_bytes)]
    if not results:
        none = asked.join(texts.limit(0), F.lit(False)).select("item_id", F.lit(0).alias("rank"), "doc_id", F.lit(0).cast("long").alias("score"))
        return none.limit(0)
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out


def _search(texts: DataFrame, block: list[tuple], numbers: dict[bytes, int], item_type: T.DataType, k: int) -> DataFrame:
    spark = texts.sparkSession
    send = spark.sparkContext.broadcast
    held = texts.select("doc_id", _counted(send(numbers), F.col("text")).alias("c")).select("doc_id", "c.*")
    held = stage(held.filter("n > 0"), "lexical-counts")
    documents, total = held.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # One number a term of the block.
    holding = {r.term: r.df for r in held.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()}
    weights = np.array([weight(documents, holding.get(t, 0)) for t in range(len(numbers))], np.int64)
    vector = _vectors(send(weights), documents, max(total, 1), [F.col("n"), F.col("terms"), F.col("tfs")])
    made = held.filter(F.size("terms") > 0).select("doc_id", "terms", vector.alias("v"))
    vectors = stage(made.select("doc_id", "v.length", "terms", "v.impacts"), "lexical-vectors")

    queries = send([terms for _, terms in block])
    id_type = vectors.schema["doc_id"].dataType
    kind = f"item int, score long, doc_id {id_type.simpleString()}"
    best_first = F.row_number().over(Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    # One threshold an item: the k-th best score among the longest vectors.
    nothing = np.zeros(len(block), np.int64)
    longest = vectors.orderBy(F.col("length").desc()).limit(FIRST)
    seeds = longest.mapInArrow(_scan(queries, nothing, k), kind).withColumn("rank", best_first).filter(F.col("rank") == k)
    thresholds = nothing.copy()
    for row in seeds.select("item", "score").collect():
        thresholds[row.item] = row.score

    found = vectors.sortWithinPartitions(F.col("length").desc()).mapInArrow(_scan(queries, thresholds, k), kind)
    ranked = found.withColumn("rank", best_first).filter(F.col("rank") <= k)
    schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", item_type)])
    names = F.broadcast(spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block)], schema))
    return ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")
