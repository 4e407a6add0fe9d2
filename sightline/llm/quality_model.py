"""Quality classifier: hashed word n-grams, logistic regression by FTRL, sparse scoring.

Words are runs of letters and digits, or runs of other marks, or a line end. Features
are single words and pairs of neighbours; a pair of equal words is written as one
feature whatever the word. Values are log counts, scaled to length one.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.llm import ftrl
from sightline.llm.common import byte_chunks, byte_slices, held_out
from sightline.llm.training import FEATURES, Rows, learned, sample, struct_array

#: Feature numbers; labelled documents read of each class at most; the cut-off.
BITS, PER_CLASS, THRESHOLD = 18, 4000, 0.3
_TOKEN = re.compile(r"[^\W_]+|[^\w\s]+|_+|\n")
_BYTES, _PIECE = 4 << 20, 1 << 20
_SAME = np.uint32(0x5EED)


def _words(text: bytes) -> np.ndarray:
    crc = zlib.crc32
    return np.fromiter((crc(w.encode()) for w in _TOKEN.findall(text.decode())), np.uint32)


def _numbers(words: np.ndarray, before: np.ndarray, bits: int) -> np.ndarray:
    """Feature numbers of the words and of their pairs, the first with ``before`` if there is one."""
    run = np.concatenate([before, words])
    left, right = run[:-1], run[1:]
    pairs = left * np.uint32(0x9E3779B1) ^ right * np.uint32(0x85EBCA77)
    pairs = np.where(left == right, _SAME, pairs)
    both = np.concatenate([words, pairs])
    return (both * np.uint32(0xC2B2AE3D)) >> np.uint32(32 - bits)


def features(text: bytes, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers without repeats, in order, and their values; none for no words.

    A long text is read in pieces that end at white space; the last word of a piece makes
    a pair with the first of the next.
    """
    before = np.empty(0, np.uint32)
    if len(text) <= _PIECE:
        at, n = np.unique(_numbers(_words(text), before, bits), return_counts=True)
    else:
        total = np.zeros(1 << bits, np.int64)
        for piece in byte_chunks(text, _PIECE):
            words = _words(piece)
            total += np.bincount(_numbers(words, before, bits), minlength=1 << bits)
            before = words[-1:] if len(words) else before
        at = np.flatnonzero(total)
        n = total[at]
    if not len(at):
        return at.astype(np.int32), np.empty(0)
    values = np.log1p(n)
    return at.astype(np.int32), values / np.sqrt(values @ values)


def _featured(text: Column, bits: int) -> Column:
    @F.arrow_udf(FEATURES)
    def of(texts: pa.Array) -> pa.Array:
        return struct_array([features(t, bits) for run in byte_slices(texts, _BYTES) for t in run])

    return of(text)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, bits: int = BITS) -> np.ndarray:
    """Weights (the intercept last) learned from labelled rows that are not held out.

    Reads at most ``per_class`` documents of each label. Without any, all weights are 0
    and every score is 0.5.
    """
    rows, real = sample(docs, labels, "quality", per_class)

    def learn(rows: Rows) -> np.ndarray:
        weights = ftrl.train(rows, 1 << bits, epochs=8, alpha=4.0, l1=0.1, l2=0.0)
        good = sum(label for _, _, label in rows)
        weights[-1] += ftrl.prior_shift((len(rows) - good, good), real)
        return weights

    return learned(rows.withColumn("f", _featured(F.col("text"), bits)), 1 << bits, learn)


def score(docs: DataFrame, text: Column, weights: np.ndarray) -> Column:
    """Probability of label 1 as a column for ``docs``; the weights have a fixed size."""
    bits = int(len(weights) - 1).bit_length() - 1
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    @F.arrow_udf(T.DoubleType())
    def of(texts: pa.Array) -> pa.Array:
        w, out = shared.value, []
        for run in byte_slices(texts, _BYTES):
            for content in run:
                at, x = features(content, bits)
                out.append(ftrl.sigmoid(float((w[at] * x).sum()) + float(w[-1])))
        return pa.array(out, pa.float64())

    return of(text)


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``score`` and ``predicted``.

    Null and empty texts, and texts without words, get the score of the intercept. Ids
    may be null (never held out, never learned from) or repeat; each row gives a row.
    Of ``docs`` only ``doc_id`` and ``text`` are read, of ``labels`` ``doc_id`` and
    ``quality``; labels other than 0 and 1 are ignored.
    """
    weights = fit(docs, labels)
    value = score(docs, F.col("text"), weights)
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), value.alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
