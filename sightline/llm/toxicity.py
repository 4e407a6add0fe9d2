"""Toxicity: character n-grams scaled by naive Bayes log-count ratios, linear classifier.

N-grams are runs of 4, 6 or 8 bytes of the text in lower case, with every ASCII mark
read as a space, hashed to feature numbers. A feature is present or not. Its value is the
log ratio of its smoothed rates in toxic and other training texts; a logistic regression
on these values learns how far to trust each, with a strong l1 term, so that a few
thousand features have weights and the length of a text does not matter.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.llm import ftrl
from sightline.llm.common import PLAIN, byte_slices, held_out
from sightline.llm.training import FEATURES, Rows, learned, sample, struct_array

#: Lengths of n-grams; feature numbers; labelled documents of each class; the cut-off.
ORDERS, BITS, PER_CLASS, THRESHOLD = (4, 6, 8), 20, 2500, 0.5
_BYTES, _PIECE = 4 << 20, 1 << 18
#: Odd multipliers, one per place in an n-gram.
_MIX = [np.uint32((0x9E3779B1 * (2 * k + 1)) & 0xFFFFFFFF) for k in range(max(ORDERS))]


class Present:
    """Finds the distinct feature numbers of texts, with tables kept between texts."""

    def __init__(self, bits: int) -> None:
        self.bits, self.last = bits, np.zeros(1 << bits, np.int64)
        self.step = 1

    def of(self, text: bytes) -> np.ndarray:
        """Feature numbers, each once, in an order that the text alone decides.

        A long text is read in pieces that share as many bytes as an n-gram needs, so
        none is missed; a number is new if this text has not written it before.
        """
        text = b" " + text.translate(PLAIN) + b" "
        longest, began, found = max(ORDERS), self.step, []
        for start in range(0, max(1, len(text) - longest + 1), _PIECE):
            part = np.frombuffer(text[start : start + _PIECE + longest - 1], np.uint8).astype(np.uint32)
            for order in ORDERS:
                n = len(part) - order + 1
                if n <= 0:
                    continue
                mixed = np.full(n, order, np.uint32)
                for k in range(order):
                    mixed = (mixed ^ part[k : k + n]) * _MIX[k]
                    mixed ^= mixed >> np.uint32(15)
                at = mixed >> np.uint32(32 - self.bits)
                at = at[self.last[at] < began]
                steps = np.arange(self.step, self.step + len(at))
                self.last[at] = steps
                found.append(at[self.last[at] == steps])
                self.step += len(at)
        return np.concatenate(found) if found else np.empty(0, np.uint32)


def _featured(text: Column, bits: int) -> Column:
    @F.arrow_udf(FEATURES)
    def of(texts: pa.Array) -> pa.Array:
        present = Present(bits)
        found = (np.sort(present.of(t)) for run in byte_slices(texts, _BYTES) for t in run)
        return struct_array([(at, np.empty(0)) for at in found])

    return of(text)


def log_count_ratios(rows: Iterable[tuple[np.ndarray, np.ndarray, int]], size: int, smooth: float = 1.0) -> np.ndarray:
    """log(rate in label 1 / rate in label 0) per feature; 0 for features never seen."""
    counts = [np.full(size, smooth), np.full(size, smooth)]
    for at, _, label in rows:
        counts[label][at] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    seen = (counts[0] + counts[1]) > 2 * smooth
    return np.where(seen, ratio, 0.0)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, bits: int = BITS) -> np.ndarray:
    """Weight of each feature's presence (ratio times learned weight), the intercept last.

    Reads at most ``per_class`` documents of each label, none held out. Without both
    labels nothing can be told apart: all weights are 0 and every score is just under
    0.5, so no document is called toxic.
    """
    rows, real = sample(docs, labels, "toxic", per_class)

    def learn(rows: Rows) -> np.ndarray:
        toxic = sum(label for _, _, label in rows)
        if not 0 < toxic < len(rows):
            return np.append(np.zeros(1 << bits), -1e-6)
        ratio = log_count_ratios(rows, 1 << bits)
        weights = ftrl.train(rows.valued(ratio.astype(np.float32)), 1 << bits, epochs=4, alpha=0.1, l1=2.0, l2=0.1)
        weights[-1] += ftrl.prior_shift((len(rows) - toxic, toxic), real)
        weights[:-1] *= ratio
        return weights

    return learned(rows.withColumn("f", _featured(F.col("text"), bits)), 1 << bits, learn)


def score(docs: DataFrame, text: Column, weights: np.ndarray) -> Column:
    """Probability of label 1 as a column for ``docs``; the weights have a fixed size."""
    bits = int(len(weights) - 1).bit_length() - 1
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    @F.arrow_udf(T.DoubleType())
    def of(texts: pa.Array) -> pa.Array:
        w, present, out = shared.value, Present(bits), []
        for run in byte_slices(texts, _BYTES):
            for content in run:
                total = w[present.of(content)].sum(dtype=np.float64)
                out.append(ftrl.sigmoid(float(total) + float(w[-1])))
        return pa.array(out, pa.float64())

    return of(text)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``score`` and ``predicted``.

    Null and empty texts get the score of two spaces, which is about the intercept's.
    Ids may be null (never held out, never learned from) or repeat; each row gives a
    row. Of ``docs`` only ``doc_id`` and ``text`` are read, of ``labels`` ``doc_id`` and
    ``toxic``; labels other than 0 and 1 are ignored.
    """
    value = score(docs, F.col("text"), fit(docs, labels))
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), value.alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are not called toxic, with their columns as they were."""
    weights = fit(docs, labels)
    return docs.filter(score(docs, F.col("text"), weights) < threshold)
