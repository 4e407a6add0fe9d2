"""Mixing sources to target weights: a curriculum that varies over the training run.

A source's weight is a schedule over training time from 0 to 1: its mean weight times a
piecewise linear course of mean 1. Its integral is the source's demand for words up to
a time. Documents of a source stand in a fixed order; the words before a document,
read as demand, give by the inverse of the integral the time at which it is due, and
documents are range-sorted by that position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightline.llm.common import WORD
from sightline.session import stage

#: Mean weights of the sources in code point order, repeating; the share of all words
#: that is taken; how often a source may be read.
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
#: Courses of a weight, repeating like the weights: (time, factor), linear in between.
COURSES = (
    ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),
)
#: Rows in one bucket of a source's order, about.
BUCKET_ROWS = 4000


def size_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def segments(course) -> list[tuple[float, float, float, float, float]]:
    """(time, length, factor, slope, demand before) of each piece, scaled to mean 1."""
    pieces, before = [], 0.0
    for (t0, f0), (t1, f1) in zip(course, course[1:]):
        pieces.append([t0, t1 - t0, f0, (f1 - f0) / (t1 - t0), before])
        before += (f0 + f1) / 2 * (t1 - t0)
    return [(t, d, f / before, s / before, b / before) for t, d, f, s, b in pieces]


def time_of(demand: Column, course) -> Column:
    """The time at which a share ``demand`` of a source is consumed: the inverse integral."""
    value = None
    for t, _, factor, slope, before in reversed(segments(course)):
        rest = demand - F.lit(before)
        if slope:
            root = F.sqrt(F.lit(factor * factor) + F.lit(2 * slope) * rest)
            at = F.lit(t) + (root - F.lit(factor)) / F.lit(slope)
        else:
            at = F.lit(t) + rest / F.lit(factor)
        value = at if value is None else F.when(demand < F.lit(last), at).otherwise(value)
        last = before
    return value


def targets(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, rank, source_size, target, total) per source; the table is small.

    A target is the weight times a level common to all sources, at most ``most`` times
    the source's size. The level is the largest of those that spread what is left over
    the sources not yet at their limit, taken in order of limit by weight.
    """
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    sources = sources.withColumn("rank", rank)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") - 1) % len(weights) + 1)
    sources = sources.withColumn("weight", weight.cast("long"))
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "rank")
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    total = F.sum("source_size").over(everything)
    left = F.lit(share) * total - most * F.coalesce(F.sum("source_size").over(earlier), F.lit(0))
    sources = sources.withColumn("level", left / F.sum("weight").over(after)).withColumn("total", total)
    level = F.max("level").over(everything)
    limit = (most * F.col("source_size")).cast("double")
    return sources.select("source", "rank", "source_size", F.least(limit, F.col("weight") * level).alias("target"), F.col("total"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST, courses=COURSES) -> DataFrame:
    """Per row: ``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``taken``,
    ``position`` and ``last_position``, sorted by position.

    A source is read in a fixed order (md5 of the id as text, then id and size) as often
    as its target asks; reading ends at the target's whole word, so at most one document
    of a source is taken in part. ``position`` is where in the mix, in words, a document
    is due first, ``last_position`` where last; both are null for documents not taken,
    which come last. Null texts have size 0; a null source is a source of its own, last
    in order; a row without an id comes first in its source; repeated rows count each;
    a source without words has target 0; an empty table gives no rows. Of ``docs`` only
    ``doc_id``, ``text`` and ``source`` are read. The order of a source is dealt out by
    ranges of the hash, so a source with a third of all rows is no single task.
    """
    key = F.coalesce(F.md5(F.col("doc_id").cast("string")), F.lit(""))
    rows = docs.select("doc_id", "source", size_of(F.col("text")).alias("size"), key.alias("key"))
    rows = stage(rows, "mixing")
    wanted = stage(targets(rows, weights, share, most), "mixing-targets")
    bits = max(0, (rows.count() // BUCKET_ROWS).bit_length())
    lead = F.conv(F.substring("key", 1, 7), 16, 10).cast("long")
    bucket = F.shiftright(F.coalesce(lead, F.lit(0)), 28 - min(bits, 28)).alias("bucket")
    rows = rows.select("*", bucket)
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source", "bucket", F.coalesce(F.sum("words").over(running), F.lit(0)).alias("base"))
    goal = wanted.select(F.col("source").alias("s"), "rank", "source_size", "target", "total")
    sums = sums.join(goal, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    sums = sums.select(F.col("source").alias("s"), F.col("bucket").alias("b"), "base", "rank", "source_size", "target", "total")
    inside = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    before = F.col("base") + F.col("within")
    rows = rows.select("doc_id", "source", "size", "source_size", "target", "rank", "total", before.alias("before"))

    whole = F.floor("target").cast("long")
    words = F.greatest(F.col("source_size"), F.lit(1))
    passes = (whole - whole % words) / words
    rest = F.greatest(F.lit(0), F.least(F.col("size"), whole % words - F.col("before")))
    taken = (F.col("size") * passes.cast("long") + rest).cast("long")
    last = F.when(rest > 0, passes).otherwise(passes - 1)

    def position(number: Column) -> Column:
        at = (F.col("before") + number * F.col("source_size")) / F.col("target")
        kind = (F.col("rank") - 1) % len(courses)
        value = time_of(at, courses[-1])
        for k in range(len(courses) - 1):
            value = F.when(kind == k, time_of(at, courses[k])).otherwise(value)
        return F.when(F.col("taken") > 0, value * F.lit(share) * F.col("total"))

    rows = rows.withColumn("taken", taken)
    rows = rows.withColumn("position", position(F.lit(0))).withColumn("last_position", position(last))
    out = rows.select("doc_id", "source", "size", "source_size", "target", "taken", "position", "last_position")
    return out.orderBy(F.col("position").asc_nulls_last(), "doc_id")
