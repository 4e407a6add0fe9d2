"""Cutting a table into ranges of arrival order, and running values over them.

A window over the whole arrival order would pull every row into one task. Here
the order is cut at sampled positions; each range is one window partition, and
what earlier ranges contribute is carried in from a table with one row per range.
The cut points are literals of the plan, or beyond some number of them a written
table, so a retried task sees the same ranges, and they are positions
``(arrival_us, seq)``, so a single crowded instant is cut as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sightline.schemas import ARRIVAL
from sightline.session import once, stage

ROWS_PER_RANGE = 2_000_000
# Cut points that are literals of the plan, and the parts each such range may be cut
# into beyond that: two million million rows before a range has to grow.
MAX_RANGES = 16_384
MAX_PARTS = 64
_SAMPLES_PER_RANGE = 32


def position(arrival_us: str = "arrival_us", seq: str = "seq") -> Column:
    """One number that orders like ``(arrival_us, seq)``.

    Its minimum is a hash aggregate; that of a struct sorts every row first. It holds
    arrivals up to some 170,000 years from 1970.
    """
    step = F.lit(1 << 32).cast("decimal(10,0)")
    high = (F.col(arrival_us).cast("decimal(19,0)") * step).cast("decimal(28,0)")
    return (high * step).cast("decimal(38,0)") + F.col(seq).cast("decimal(19,0)")


def _sampled(positions: DataFrame, rows: int, ranges: int) -> DataFrame:
    """About ``_SAMPLES_PER_RANGE`` positions a range, chosen by hash."""
    buckets = 1 << 30
    wanted = min(1.0, ranges * _SAMPLES_PER_RANGE / rows)
    return positions.filter(F.pmod(F.xxhash64(*ARRIVAL), F.lit(buckets)) < F.lit(int(buckets * wanted)))


def _wanted_ranges(df: DataFrame, rows: int) -> int:
    parallel = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(parallel, -(-rows // ROWS_PER_RANGE))


def cut_points(df: DataFrame, ranges: int | None = None, rows: int | None = None) -> list[tuple[int, int]]:
    """Positions that split ``df`` into ranges of roughly equal row counts.

    The sample only places the cuts. Its size is set by the number of ranges
    (at most 16,384 of them), not by the data.
    """
    positions = df.select(*ARRIVAL)
    rows = positions.count() if rows is None else rows
    ranges = min(_wanted_ranges(df, rows) if ranges is None else ranges, MAX_RANGES)
    if ranges <= 1 or rows == 0:
        return []
    sample = _sampled(positions, rows, ranges).toArrow()
    ordered = sorted(zip(*(sample.column(name).to_pylist() for name in ARRIVAL)))
    cuts = {ordered[len(ordered) * i // ranges] for i in range(1, ranges)} if ordered else set()
    return sorted(cuts)


def _cuts_passed(first: Column, second: Column, cut_first: Column, cut_second: Column, steps: Column) -> Column:
    """Number of cut points at or before a position, found by binary search."""

    def advance(found: Column, step: Column) -> Column:
        probe = found + step
        at_first, at_second = F.get(cut_first, probe - 1), F.get(cut_second, probe - 1)
        reached = (at_first < first) | ((at_first == first) & (at_second <= second))
        return F.when(F.coalesce(reached, F.lit(False)), probe).otherwise(found)

    return F.aggregate(steps, F.lit(0), advance)


def _halvings(most: int) -> Column:
    return F.array(*[F.lit(1 << bit) for bit in reversed(range(max(most, 1).bit_length()))])


def range_id(cuts: list[tuple[int, int]]) -> Column:
    """Number of cut points at or before the row."""
    if not cuts:
        return F.lit(0)

    def literal(at: int) -> Column:
        # Folded to one array literal when the plan is optimised.
        joined = ",".join(str(cut[at]) for cut in cuts)
        return F.split(F.lit(joined), ",").cast("array<bigint>")

    first, second = (F.col(name) for name in ARRIVAL)
    return _cuts_passed(first, second, literal(0), literal(1), _halvings(len(cuts)))


class Ranges:
    """Ranges of arrival order: cut points, and cut points inside each of those ranges.

    Ranges are numbered in order, with ``MAX_PARTS`` numbers for each first-level range.
    """

    def __init__(self, cuts: list[tuple[int, int]], parts: DataFrame | None = None) -> None:
        self.cuts, self.parts = cuts, parts

    @property
    def single(self) -> bool:
        return not self.cuts and self.parts is None

    def of(self, df: DataFrame) -> DataFrame:
        """``df`` with ``_range``."""
        # Below a generator, as Catalyst infers a filter across joins from an alias of lambdas.
        numbered = once(df, {"_range": range_id(self.cuts)})
        if self.parts is None:
            return numbered
        # At most MAX_RANGES rows of MAX_PARTS positions, some 16 MB.
        joined = numbered.join(F.broadcast(self.parts), F.col("_range") == F.col("_upper"), "left")
        first, second = (F.col(name) for name in ARRIVAL)
        part = _cuts_passed(first, second, F.col("_first"), F.col("_second"), _halvings(MAX_PARTS))
        number = F.col("_range") * MAX_PARTS + F.coalesce(part, F.lit(0))
        return joined.withColumn("_range", number).drop("_upper", "_first", "_second")


def ranges_of(df: DataFrame, ranges: int | None = None) -> Ranges:
    """Ranges of at most about ``ROWS_PER_RANGE`` rows, or ``ranges`` of them.

    Beyond ``MAX_RANGES`` each range is cut again at positions sampled inside it, which
    stay in a table with a row per range.
    """
    positions = df.select(*ARRIVAL)
    rows = positions.count()
    wanted = _wanted_ranges(df, rows) if ranges is None else ranges
    cuts = cut_points(df, wanted, rows)
    if wanted <= MAX_RANGES or rows == 0:
        return Ranges(cuts)
    each = min(-(-wanted // MAX_RANGES), MAX_PARTS)
    upper = range_id(cuts).alias("_upper")
    found = _sampled(positions, rows, MAX_RANGES * each).groupBy(upper).agg(F.sort_array(F.collect_list(F.struct(*ARRIVAL))).alias("all"))
    steps = F.transform(F.sequence(F.lit(1), F.lit(each - 1)), lambda i: F.floor(F.size("all") * i / each).cast("int"))
    chosen = F.array_distinct(F.transform(steps, lambda at: F.get("all", at))) if each > 1 else F.array()
    picked = found.select("_upper", chosen.alias("c"))
    parts = picked.select("_upper", F.col(f"c.{ARRIVAL[0]}").alias("_first"), F.col(f"c.{ARRIVAL[1]}").alias("_second"))
    # Written, so that a task that runs again sees the same ranges.
    return Ranges(cuts, stage(parts, "range-parts"))


def _carried(highs: DataFrame, cuts: Ranges) -> DataFrame:
    """The maximum of all ranges before each one."""
    before = lambda *keys: W.partitionBy(*keys).rowsBetween(W.unboundedPreceding, -1)
    if cuts.parts is None:
        earlier = before(F.lit(0)).orderBy("_range")
        return highs.select("_range", F.max("_max").over(earlier).alias("_carried"))
    highs = stage(highs.withColumn("_upper", F.floor(F.col("_range") / MAX_PARTS)), "range-maxima")
    uppers = highs.groupBy("_upper").agg(F.max("_max").alias("_max"))
    uppers = uppers.select("_upper", F.max("_max").over(before(F.lit(0)).orderBy("_upper")).alias("_before"))
    inside = highs.withColumn("_inside", F.max("_max").over(before("_upper").orderBy("_range")))
    # One row per first-level range, at most MAX_RANGES + 1.
    joined = inside.join(F.broadcast(uppers), "_upper")
    return joined.select("_range", F.greatest("_inside", "_before").alias("_carried"))


def running_max(
    df: DataFrame,
    value: str,
    out: str,
    ranges: int | None = None,
    seed: int | None = None,
    cuts: Ranges | None = None,
) -> DataFrame:
    """Add ``out``: the largest ``value`` up to and including each row's arrival.

    ``seed`` is the maximum carried over from before ``df`` starts. Maxima are carried
    from range to range inside each first-level range, and between those.
    """
    cuts = ranges_of(df, ranges) if cuts is None else cuts
    ranged = cuts.of(df)
    carried = _carried(ranged.groupBy("_range").agg(F.max(value).alias("_max")), cuts)
    within = (
        W.partitionBy("_range").orderBy(*ARRIVAL).rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    # One row per range: a bounded broadcast, see MAX_RANGES and MAX_PARTS.
    joined = ranged.join(F.broadcast(carried), "_range", "left")
    known = [F.col("_carried"), F.max(value).over(within)]
    if seed is not None:
        known.append(F.lit(seed))
    return joined.withColumn(out, F.greatest(*known, F.lit(None).cast("bigint"))).drop(
        "_range", "_carried"
    )


def next_in_key(
    df: DataFrame,
    keys: list[str],
    value: str,
    out: str,
    ranges: int | None = None,
    cuts: Ranges | None = None,
) -> DataFrame:
    """Add ``out``: ``value`` of the key's next row in arrival order, null at its end.

    A key's rows are split at the arrival cuts, so a hot key is many window
    partitions; the first row of each part is looked up for the part before it.
    """
    cuts = ranges_of(df, ranges) if cuts is None else cuts
    within = W.partitionBy(*keys, "_range").orderBy(*ARRIVAL)
    ranged = cuts.of(df)
    inside = ranged.withColumn("_next", F.lead(value).over(within))
    if cuts.single:
        return inside.withColumnRenamed("_next", out).drop("_range")
    parts = W.partitionBy(*keys).orderBy("_range")
    heads = (
        ranged.groupBy(*keys, "_range")
        .agg(F.min_by(value, position()).alias("_head"))
        .select(*keys, "_range", F.lead("_head").over(parts).alias("_after"))
    )
    return (
        inside.join(heads, [*keys, "_range"], "left")
        .withColumn(out, F.coalesce("_next", "_after"))
        .drop("_range", "_next", "_after")
    )
