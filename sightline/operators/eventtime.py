"""Watermark and lateness of every record.

The watermark is global and per record: the largest event time seen so far, the
record itself included, minus the allowed lateness. A window whose end the
watermark has reached is closed. A record of a closed window still counts while
the watermark is at most its event time plus the allowed lateness.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sightline.functions.times import window_end_us, window_start_us
from sightline.operators.arrival import ranges_of, running_max
from sightline.schemas import ARRIVAL, LATENESS_US, WINDOW_US

ON_TIME = "on_time"
WITHIN = "within_lateness"
LATE = "late"

_DAY_US = 86_400_000_000


def usable(clean: DataFrame) -> DataFrame:
    """Rows whose event time parsed; the others do not move the watermark."""
    return clean.filter(F.col("et_us").isNotNull())


def moving(max_future_us: int | None) -> Column:
    """Event time of a record that may move the watermark, else null.

    One record far in the future would make all later ones late. With ``max_future_us``,
    records further ahead of their own arrival than that leave the watermark where it is;
    they are classified like any other. By default every record moves it.
    """
    et = F.col("et_us")
    if max_future_us is None:
        return et
    return F.when(et <= F.col("arrival_us") + F.lit(max_future_us), et)


def lateness_class(
    et_us: Column, end_us: Column, watermark_us: Column, lateness_us: Column
) -> Column:
    """``on_time``, ``within_lateness`` or ``late`` against the watermark."""
    open_window = watermark_us.isNull() | (watermark_us < end_us) | (et_us >= end_us)
    return (
        F.when(open_window, ON_TIME)
        .when(watermark_us <= et_us + lateness_us, WITHIN)
        .otherwise(LATE)
    )


def window_closed(et_us: Column, end_us: Column, watermark_us: Column) -> Column:
    """Whether the watermark had already closed the record's window."""
    return F.coalesce((et_us < end_us) & (end_us <= watermark_us), F.lit(False))


def with_lateness(
    clean: DataFrame,
    lateness_us: int = LATENESS_US,
    width_us: int = WINDOW_US,
    ranges: int | None = None,
    seed: int | None = None,
    max_future_us: int | None = None,
) -> DataFrame:
    """Add window bounds, ``max_et_us``, ``watermark_us`` and ``lateness``."""
    cuts = ranges_of(usable(clean), ranges)
    rows = with_window(clean, width_us).withColumn("_moving", moving(max_future_us))
    marked = running_max(rows, "_moving", "max_et_us", seed=seed, cuts=cuts).drop("_moving")
    return marked.withColumn("watermark_us", F.col("max_et_us") - F.lit(lateness_us)).withColumn(
        "lateness",
        lateness_class(
            F.col("et_us"), F.col("window_end_us"), F.col("watermark_us"), F.lit(lateness_us)
        ),
    )


def closings(
    clean: DataFrame,
    lateness_us: int = LATENESS_US,
    width_us: int = WINDOW_US,
    more_ends: DataFrame | None = None,
    max_future_us: int | None = None,
) -> DataFrame:
    """For every window end the watermark reached: when, and the watermark then.

    The watermark reaches ``end`` with the first arrival whose event time is at
    least ``end`` plus the lateness. The earliest arrival per window-sized step of
    event time combines on the map side; all that follows runs on about two rows
    per window, cut by day so that not even an event-time span of millennia makes
    one large sort. ``more_ends`` are window ends without a row in ``clean``.
    """
    et = F.col("et_us")
    step = window_start_us(et - F.lit(lateness_us), width_us)
    rows = usable(clean)
    if max_future_us is not None:
        # These close nothing, but their windows are asked for.
        idle = rows.filter(moving(max_future_us).isNull()).select(window_end_us(et, width_us).alias("window_end_us"))
        more_ends = idle if more_ends is None else idle.unionByName(more_ends.select("window_end_us"))
        rows = rows.filter(moving(max_future_us).isNotNull())
    # One long over all rows, in a hash aggregate; only rows of that instant are compared further.
    rows = rows.select(*ARRIVAL, "et_us", step.alias("step"), window_end_us(et, width_us).alias("end"))
    lows = rows.groupBy("step", "end").agg(F.min("arrival_us").alias("low"))
    earliest = F.min(F.struct(*ARRIVAL, "et_us")).alias("first")
    steps = rows.join(lows, ["step", "end"]).filter("arrival_us = low").groupBy("step", "end").agg(earliest)
    reached = F.struct(F.col("step").alias("end_us"), "first")
    asked = F.struct(F.col("end").alias("end_us"), F.lit(None).alias("first"))
    known = steps.select(F.inline(F.array(reached, asked)))
    if more_ends is not None:
        known = known.unionByName(
            more_ends.select(F.col("window_end_us").alias("end_us")), allowMissingColumns=True
        )
    ends = (
        known.groupBy("end_us", F.floor(F.col("end_us") / F.lit(_DAY_US)).alias("_day"))
        .agg(F.min("first").alias("first"))
    )
    later = W.partitionBy(F.lit(0)).orderBy(F.desc("_day")).rowsBetween(W.unboundedPreceding, -1)
    days = (
        ends.groupBy("_day")
        .agg(F.min("first").alias("_first"))
        .select("_day", F.min("_first").over(later).alias("_later"))
    )
    today = W.partitionBy("_day").orderBy(F.desc("end_us")).rowsBetween(W.unboundedPreceding, 0)
    closing = F.least(F.min("first").over(today), F.col("_later"))
    return (
        ends.join(days, "_day")
        .withColumn("closing", closing)
        .filter(F.col("closing").isNotNull())
        .select(
            F.col("end_us").alias("window_end_us"),
            *[F.col(f"closing.{c}").alias(f"closing_{c}") for c in ARRIVAL],
            (F.col("closing.et_us") - F.lit(lateness_us)).alias("closing_watermark_us"),
        )
    )


def with_window(clean: DataFrame, width_us: int = WINDOW_US) -> DataFrame:
    """Usable rows with the bounds of their window."""
    et = F.col("et_us")
    return usable(clean).withColumns(
        {
            "window_start_us": window_start_us(et, width_us),
            "window_end_us": window_end_us(et, width_us),
        }
    )


def in_time() -> Column:
    """Whether a row joined to ``closings`` arrived before its window closed."""
    arrival, seq = (F.col(c) for c in ARRIVAL)
    same = (arrival == F.col("closing_arrival_us")) & (seq < F.col("closing_seq"))
    return (arrival < F.col("closing_arrival_us")) | same


def is_behind(seed: int | None = None, lateness_us: int = LATENESS_US) -> Column:
    """Whether a row joined to ``closings`` on the left is not on time.

    ``seed`` is the largest event time before the table the closings are of: the windows
    it closed are closed for every row.
    """
    behind = F.coalesce(~in_time(), F.lit(False))
    return behind if seed is None else behind | (F.col("window_end_us") <= F.lit(seed - lateness_us))


def behind_watermark(
    clean: DataFrame,
    closed: DataFrame,
    lateness_us: int = LATENESS_US,
    width_us: int = WINDOW_US,
    ranges: int | None = None,
    max_future_us: int | None = None,
    seed: int | None = None,
) -> DataFrame:
    """The rows that are not on time, with their exact watermark and class.

    ``closed`` tells which rows these are without sorting anything, with ``seed`` as in
    ``is_behind``. Only they take their columns through the running maximum; all others
    pass as bare positions.
    """
    rows = with_window(clean, width_us)
    columns = [c for c in rows.columns if c not in (*ARRIVAL, "et_us")]
    behind = is_behind(seed, lateness_us)
    bare = rows.join(closed, "window_end_us", "left").select(
        *ARRIVAL, "et_us", moving(max_future_us).alias("_moving"), F.when(behind, F.struct(*columns)).alias("row")
    )
    cuts = ranges_of(usable(clean), ranges)
    marked = running_max(bare, "_moving", "max_et_us", seed=seed, cuts=cuts).filter(F.col("row").isNotNull())
    watermark = F.col("max_et_us") - F.lit(lateness_us)
    return marked.select(
        *ARRIVAL, "et_us", "row.*", "max_et_us", watermark.alias("watermark_us")
    ).withColumn(
        "lateness",
        lateness_class(
            F.col("et_us"), F.col("window_end_us"), F.col("watermark_us"), F.lit(lateness_us)
        ),
    )
