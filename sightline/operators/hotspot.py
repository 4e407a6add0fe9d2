"""Hotspot metrics per location, species and 15-minute event-time window.

A window is emitted once, as its ``main`` pane, when the watermark reaches its
end. A record within the allowed lateness afterwards is a ``late`` pane of its
own: a delta to add to the count, not a replacement.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.functions.ids import stable_id
from sightline.functions.times import iso_z
from sightline.operators.eventtime import (
    WITHIN,
    behind_watermark,
    closings,
    in_time,
    moving,
    with_window,
)
from sightline.operators.quality import heavy_keys, is_heavy
from sightline.schemas import ARRIVAL, LATENESS_US, WINDOW_US
from sightline.session import stage

# Counts are integers of up to 38 digits; a sum beyond that is null, not an error.
TOTAL = "decimal(38,0)"

# Sketches of birders have 2 ** SKETCH_BITS registers: an error of 1.6 %.
SKETCH_BITS = 12

KEYS = ["location_id", "species_code", "window_start_us", "window_end_us"]


def birder() -> Column:
    """User who counts as a birder: an empty id does not."""
    return F.nullif(F.col("user_id"), F.lit(""))


def summed(count: str = "cnt") -> Column:
    return F.try_sum(F.col(count).cast(TOTAL))


def totals(rows: DataFrame, *extra: Column) -> DataFrame:
    """Summed counts and exact distinct birders per window.

    Spark aggregates per window *and* user first, so a hot window spreads over
    its users before the final, small aggregation.
    """
    return rows.groupBy(*KEYS).agg(
        summed().alias("sighting_count"),
        F.count_distinct(birder()).alias("unique_birders"),
        *extra,
    )


def hotspot_totals(clean: DataFrame, width_us: int = WINDOW_US) -> DataFrame:
    """Complete totals of every window, lateness ignored."""
    return totals(with_window(clean, width_us))


def hotspot_salted(clean: DataFrame, salts: int = 16, width_us: int = WINDOW_US) -> DataFrame:
    """The same totals in two explicit phases, salted by user.

    A user belongs to one salt, so the distinct counts of the salts add up.
    """
    salt = F.pmod(F.xxhash64("user_id"), F.lit(salts)).alias("salt")
    partial = (
        with_window(clean, width_us)
        .groupBy(*KEYS, salt)
        .agg(summed().alias("part"), F.count_distinct(birder()).alias("users"))
    )
    return partial.groupBy(*KEYS).agg(
        summed("part").alias("sighting_count"), F.sum("users").alias("unique_birders")
    )


def hotspot_salted_hot(
    clean: DataFrame, share_ppm: int = 10_000, salts: int = 16, width_us: int = WINDOW_US
) -> DataFrame:
    """The same totals, salted only for locations and species with a large share of the rows.

    The other windows are complete after one aggregation; the second then gets one row of
    each.
    """
    spot = KEYS[:2]
    heavy, _ = heavy_keys(clean, spot, share_ppm)
    salt = F.when(is_heavy(spot, heavy), F.pmod(F.xxhash64("user_id"), F.lit(salts))).otherwise(0)
    partial = (
        with_window(clean, width_us)
        .groupBy(*KEYS, salt.alias("salt"))
        .agg(summed().alias("part"), F.count_distinct(birder()).alias("users"))
    )
    return partial.groupBy(*KEYS).agg(
        summed("part").alias("sighting_count"), F.sum("users").alias("unique_birders")
    )


def main_panes(clean: DataFrame, closed: DataFrame, width_us: int = WINDOW_US) -> DataFrame:
    """On-time records of every closed window, emitted once."""
    on_time = with_window(clean, width_us).join(closed, "window_end_us").filter(in_time())
    return totals(on_time, F.max("closing_watermark_us").alias("watermark_us")).select(
        *KEYS,
        F.lit("main").alias("pane"),
        F.lit(None).cast("string").alias("event_id"),
        "sighting_count",
        "unique_birders",
        "watermark_us",
    )


def late_panes(behind: DataFrame) -> DataFrame:
    """One delta row for every record within the allowed lateness."""
    return behind.filter(F.col("lateness") == WITHIN).select(
        *KEYS,
        F.lit("late").alias("pane"),
        "event_id",
        F.col("cnt").cast(TOTAL).alias("sighting_count"),
        birder().isNotNull().cast("bigint").alias("unique_birders"),
        "watermark_us",
    )


def hotspot_panes(
    clean: DataFrame,
    lateness_us: int = LATENESS_US,
    width_us: int = WINDOW_US,
    ranges: int | None = None,
    max_future_us: int | None = None,
) -> DataFrame:
    """Every emission: main panes and late deltas. ``max_future_us``: see ``moving``."""
    closed = stage(closings(clean, lateness_us, width_us, max_future_us=max_future_us), "closings")
    behind = behind_watermark(clean, closed, lateness_us, width_us, ranges, max_future_us)
    return main_panes(clean, closed, width_us).unionByName(late_panes(behind))


def sketched_panes(
    clean: DataFrame,
    lateness_us: int = LATENESS_US,
    width_us: int = WINDOW_US,
    ranges: int | None = None,
    precision: int = SKETCH_BITS,
) -> DataFrame:
    """Every emission, with a mergeable sketch of its birders in place of their number.

    Exact counts of birders do not add up: a birder of a late record may be in the main
    pane. Sketches do, see ``merged_birders``. A sketch has a bounded size and combines on
    the map side, so no row per window and user is shuffled.
    """
    closed = stage(closings(clean, lateness_us, width_us), "closings")
    sketch = F.hll_sketch_agg(birder(), precision).alias("birders")
    on_time = with_window(clean, width_us).join(closed, "window_end_us").filter(in_time())
    main = on_time.groupBy(*KEYS).agg(summed().alias("sighting_count"), sketch, F.max("closing_watermark_us").alias("watermark_us"))
    main = main.withColumns({"pane": F.lit("main"), "event_id": F.lit(None).cast("string")})
    behind = behind_watermark(clean, closed, lateness_us, width_us, ranges).filter(F.col("lateness") == WITHIN)
    late = behind.groupBy(*KEYS, *ARRIVAL, "event_id", "watermark_us").agg(summed().alias("sighting_count"), sketch)
    return main.unionByName(late.withColumn("pane", F.lit("late")).drop(*ARRIVAL))


def merged_birders(panes: DataFrame, *keys: str) -> DataFrame:
    """Counts and approximate birders of all panes of a key, by default of a window.

    Any coarser key does as well: a location, a species, a day of windows. The relative
    standard error is about ``1.04 / sqrt(2 ** precision)``; a few hundred are exact.
    """
    return panes.groupBy(*(keys or KEYS)).agg(
        summed("sighting_count").alias("sighting_count"),
        F.hll_sketch_estimate(F.hll_union_agg("birders")).alias("birders_estimate"),
    )


def hotspot_open(
    clean: DataFrame,
    lateness_us: int = LATENESS_US,
    width_us: int = WINDOW_US,
    max_future_us: int | None = None,
) -> DataFrame:
    """Windows the watermark has not reached; they are not emitted.

    The watermark was never at their end, so all their records are on time.
    """
    last = clean.agg((F.max(moving(max_future_us)) - F.lit(lateness_us)).alias("w")).scalar()
    unreached = F.coalesce(F.col("window_end_us") > last, F.lit(True))
    return totals(with_window(clean, width_us).filter(unreached))


def metric_records(panes: DataFrame) -> DataFrame:
    """Output records with replay-stable ids; ``pane`` is an extra field."""
    keys = [F.col(k) for k in KEYS[:3]]
    return panes.select(
        F.col("location_id").alias("key"),
        stable_id("hm_", *keys, F.col("pane"), F.col("event_id")).alias("metric_id"),
        "location_id",
        "species_code",
        iso_z(F.col("window_start_us")).alias("window_start"),
        iso_z(F.col("window_end_us")).alias("window_end"),
        "sighting_count",
        "unique_birders",
        iso_z(F.col("watermark_us")).alias("watermark_at_emit"),
        "pane",
    )


def late_refresh_diff(
    clean: DataFrame, panes: DataFrame, width_us: int = WINDOW_US
) -> DataFrame:
    """Recomputed windows, late records included, against the emitted panes."""
    full = hotspot_totals(clean, width_us).withColumnRenamed("sighting_count", "full_count")
    emitted = panes.groupBy(*KEYS).agg(summed("sighting_count").alias("emitted_count"))
    joined = full.drop("unique_birders").join(emitted, KEYS, "full_outer")
    missing = F.coalesce("full_count", F.lit(0)) - F.coalesce("emitted_count", F.lit(0))
    missing = missing.cast(TOTAL)
    return joined.withColumn("missing", missing)
