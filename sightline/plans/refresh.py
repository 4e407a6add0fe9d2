"""Window totals as a table that late records refresh in place.

Clean records and totals are kept in parts of event time. A refresh recomputes only the
windows that got late records: it reads the parts they lie in, of both tables, and
overwrites those parts of the totals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.operators import hotspot
from sightline.operators.eventtime import ON_TIME, usable
from sightline.schemas import WINDOW_US
from sightline.session import stage

PART = "event_part"
DAY_US = 86_400_000_000


def _part(time_us: str, part_us: int, width_us: int) -> Column:
    if part_us % width_us:
        raise ValueError("a part must hold whole windows")
    return F.floor(F.col(time_us) / F.lit(part_us)).cast("bigint")


def _write(df: DataFrame, folder: str, mode: str) -> None:
    writer = df.write.mode(mode).partitionBy(PART).option("partitionOverwriteMode", "dynamic")
    writer.parquet(folder)


def append_clean(clean: DataFrame, folder: str, part_us: int = DAY_US, width_us: int = WINDOW_US) -> None:
    """Add clean records to the table in ``folder``; those without a time are in no window."""
    _write(usable(clean).withColumn(PART, _part("et_us", part_us, width_us)), folder, "append")


def write_totals(clean: DataFrame, folder: str, part_us: int = DAY_US, width_us: int = WINDOW_US) -> None:
    """The totals of all windows, as the table that is refreshed later."""
    totals = hotspot.hotspot_totals(clean, width_us)
    _write(totals.withColumn(PART, _part("window_start_us", part_us, width_us)), folder, "overwrite")


def touched_windows(behind: DataFrame) -> DataFrame:
    """The windows of classified records that were not on time."""
    return behind.filter(F.col("lateness") != ON_TIME).select(*hotspot.KEYS).distinct()


def refresh_totals(clean_folder: str, touched: DataFrame, folder: str, part_us: int = DAY_US, width_us: int = WINDOW_US) -> int:
    """Recompute the touched windows from all their records; returns the number of parts rewritten.

    The driver gets the parts, one number a day by default. Windows of those parts that
    were not touched are copied. Running it again changes nothing, and a run that fails
    leaves whole parts, old or new.
    """
    spark = touched.sparkSession
    touched = stage(touched.withColumn(PART, _part("window_start_us", part_us, width_us)), "touched-windows")
    parts = [r[PART] for r in touched.select(PART).distinct().collect()]
    if not parts:
        return 0
    keys = [*hotspot.KEYS, PART]
    clean = spark.read.parquet(clean_folder).filter(F.col(PART).isin(parts))
    fresh = hotspot.hotspot_totals(clean, width_us).withColumn(PART, _part("window_start_us", part_us, width_us))
    fresh = fresh.join(touched, keys, "left_semi")
    kept = spark.read.parquet(folder).filter(F.col(PART).isin(parts)).join(touched, keys, "left_anti")
    # Written aside first: the parts are read and replaced.
    _write(stage(kept.unionByName(fresh), "refreshed-totals"), folder, "overwrite")
    return len(parts)
