"""First arrival per event id, and the later arrivals.

A record is identified by ``(key, arrival_us, seq)``, which must not repeat: two
sources may use one ``seq`` for different records. The later arrivals are found on
these three columns alone and written out. Usually they are few, so the wide rows
meet them as a broadcast side that Catalyst sizes by the written bytes, and only a
log with many repeats is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.operators.arrival import position
from sightline.schemas import ARRIVAL
from sightline.session import stage


def _later(df: DataFrame, key: str) -> DataFrame:
    """Identities of the later arrivals, written out.

    Only keys that repeat have any. They are found by a count, a hash aggregate over all
    rows that combines on the map side; what follows sees their rows alone. Rows meet the
    first arrivals by key *and* position, so a hot key spreads over all tasks.
    """
    narrow = df.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in ARRIVAL])
    repeated = narrow.groupBy("_key").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("_key").alias("_repeated"))
    rows = stage(narrow.join(repeated, F.col("_key").eqNullSafe(F.col("_repeated")), "left_semi"), "repeated")
    at = position("_arrival_us", "_seq")
    winners = rows.groupBy(F.col("_key").alias("_winner")).agg(F.min(at).alias("first"))
    is_first = F.col("_key").eqNullSafe(F.col("_winner")) & (at == F.col("first"))
    return stage(rows.join(winners, is_first, "left_anti").distinct(), "later-arrivals")


def _same(key: str):
    same = F.col(key).eqNullSafe(F.col("_key"))
    for name in ARRIVAL:
        same = same & (F.col(name) == F.col(f"_{name}"))
    return same


def mark_first(df: DataFrame, key: str = "event_id") -> DataFrame:
    """Add ``is_first``: whether the row is the first arrival of its key."""
    later = _later(df, key).withColumn("_late", F.lit(True))
    marked = df.join(later, _same(key), "left").withColumn("is_first", F.col("_late").isNull())
    return marked.drop("_late", "_key", *[f"_{c}" for c in ARRIVAL])


def dedup_first(df: DataFrame, key: str = "event_id") -> DataFrame:
    """Only the first arrival of every key."""
    return df.join(_later(df, key), _same(key), "left_anti")


def later_arrivals(df: DataFrame, key: str = "event_id") -> DataFrame:
    """Every arrival after the first of its key."""
    return df.join(_later(df, key), _same(key), "left_semi")
