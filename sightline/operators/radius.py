"""Alerts within a radius: a preference matches sightings near its user's anchor.

A preference has no position, so the user is placed at a given table of positions
or at their own last sighting. Candidates meet on grid cells sized to the radius
(an equi-join); the great-circle distance then decides.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sightline.operators.alerts import SUPPRESSION, alertable
from sightline.operators.arrival import position
from sightline.operators.eventtime import usable
from sightline.schemas import ARRIVAL, WINDOW_US
from sightline.session import stage

EARTH_KM = 6371.0
_KM_PER_DEGREE = math.pi * EARTH_KM / 180
# Finest cells are about 5.5 km high; each level doubles that.
_FINEST = 0.05
_TOP_LEVEL = 12
# Half a turn reaches every point: larger radii, infinity included, are cut to it.
_HALF_TURN = 180.0
_LEAST_COSINE = 1e-4
# Sightings, or users, that a cell's part holds at most on average.
CELL_ROWS = 20_000
_CELL = ["species_code", "level", "band", "cell"]


def distance_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle distance (haversine)."""
    half_lat, half_lng = F.radians(lat2 - lat1) / 2, F.radians(lng2 - lng1) / 2
    h = F.pow(F.sin(half_lat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(half_lng), 2
    )
    return 2 * EARTH_KM * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def last_positions(sightings: DataFrame) -> DataFrame:
    """Each user's position at their last own sighting."""
    placed = usable(sightings).filter("user_id <> '' AND lat IS NOT NULL AND lng IS NOT NULL")
    last = [F.max_by(c, position()).alias(c) for c in ("lat", "lng")]
    return placed.groupBy("user_id").agg(*last)


def _height(level: Column) -> Column:
    return F.lit(_FINEST) * F.pow(F.lit(2.0), level)


def _band_cosine(band: Column, level: Column) -> Column:
    """Smallest cosine of latitude within the band, kept off zero at the poles."""
    edge = F.greatest(F.abs(band), F.abs(band + 1)) * _height(level)
    return F.greatest(F.cos(F.radians(F.least(edge, F.lit(90.0)))), F.lit(_LEAST_COSINE))


def _width(band: Column, level: Column) -> Column:
    return F.least(_height(level) / _band_cosine(band, level), F.lit(360.0))


def _anchor_cells(wanted: DataFrame) -> DataFrame:
    """A row per cell the circle around the anchor may touch.

    A negative radius or one that is no number reaches nothing.
    """
    wanted = wanted.filter((F.col("radius_km") >= 0) & ~F.isnan("radius_km"))
    degrees = F.least(F.col("radius_km") / F.lit(_KM_PER_DEGREE), F.lit(_HALF_TURN))
    level = F.ceil(F.log2(F.greatest(degrees, F.lit(_FINEST)) / F.lit(_FINEST))).cast("int")
    lat, lng, height = F.col("anchor_lat"), F.col("anchor_lng"), _height(F.col("level"))
    bands = F.sequence(F.floor((lat - degrees) / height), F.floor((lat + degrees) / height))
    rows = wanted.withColumn("level", F.least(level, F.lit(_TOP_LEVEL)))
    rows = rows.withColumn("band", F.explode(bands))
    # Two points at most a radius apart differ by no more than this in longitude.
    reach = F.sin(F.radians(degrees) / 2) / F.sqrt(
        F.greatest(F.cos(F.radians(lat)), F.lit(_LEAST_COSINE))
        * _band_cosine(F.col("band"), F.col("level"))
    )
    half = F.when((reach >= 1) | (degrees >= _HALF_TURN), _HALF_TURN).otherwise(F.degrees(2 * F.asin(F.least(reach, F.lit(1.0)))))
    # The circle may cross the date line: also look one turn east and west.
    turn = F.explode(F.array(F.lit(-360.0), F.lit(0.0), F.lit(360.0)))
    rows = rows.withColumn("half", half).withColumn("turn", turn)
    rows = rows.withColumn("low", F.greatest(lng + F.col("turn") - F.col("half"), F.lit(-180.0)))
    rows = rows.withColumn("high", F.least(lng + F.col("turn") + F.col("half"), F.lit(180.0)))
    width = _width(F.col("band"), F.col("level"))
    cells = F.sequence(F.floor(F.col("low") / width), F.floor(F.col("high") / width))
    rows = rows.filter("low <= high").withColumn("cell", F.explode(cells))
    return rows.drop("half", "turn", "low", "high").distinct()


def _sighting_cells(placed: DataFrame, levels: list[int]) -> DataFrame:
    """A row per grid level: the cell that holds the sighting."""
    rows = placed.withColumn("level", F.explode(F.array(*[F.lit(level) for level in levels])))
    rows = rows.withColumn("band", F.floor(F.col("lat") / _height(F.col("level"))))
    width = _width(F.col("band"), F.col("level"))
    return rows.withColumn("cell", F.floor(F.col("lng") / width))


def _dealt(sightings: DataFrame, anchors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides of the cells with ``_users`` and ``_spots``, the part of a crowded cell.

    The users of a crowded cell are split by their hash and its sightings by theirs; a
    user asks every part of the sightings, a sighting goes to every part of the users, so
    a pair still meets once and no part grows with the cell. Other cells are one part.
    There is a row for each crowded cell, so few that Catalyst can tell them by their size.
    """
    parts = lambda n: F.ceil(F.col(n) / CELL_ROWS).cast("int")
    users = anchors.groupBy(*_CELL).agg(F.count("*").alias("users"))
    spots = sightings.groupBy(*_CELL).agg(F.count("*").alias("spots"))
    crowded = users.join(spots, _CELL).select(*_CELL, parts("users").alias("_m"), parts("spots").alias("_n"))
    crowded = stage(crowded.filter("_m > 1 OR _n > 1"), "crowded-cells")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.coalesce(F.col(n), F.lit(1)) - 1))
    own = lambda n, *by: F.pmod(F.xxhash64(*by), F.coalesce(F.col(n), F.lit(1))).cast("int")
    seen = sightings.join(crowded, _CELL, "left").withColumn("_users", all_of("_m"))
    seen = seen.withColumn("_spots", own("_n", "first.seq", "first.arrival_us"))
    asked = anchors.join(crowded, _CELL, "left").withColumn("_spots", all_of("_n"))
    return seen.drop("_m", "_n"), asked.withColumn("_users", own("_m", "user_id")).drop("_m", "_n")


def alerts_within_radius(
    clean: DataFrame, snapshot: DataFrame, anchors: DataFrame, width_us: int = WINDOW_US
) -> DataFrame:
    """First sighting within ``radius_km`` per user, species, location and window.

    Sightings at one position are reduced to the first ones of two birders per window
    before they meet the preferences: one of the two is not the user's own, so a
    crowded site is two rows. Cells with many sites or many users are split.
    """
    wanted = snapshot.join(
        anchors.select(
            "user_id", F.col("lat").alias("anchor_lat"), F.col("lng").alias("anchor_lng")
        ),
        "user_id",
    ).select("user_id", "species_code", "priority", "radius_km", "anchor_lat", "anchor_lng")
    keys = [*SUPPRESSION[1:], "birder_id", "lat", "lng"]
    first = F.min(F.struct(*ARRIVAL, "event_id")).alias("first")
    placed = alertable(clean, width_us, "lat", "lng").groupBy(*keys).agg(first)
    placed = placed.filter("lat IS NOT NULL AND lng IS NOT NULL")
    spot = W.partitionBy(*SUPPRESSION[1:], "lat", "lng").orderBy("first.arrival_us", "first.seq")
    placed = placed.withColumn("_n", F.row_number().over(spot)).filter("_n <= 2").drop("_n")
    cells = stage(_anchor_cells(wanted), "anchor-cells")
    # Only the levels some radius needs, of at most thirteen.
    levels = sorted(r["level"] for r in cells.select("level").distinct().collect()) or [0]
    seen, asked = _dealt(stage(_sighting_cells(placed, levels), "sighting-cells"), cells)
    pairs = seen.join(asked, [*_CELL, "_users", "_spots"])
    near = distance_km(*(F.col(c) for c in ("anchor_lat", "anchor_lng", "lat", "lng")))
    hits = pairs.filter((F.col("user_id") != F.col("birder_id")) & (near <= F.col("radius_km")))
    seen = F.min(F.struct("first.arrival_us", "first.seq", "first.event_id", "priority"))
    alerts = hits.groupBy(*SUPPRESSION).agg(seen.alias("seen"))
    return alerts.select(*SUPPRESSION, "seen.*")
