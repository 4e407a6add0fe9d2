from __future__ import annotations

import math
import random

from test_eventtime import CLEAN

from sightline.operators import radius
from sightline.operators.radius import alerts_within_radius, last_positions
from sightline.sources.backfill import with_provenance


def haversine(lat1, lng1, lat2, lng2):
    a, b = math.radians(lat2 - lat1) / 2, math.radians(lng2 - lng1) / 2
    h = math.sin(a) ** 2 + math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * math.sin(b) ** 2
    return 2 * 6371.0 * math.asin(min(1.0, math.sqrt(h)))


def test_cells_lose_no_neighbour(spark):
    rng = random.Random(8)
    spots = [(rng.choice([0, 37, -60, 84, -89.7, 89.95]) + rng.uniform(-0.04, 0.04),
              rng.choice([-179.9, 179.9, 0.0, 12.3]) + rng.uniform(-0.09, 0.09)) for _ in range(120)]
    rows = [(i, i, f"e{i}", "finder", "s", f"l{i}", 0, 1, *spot) for i, spot in enumerate(spots)]
    clean = spark.createDataFrame(rows, CLEAN + ", lat double, lng double")
    users = [(f"u{i}", *rng.choice(spots), rng.choice([0.0, 1.0, 7.0, 60.0, 900.0, 21000.0])) for i in range(60)]
    anchors = spark.createDataFrame([u[:3] for u in users], "user_id string, lat double, lng double")
    wanted = spark.createDataFrame(
        [(u[0], "s", "low", u[3]) for u in users],
        "user_id string, species_code string, priority string, radius_km double",
    )
    got = {(r.user_id, r.event_id) for r in alerts_within_radius(clean, wanted, anchors).collect()}
    want = {
        (u, f"e{i}")
        for u, lat, lng, radius in users
        for i, spot in enumerate(spots)
        if haversine(lat, lng, *spot) <= radius
    }
    assert got == want and want


def test_any_radius_is_legal(spark):
    spots = [(0.0, 0.0), (0.0, 179.9), (-89.9, 10.0), (10.0, 20.0)]
    rows = [(i, i, f"e{i}", "finder", "s", f"l{i}", 0, 1, *spot) for i, spot in enumerate(spots)]
    clean = spark.createDataFrame(rows, CLEAN + ", lat double, lng double")
    radii = [20_015.0, 20_016.0, 25_000.0, 40_030.0, 1e6, 1e9, 1e15, math.inf, math.nan, -1.0]
    anchors = spark.createDataFrame([(f"u{i}", 0.0, 0.0) for i in range(len(radii))], "user_id string, lat double, lng double")
    wanted = spark.createDataFrame(
        [(f"u{i}", "s", "low", r) for i, r in enumerate(radii)],
        "user_id string, species_code string, priority string, radius_km double",
    )
    got = {(r.user_id, r.event_id) for r in alerts_within_radius(clean, wanted, anchors).collect()}
    assert got == {(f"u{i}", f"e{k}") for i in range(8) for k in range(4)}


def test_a_crowded_site_alerts_everyone_once(spark):
    rows = [(i, i, f"e{i}", f"u{i % 50}", "s", "l", 0, 1, 5.0, 5.0) for i in range(400)]
    clean = spark.createDataFrame(rows, CLEAN + ", lat double, lng double")
    anchors = spark.createDataFrame([(f"u{i}", 5.0, 5.0) for i in range(60)], "user_id string, lat double, lng double")
    wanted = anchors.selectExpr("user_id", "'s' species_code", "'low' priority", "1.0D radius_km")
    got = {r.user_id: r.event_id for r in alerts_within_radius(clean, wanted, anchors).collect()}
    assert got == {f"u{i}": "e1" if i == 0 else "e0" for i in range(60)}


def test_a_crowded_cell_is_split(spark, monkeypatch):
    """Most sites and users of a species in one cell, some elsewhere."""
    monkeypatch.setattr(radius, "CELL_ROWS", 50)
    rng = random.Random(3)
    near = lambda: (10 + rng.uniform(-0.02, 0.02), 20 + rng.uniform(-0.02, 0.02))
    far = lambda: (rng.uniform(-50, 0), rng.uniform(-50, 0))
    spots = [near() for _ in range(500)] + [far() for _ in range(20)]
    homes = [near() for _ in range(300)] + [far() for _ in range(20)]
    rows = [(i, i, f"e{i}", "finder", "s", f"l{i}", 0, 1, *spot) for i, spot in enumerate(spots)]
    clean = spark.createDataFrame(rows, CLEAN + ", lat double, lng double")
    anchors = spark.createDataFrame([(f"u{i}", *home) for i, home in enumerate(homes)], "user_id string, lat double, lng double")
    wanted = anchors.selectExpr("user_id", "'s' species_code", "'low' priority", "CAST(1.5 AS DOUBLE) radius_km")
    got = {(r.user_id, r.event_id) for r in alerts_within_radius(clean, wanted, anchors).collect()}
    want = {(f"u{i}", f"e{k}") for i, home in enumerate(homes) for k, spot in enumerate(spots) if haversine(*home, *spot) <= 1.5}
    assert got == want and len(want) > 300
    # Every pair of the cell meets in one part, and the parts are alike in size.
    cell = lambda n: spark.range(n).selectExpr("'s' species_code", "0 level", "0L band", "0L cell", "id", "concat('u', id) user_id", "struct(id AS seq, id AS arrival_us) AS first")
    seen, asked = radius._dealt(cell(500), cell(300))
    keys = [*radius._CELL, "_users", "_spots"]
    sizes = [r["count"] for r in seen.select(*keys).join(asked.select(*keys), keys).groupBy(*keys).count().collect()]
    assert sum(sizes) == 500 * 300 and len(sizes) == 60 and max(sizes) < 3 * sorted(sizes)[30]


def test_last_own_position(spark):
    rows = [(5, 1, "a", "u", "s", "l", 0, 1, 1.0, 2.0), (5, 2, "b", "u", "s", "l", 0, 1, 3.0, 4.0),
            (9, 3, "c", "u", "s", "l", 0, 1, None, 4.0), (9, 4, "d", "", "s", "l", 0, 1, 7.0, 4.0)]
    df = spark.createDataFrame(rows, CLEAN + ", lat double, lng double")
    assert [tuple(r) for r in last_positions(df).collect()] == [("u", 3.0, 4.0)]


def test_backfill_keeps_ids_and_derives_missing_ones(spark):
    df = spark.createDataFrame([("e", 1), ("", 2), (None, 2)], "event_id string, n int")
    rows = with_provenance(df, "archive", df["n"]).collect()
    assert rows[0].event_id == "e" and rows[1].event_id == rows[2].event_id != ""
    assert {(r.source, r.provider_record_id) for r in rows} == {("archive", "1"), ("archive", "2")}
