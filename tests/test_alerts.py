from __future__ import annotations

import random

import model
import pytest
from pyspark.sql import functions as F
from test_eventtime import clean

from sightline.operators import alerts, preferences
from sightline.operators.decode import PREFERENCE_FIELDS, decodable

CHANGES = (
    "user_id string, species_code string, priority string, active boolean, radius_km double, "
    "updated_at string, arrival_us bigint, seq bigint"
)


def change_table(spark, rows):
    names = [part.split()[0] for part in CHANGES.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], CHANGES)


def found(df):
    columns = [*alerts.SUPPRESSION, "event_id", "priority"]
    return sorted(map(tuple, df.select(*columns).collect()))


def case(seed, n=300, changes=60):
    rng = random.Random(seed)
    rows = model.random_sightings(rng, n, 30 * model.MINUTE, ties=True)
    prefs = model.random_changes(rng, changes, rows[0]["arrival_us"], rows[-1]["arrival_us"])
    # Some changes arrive at the very instant of a sighting.
    for change, row in zip(prefs[::4], rows[::9]):
        change["arrival_us"] = row["arrival_us"]
    return rows, prefs


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_alerts_equal_model(spark, seed):
    rows, prefs = case(seed)
    history = preferences.preference_history(change_table(spark, prefs), ranges=4)
    got = found(alerts.alerts_asof(clean(spark, rows), history))
    assert got == sorted(model.alerts(rows, prefs))


def test_oversized_groups_and_large_preferences(spark, monkeypatch):
    monkeypatch.setattr(alerts, "GROUP_ROWS", 5)
    monkeypatch.setattr(alerts, "BLOCK_VERSIONS", 3)
    monkeypatch.setattr(alerts, "CELL_US", 20 * model.MINUTE)
    rows, prefs = case(4)
    history = preferences.preference_history(change_table(spark, prefs), ranges=1)
    got = found(alerts.alerts_asof(clean(spark, rows), history))
    assert got == sorted(model.alerts(rows, prefs))


def test_snapshot_mode(spark):
    rows, prefs = case(5)
    early = [{**p, "arrival_us": 0} for p in sorted(prefs, key=lambda p: (p["arrival_us"], p["seq"]))]
    for i, change in enumerate(early):
        change["seq"] = i
    snapshot = preferences.preference_snapshot(change_table(spark, early))
    got = found(alerts.alerts_snapshot(clean(spark, rows), snapshot))
    assert got == sorted(model.alerts(rows, early))


def test_a_sighting_without_user_is_nobodys_own(spark):
    base = model.random_sightings(random.Random(0), 1, 0)[0]
    rows = [{**base, "user_id": None, "species_code": "s", "location_id": "l"}]
    prefs = [(u, "s", "low", True, 1.0, "", 0, i) for i, u in enumerate(["u1", "u2"])]
    history = preferences.preference_history(spark.createDataFrame(prefs, CHANGES), ranges=1)
    assert {r.user_id for r in alerts.alerts_asof(clean(spark, rows), history).collect()} == {"u1", "u2"}


def test_off_and_on_again_stays_suppressed(spark):
    base = model.random_sightings(random.Random(0), 1, 0)[0]
    rows = [
        {**base, "seq": i, "event_id": f"e{i}", "arrival_us": base["arrival_us"] + i * 1000, "user_id": "u9"}
        for i in range(4)
    ]
    at = base["arrival_us"]
    prefs = [
        {"user_id": "u1", "species_code": base["species_code"], "priority": p, "active": a,
         "radius_km": 0.0, "updated_at": "", "arrival_us": at + d, "seq": 100 + d + 1}
        for p, a, d in [("low", True, 0), ("low", False, 500), ("high", True, 1500)]
    ]
    history = preferences.preference_history(change_table(spark, prefs))
    got = found(alerts.alerts_asof(clean(spark, rows), history))
    assert [g[4:] for g in got] == [("e0", "low")]


def test_preference_decoding(spark):
    texts = [
        '{"user_id":"u","species_code":"a"}',
        '{"user_id":"u","species_code":"b","active":"false","radius_km":"30"}',
        '{"user_id":"u","species_code":"c","active":null,"radius_km":7,"priority":"high"}',
        '{"user_id":"u","species_code":"d","radius_km":null}',
        '{"user_id":"u","species_code":"e","radius_km":"30d"}',
        '{"user_id":"u","species_code":"f","radius_km":[1],"active":false}',
        '{"user_id":null,"species_code":"g"}',
        '{"user_id":"u","species_code":""}',
        '{"user_id":5,"species_code":"h","active":0,"radius_km":true,"priority":null}',
        "oops", "[]", None,
    ]
    rows = [(t.encode() if t else None, 1, i) for i, t in enumerate(texts)]
    log = spark.createDataFrame(rows, "value binary, arrival_us bigint, seq bigint")
    got = preferences.preference_changes(decodable(log, PREFERENCE_FIELDS)).orderBy("seq").collect()
    assert [(r.user_id, r.species_code, r.priority, r.active, r.radius_km) for r in got] == [
        ("u", "a", "medium", True, 0.0),
        ("u", "b", "medium", True, 30.0),
        ("u", "c", "high", False, 7.0),
        ("5", "h", "None", False, 1.0),
    ]


def test_arrival_beats_updated_at(spark):
    base = {"user_id": "u", "species_code": "a", "radius_km": 0.0, "active": True}
    rows = [
        {**base, "priority": "low", "updated_at": "2026-06-01", "arrival_us": 1, "seq": 1},
        {**base, "priority": "high", "updated_at": "2026-01-01", "arrival_us": 2, "seq": 2},
    ]
    assert preferences.preference_snapshot(change_table(spark, rows)).first().priority == "high"


def test_cover_is_exact(spark):
    spans = [(a, b) for a in range(0, 20, 3) for b in range(a, 21)] + [(0, 1000), (999, 1000), (5, 4)]
    frame = spark.createDataFrame(spans, "a bigint, b bigint")
    for a, b, nodes in frame.select("a", "b", alerts._cover(F.col("a"), F.col("b"), 11)).collect():
        cells = [c for n in nodes for c in range(n.node << n.level, (n.node + 1) << n.level)]
        assert sorted(cells) == list(range(a, b + 1)) and len(nodes) <= 22


def test_pairs_evaluated_are_pairs_kept(spark):
    """A popular species whose versions each hold for an hour, and a cold one."""
    hour = alerts.CELL_US
    versions = spark.range(100_000).selectExpr(
        "concat('u', id) AS user_id", "'s' AS species_code", "'low' AS priority",
        f"(id % 1000) * {hour} AS valid_from_us", f"(id % 1000) * {hour} + {hour} AS valid_to_us",
    )
    groups = spark.range(1100).selectExpr(
        "CASE WHEN id < 1000 THEN 's' ELSE 'cold' END AS species_code", "'l' AS location_id", "0L AS window_start_us",
        "id % 1000 AS cell", f"(id % 1000) * {hour} + {hour} - 1 AS last_us", "1L AS rows",
        f"named_struct('arrival_us', (id % 1000) * {hour} + 5, 'seq', id, 'event_id', 'e', 'birder_id', 'b') AS head",
    )
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        assert alerts._pairs(groups, versions).count() == 100_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
