from __future__ import annotations

import random

import model
import pytest
from test_eventtime import L, clean

from sightline.operators import hotspot
from sightline.operators.eventtime import with_lateness
from sightline.plans import refresh

HOUR = 3_600_000_000


def table(spark, folder):
    return sorted(map(tuple, spark.read.parquet(folder).select(*hotspot.KEYS, "sighting_count", "unique_birders").collect()))


def test_a_refresh_equals_recomputing_and_touches_only_its_parts(spark, tmp_path):
    rows = model.random_sightings(random.Random(4), 400, 30 * model.MINUTE)
    folder, totals = str(tmp_path / "clean"), str(tmp_path / "totals")
    early, late = rows[:380], rows[380:]
    df = clean(spark, early)
    refresh.append_clean(df, folder, HOUR)
    refresh.write_totals(df, totals, HOUR)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "totals").rglob("*.parquet")}
    assert table(spark, totals) == sorted(map(tuple, hotspot.hotspot_totals(df).select(*hotspot.KEYS, "sighting_count", "unique_birders").collect()))

    more = clean(spark, late)
    refresh.append_clean(more, folder, HOUR)
    touched = with_lateness(more).select(*hotspot.KEYS).distinct()
    parts = refresh.refresh_totals(folder, touched, totals, HOUR)
    whole = hotspot.hotspot_totals(clean(spark, rows)).select(*hotspot.KEYS, "sighting_count", "unique_birders")
    assert table(spark, totals) == sorted(map(tuple, whole.collect()))
    assert 0 < parts < spark.read.parquet(totals).select(refresh.PART).distinct().count()
    # Files of the other parts are as they were; records of those parts are not even read.
    changed = {p for p, at in before.items() if not p.exists()}
    wanted = {f"{refresh.PART}={r[0] // HOUR}" for r in touched.select("window_start_us").collect()}
    assert {p.parent.name for p in changed} == wanted & {p.parent.name for p in before}
    other = next(p for p in (tmp_path / "clean").rglob("*.parquet") if p.parent.name not in wanted)
    other.write_bytes(b"unreadable")
    assert refresh.refresh_totals(folder, touched, totals, HOUR) == parts
    assert table(spark, totals) == sorted(map(tuple, whole.collect()))


def test_nothing_touched_and_windows_that_only_late_records_have(spark, tmp_path):
    rows = model.random_sightings(random.Random(5), 300, 60 * model.MINUTE)
    marked = with_lateness(clean(spark, rows), L)
    folder, totals = str(tmp_path / "clean"), str(tmp_path / "totals")
    refresh.append_clean(clean(spark, rows), folder)
    refresh.write_totals(marked.filter("lateness = 'on_time'"), totals)
    assert refresh.refresh_totals(folder, marked.limit(0).select(*hotspot.KEYS), totals) == 0
    assert refresh.refresh_totals(folder, refresh.touched_windows(marked), totals) >= 1
    whole = hotspot.hotspot_totals(clean(spark, rows)).select(*hotspot.KEYS, "sighting_count", "unique_birders")
    assert table(spark, totals) == sorted(map(tuple, whole.collect()))
    with pytest.raises(ValueError):
        refresh.write_totals(marked, totals, HOUR + 1)
