from __future__ import annotations

import random

import model
import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sightline.operators import arrival, hotspot
from sightline.operators.arrival import cut_points, next_in_key, range_id, ranges_of, running_max
from sightline.operators.eventtime import (
    behind_watermark,
    closings,
    lateness_class,
    window_closed,
    with_lateness,
)

L = 120_000_000
CLEAN = (
    "arrival_us bigint, seq bigint, event_id string, user_id string, species_code string, "
    "location_id string, et_us bigint, cnt bigint"
)


def clean(spark, rows):
    names = [part.split()[0] for part in CLEAN.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], CLEAN)


def minutes(clock: str) -> int:
    hour, minute = clock.split(":")
    return (int(hour) * 60 + int(minute)) * model.MINUTE


@pytest.mark.parametrize(
    "mark, want", [("12:14", "on_time"), ("12:15", "within_lateness"), ("12:30", "late"), (None, "on_time")]
)
def test_lateness_policy(spark, mark, want):
    et, end = F.lit(minutes("12:10")), F.lit(minutes("12:15"))
    mark = F.lit(minutes(mark) if mark else None).cast("bigint")
    got = spark.range(1).select(lateness_class(et, end, mark, F.lit(5 * model.MINUTE)).alias("s"),
                                window_closed(et, end, mark).alias("c")).first()
    assert (got.s, got.c) == (want, want != "on_time")


def test_watermark_trails(spark):
    rows = model.random_sightings(random.Random(1), 3, 0)
    got = with_lateness(clean(spark, rows), L).orderBy("seq").collect()
    largest = 0
    for row, source in zip(got, rows):
        largest = max(largest, source["et_us"])
        assert row.watermark_us == largest - L


@pytest.mark.parametrize("ranges", [1, 3, 40])
@pytest.mark.parametrize("ties", [False, True])
def test_running_max_equals_naive_window(spark, ranges, ties):
    rows = model.random_sightings(random.Random(ranges), 400, 3_600_000_000, ties)
    df = clean(spark, rows)
    naive = F.max("et_us").over(W.orderBy("arrival_us", "seq").rowsBetween(W.unboundedPreceding, 0))
    want = {r.seq: r.m for r in df.select("seq", naive.alias("m")).collect()}
    got = running_max(df, "et_us", "m", ranges).select("seq", "m").collect()
    assert {r.seq: r.m for r in got} == want


def test_one_crowded_instant_is_cut(spark):
    df = spark.range(5000).select(F.lit(7).cast("bigint").alias("arrival_us"), F.col("id").alias("seq"))
    cuts = cut_points(df, 8)
    sizes = df.groupBy(range_id(cuts).alias("r")).count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 5000 // 4


@pytest.mark.parametrize("parts, rows_per_range", [(4, 8), (16, 3)])
def test_ranges_beyond_the_literals_are_cut_again(spark, monkeypatch, parts, rows_per_range):
    monkeypatch.setattr(arrival, "MAX_RANGES", 5)
    monkeypatch.setattr(arrival, "MAX_PARTS", parts)
    monkeypatch.setattr(arrival, "ROWS_PER_RANGE", rows_per_range)
    rows = model.random_sightings(random.Random(parts), 300, 3_600_000_000, ties=True)
    df = clean(spark, rows)
    ranges = ranges_of(df)
    sizes = [r["count"] for r in ranges.of(df).groupBy("_range").count().collect()]
    # The literals stay five; the ranges are as many, and as small, as the rows ask for.
    assert len(ranges.cuts) < 5 and len(sizes) > 12 and max(sizes) < 300 // 5
    ordered = ranges.of(df).orderBy("arrival_us", "seq").select("_range").collect()
    assert [r[0] for r in ordered] == sorted(r[0] for r in ordered)
    naive = F.max("et_us").over(W.orderBy("arrival_us", "seq").rowsBetween(W.unboundedPreceding, 0))
    want = {r.seq: r.m for r in df.select("seq", naive.alias("m")).collect()}
    assert {r.seq: r.m for r in running_max(df, "et_us", "m").select("seq", "m").collect()} == want
    keys = ["species_code", "location_id"]
    lead = F.lead("arrival_us").over(W.partitionBy(*keys).orderBy("arrival_us", "seq"))
    following = {r.seq: r.n for r in df.select("seq", lead.alias("n")).collect()}
    got = next_in_key(df, keys, "arrival_us", "n", cuts=ranges).collect()
    assert {r.seq: r.n for r in got} == following


@pytest.mark.parametrize("ranges", [1, 7])
def test_next_in_key_equals_lead(spark, ranges):
    rng = random.Random(3)
    rows = [(rng.choice("aab"), rng.randrange(50), i) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, arrival_us bigint, seq bigint")
    lead = F.lead("arrival_us").over(W.partitionBy("k").orderBy("arrival_us", "seq"))
    want = {r.seq: r.n for r in df.select("seq", lead.alias("n")).collect()}
    got = next_in_key(df, ["k"], "arrival_us", "n", ranges).collect()
    assert {r.seq: r.n for r in got} == want


def panes(df):
    columns = [*hotspot.KEYS, "pane", "event_id", "sighting_count", "unique_birders", "watermark_us"]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.mark.parametrize(
    "seed, lateness, disorder",
    [(1, L, 1_200_000_000), (2, L, 30 * model.MINUTE), (3, 0, 20 * model.MINUTE), (4, 899_000_000, 40 * model.MINUTE), (5, 1_800_000_000, 90 * model.MINUTE)],
)
def test_hotspot_equals_model(spark, seed, lateness, disorder):
    rng = random.Random(seed)
    rows = model.random_sightings(rng, 500, disorder, ties=seed % 2 == 0)
    if seed == 2:
        rows[250]["et_us"] += 10 * 86_400_000_000  # one far-future record makes the rest late
    want_panes, want_late, want_open = model.hotspot(rows, lateness)
    df = clean(spark, rows)
    assert panes(hotspot.hotspot_panes(df, lateness, ranges=5)) == sorted(want_panes, key=str)
    got = behind_watermark(df, closings(df, lateness), lateness, ranges=3).filter("lateness = 'late'")
    late = got.select("event_id", "et_us", "window_end_us", "watermark_us").collect()
    assert sorted(map(tuple, late)) == sorted(want_late)
    opened = hotspot.hotspot_open(df, lateness).select(*hotspot.KEYS, "sighting_count", "unique_birders")
    assert sorted(map(tuple, opened.collect())) == sorted(want_open)
    statuses = with_lateness(df, lateness, ranges=4).groupBy("lateness").count().collect()
    assert {r[0]: r[1] for r in statuses}.get("late", 0) == len(want_late)


@pytest.mark.parametrize("seed", [1, 2])
def test_guarded_watermark_equals_model(spark, seed):
    rng = random.Random(seed)
    rows = model.random_sightings(rng, 300, 30 * model.MINUTE, ties=seed == 2)
    for row in rng.sample(rows, 20) + rows[:2]:
        row["et_us"] += 10 * 86_400_000_000
    guard = 60 * model.MINUTE
    want_panes, want_late, want_open = model.hotspot(rows, L, max_future=guard)
    df = clean(spark, rows)
    # Without the guard nearly all is late; with it the odd records alone stay open.
    assert len(model.hotspot(rows, L)[1]) > 200 > 20 * len(want_late) // 10
    assert panes(hotspot.hotspot_panes(df, L, ranges=5, max_future_us=guard)) == sorted(want_panes, key=str)
    got = behind_watermark(df, closings(df, L, max_future_us=guard), L, ranges=3, max_future_us=guard)
    late = got.filter("lateness = 'late'").select("event_id", "et_us", "window_end_us", "watermark_us").collect()
    assert sorted(map(tuple, late)) == sorted(want_late)
    opened = hotspot.hotspot_open(df, L, max_future_us=guard).select(*hotspot.KEYS, "sighting_count", "unique_birders")
    assert sorted(map(tuple, opened.collect())) == sorted(want_open)
    statuses = {r[0]: r[1] for r in with_lateness(df, L, ranges=4, max_future_us=guard).groupBy("lateness").count().collect()}
    assert statuses.get("late", 0) == len(want_late)


def test_salted_and_plain_totals_agree(spark):
    df = clean(spark, model.random_sightings(random.Random(9), 300, 0))
    plain, salted = hotspot.hotspot_totals(df), hotspot.hotspot_salted(df, salts=3)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, salted.select(plain.columns).collect()))


def test_metric_ids_are_stable_and_distinct(spark):
    df = clean(spark, model.random_sightings(random.Random(2), 300, 30 * model.MINUTE))
    first, again = (
        sorted(r.metric_id for r in hotspot.metric_records(hotspot.hotspot_panes(df)).collect())
        for _ in range(2)
    )
    assert first == again and len(set(first)) == len(first)


def test_rows_behind_in_slices_equal_one_pass(spark):
    """With the largest event time before a slice as seed, as the metric stream runs them."""
    rows = model.random_sightings(random.Random(11), 150, 40 * model.MINUTE)
    of = lambda part, seed: behind_watermark(clean(spark, part), closings(clean(spark, part)), seed=seed)
    wanted = ["seq", "watermark_us", "lateness"]
    whole = sorted(map(tuple, of(rows, None).select(*wanted).collect()))
    found, seed = [], None
    for at in range(0, len(rows), 50):
        part = rows[at : at + 50]
        found += map(tuple, of(part, seed).select(*wanted).collect())
        seed = max([r["et_us"] for r in part] + ([] if seed is None else [seed]))
    assert sorted(found) == whole and len(whole) > 3
