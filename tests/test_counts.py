from __future__ import annotations

from pyspark.sql import functions as F
from test_eventtime import CLEAN

from sightline.operators import hotspot
from sightline.operators.eventtime import behind_watermark, closings, with_window
from sightline.operators.quality import heavy_keys, hot_keys

HUGE = 10**37


def rows(spark, *counts):
    table = [(i, i, f"e{i}", f"u{i % 2}", "s", "l", 0, str(c)) for i, c in enumerate(counts)]
    frame = spark.createDataFrame(table, CLEAN.replace("cnt bigint", "cnt string"))
    return frame.withColumn("cnt", frame.cnt.cast("decimal(38,0)"))


def test_sums_beyond_64_bits(spark):
    big = 2**63 - 1
    for totals in (hotspot.hotspot_totals, hotspot.hotspot_salted):
        row = totals(rows(spark, big, big, HUGE)).first()
        assert (int(row.sighting_count), row.unique_birders) == (2 * big + HUGE, 2)


def test_a_sum_beyond_38_digits_is_null_and_no_error(spark):
    assert hotspot.hotspot_totals(rows(spark, *[9 * HUGE] * 12)).first().sighting_count is None


def test_heavy_keys_are_the_exact_ones(spark):
    """A tenth, a hundredth and just under it, among many keys of a few rows each."""
    rows = spark.range(200_000).selectExpr(
        """CASE WHEN id % 10 = 0 THEN 'hot' WHEN id % 100 = 1 THEN 'warm' WHEN id % 100 = 2 AND id > 1000 THEN 'below'
           WHEN id % 1000 = 3 THEN NULL ELSE concat('cold', id % 40000) END AS a""",
        "CASE WHEN id % 20 = 0 THEN 'x' ELSE 'y' END AS b",
    )
    counts = rows.groupBy("a", "b").count().collect()
    for keys, share_ppm in ((["a"], 10_000), (["a", "b"], 10_000), (["a"], 900), (["a"], 500_000)):
        exact = {}
        for r in counts:
            key = tuple(r[k] for k in keys)
            exact[key] = exact.get(key, 0) + r["count"]
        want = {k: n for k, n in exact.items() if n * 1_000_000 >= share_ppm * 200_000}
        got = hot_keys(rows, keys, share_ppm).collect()
        assert {tuple(r[k] for k in keys): r.n for r in got} == want
        assert all(r.share_ppm == r.n * 5 for r in got)
    assert hot_keys(rows.limit(0), ["a"]).count() == 0


def test_only_hot_keys_are_salted(spark):
    rows = spark.range(60_000).selectExpr(
        "id AS arrival_us", "id AS seq", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('l', id % 5000) END AS location_id",
        "'s' AS species_code", "concat('u', id % 977) AS user_id", "id * 1000 AS et_us", "1L AS cnt",
    )
    plain, salted = hotspot.hotspot_totals(rows), hotspot.hotspot_salted_hot(rows, salts=8)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, salted.select(plain.columns).collect()))
    heavy, total = heavy_keys(rows, ["location_id", "species_code"], 10_000)
    assert total == 60_000 and heavy == ['["hot","s"]']


def test_sketches_of_panes_add_up(spark):
    """Main and late panes of large windows, and of all windows of a location."""
    rows = spark.range(120_000).selectExpr(
        "id AS arrival_us", "id AS seq", "concat('e', id) AS event_id", "concat('l', id % 2) AS location_id", "'s' AS species_code",
        "CASE WHEN id % 50 = 0 THEN '' ELSE concat('u', hash(id) % 30000) END AS user_id",
        # Every 40th record comes after its window closed, but within the lateness.
        "id * 30000 - CASE WHEN id % 40 = 0 THEN 1700000000 ELSE 0 END + 1800000000 AS et_us", "1L AS cnt",
    )
    lateness = 1_000_000_000
    panes = hotspot.sketched_panes(rows, lateness, ranges=4)
    exact = hotspot.hotspot_panes(rows, lateness, ranges=4)
    assert panes.filter("pane = 'late'").count() == exact.filter("pane = 'late'").count() > 500
    closed = closings(rows, lateness)
    late = behind_watermark(rows, closed, lateness, ranges=4).filter("lateness = 'late'").select("seq")
    kept = with_window(rows).join(late, "seq", "left_anti").join(closed, "window_end_us")
    for keys in (hotspot.KEYS, ["location_id"]):
        want = kept.groupBy(*keys).agg(F.count("*").alias("n"), F.count_distinct(hotspot.birder()).alias("users"))
        got = hotspot.merged_birders(panes, *keys).join(want, keys).collect()
        assert len(got) == want.count() > 0
        for r in got:
            assert r.sighting_count == r.n
            assert abs(r.birders_estimate - r.users) <= 4 * 1.04 / 64 * r.users + 1
    # The birders of main and late panes themselves do not add up.
    one = exact.groupBy("location_id").agg(F.sum("unique_birders").alias("n")).first().n
    assert one > kept.filter("location_id = 'l0'").select("user_id").distinct().count()
