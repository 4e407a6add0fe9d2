"""Hotspot job on micro-batches, with the per-record watermark of the batch job.

Spark's own watermark moves once per micro-batch and cannot tell a late record
from a late pane. Here every micro-batch is a slice of arrival order, processed
with the state the slices before it left: the largest event time, and the open
windows as one row per window and user, so that distinct users stay exact. The
outputs do not depend on how the arrivals were cut into batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline import schemas as S
from sightline.operators import hotspot, quality
from sightline.operators.eventtime import LATE, behind_watermark, closings, is_behind, moving, usable, with_window
from sightline.session import configure, released_after, stage
from sightline.sources.topics import records, write_topics
from sightline.streaming.state import Versions

_OPEN = {
    "location_id": "string",
    "species_code": "string",
    "window_start_us": "bigint",
    "window_end_us": "bigint",
    "user_id": "string",
    "cnt": hotspot.TOTAL,
}
_LARGEST = {"max_et_us": "bigint"}
_READ = ["event_id", "user_id", "species_code", "location_id", "et_us", "cnt"]


class HotspotStream:
    """``foreachBatch`` handler: call it with (batch of clean rows, batch id).

    Records go to topics below ``folder``, or with ``kafka`` to Kafka, where a repeated
    batch sends the same ids again. ``max_future_us`` guards the watermark.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        lateness_us: int = S.LATENESS_US,
        width_us: int = S.WINDOW_US,
        now: Column | None = None,
        kafka: bool = False,
        max_future_us: int | None = None,
    ) -> None:
        configure(spark)
        self._spark, self._folder, self._now, self._kafka = spark, folder, now, kafka
        self._max_future_us = max_future_us
        self._lateness_us, self._width_us = lateness_us, width_us
        self._open = Versions(spark, f"{folder}/state/open", _OPEN)
        self._largest = Versions(spark, f"{folder}/state/largest", _LARGEST)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        with released_after(self._spark):
            self._process(batch, batch_id)

    def _process(self, batch: DataFrame, batch_id: int) -> None:
        before = self._largest.before(batch_id).first()
        seed = before["max_et_us"] if before else None
        # Only what the outputs read: the text of a record is wider than all of it.
        rows = stage(usable(batch).select(*S.ARRIVAL, *_READ), "hotspot-batch")
        users = [*hotspot.KEYS, "user_id"]
        opened = self._open.before(batch_id)
        ends = opened.select("window_end_us").distinct()
        closed = closings(rows, self._lateness_us, self._width_us, ends, self._max_future_us)
        closed = stage(closed, "hotspot-closings")
        behind = behind_watermark(
            rows, closed, self._lateness_us, self._width_us, max_future_us=self._max_future_us, seed=seed
        )
        behind = stage(behind, "hotspot-behind")
        # The windows the slices before closed stay closed, whatever closes them here.
        on_time = with_window(rows, self._width_us).join(closed, "window_end_us", "left")
        on_time = on_time.filter(~is_behind(seed, self._lateness_us)).select(*users, "cnt")
        merged = on_time.unionByName(opened)
        merged = stage(merged.groupBy(*users).agg(hotspot.summed().alias("cnt")), "hotspot-open")

        main = hotspot.totals(
            merged.join(closed, "window_end_us"), F.max("closing_watermark_us").alias("watermark_us")
        ).withColumns({"pane": F.lit("main"), "event_id": F.lit(None).cast("string")})
        panes = main.unionByName(hotspot.late_panes(behind))
        late = quality.late_signals(behind.filter(F.col("lateness") == LATE), self._now)
        metrics = records(hotspot.metric_records(panes), S.METRICS)
        signals = records(late, S.QUALITY).select("topic", "key", "value")
        out = metrics.unionByName(signals)
        write_topics(out, None if self._kafka else f"{self._folder}/out/batch_id={batch_id}", "overwrite")

        self._open.write(batch_id, merged.join(closed, "window_end_us", "left_anti"))
        largest = F.greatest(F.max(moving(self._max_future_us)), F.lit(seed).cast("bigint")).alias("max_et_us")
        self._largest.write(batch_id, rows.agg(largest).filter("max_et_us IS NOT NULL"))


def hotspot_native(
    clean: DataFrame, lateness_us: int = S.LATENESS_US, width_us: int = S.WINDOW_US
) -> DataFrame:
    """Streaming windows under Spark's own watermark, in append mode.

    Cheaper, and emits on the same rule, but the watermark moves per micro-batch:
    there are no late panes and no late signals, and rows dropped as late depend
    on the batching. Users are counted in two steps, so no row holds a set of them.
    """
    width = f"{width_us} microseconds"
    by_user = (
        clean.withColumn("et", F.timestamp_micros("et_us"))
        .withWatermark("et", f"{lateness_us // 1000} milliseconds")
        .groupBy(F.window("et", width), "location_id", "species_code", hotspot.birder().alias("birder"))
        .agg(hotspot.summed().alias("cnt"))
    )
    return (
        by_user.groupBy(F.window("window", width), "location_id", "species_code")
        .agg(hotspot.summed().alias("sighting_count"), F.count("birder").alias("unique_birders"))
        .select(
            "location_id",
            "species_code",
            F.unix_micros("window.start").alias("window_start_us"),
            F.unix_micros("window.end").alias("window_end_us"),
            "sighting_count",
            "unique_birders",
        )
    )
