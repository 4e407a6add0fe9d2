"""Hotspot job: clean sightings to window metrics and late-event signals."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.operators import hotspot, quality
from sightline.operators.eventtime import LATE, behind_watermark, closings
from sightline.schemas import ARRIVAL, LATENESS_US, WINDOW_US
from sightline.session import configure, stage


_NEEDED = [*ARRIVAL, "event_id", "user_id", "species_code", "location_id", "et_us", "cnt"]


@dataclass
class Metrics:
    """The two outputs of the hotspot job."""

    metrics: DataFrame
    quality: DataFrame


def metrics(
    clean: DataFrame,
    lateness_us: int = LATENESS_US,
    width_us: int = WINDOW_US,
    now: Column | None = None,
    ranges: int | None = None,
    max_future_us: int | None = None,
) -> Metrics:
    """Closed windows, late deltas and late signals of a bounded clean log.

    The columns the job needs are written once, so whatever made ``clean`` runs once;
    so are the rows behind the watermark, which both outputs read. ``max_future_us``
    guards the watermark, see ``eventtime.moving``.
    """
    configure(clean.sparkSession)
    rows = stage(clean.select(*_NEEDED), "metrics-input")
    closed = stage(closings(rows, lateness_us, width_us, max_future_us=max_future_us), "closings")
    behind = stage(behind_watermark(rows, closed, lateness_us, width_us, ranges, max_future_us), "behind")
    panes = hotspot.main_panes(rows, closed, width_us).unionByName(hotspot.late_panes(behind))
    late = quality.late_signals(behind.filter(F.col("lateness") == LATE), now)
    return Metrics(metrics=hotspot.metric_records(panes), quality=late)
