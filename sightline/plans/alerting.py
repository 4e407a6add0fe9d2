"""Alert job: clean sightings and preference changes to alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from sightline.operators import alerts, preferences
from sightline.schemas import ARRIVAL, WINDOW_US
from sightline.session import configure, stage

_NEEDED = [*ARRIVAL, "event_id", "user_id", "species_code", "location_id", "et_us"]


def alerting(
    clean: DataFrame,
    changes: DataFrame,
    mode: str = "asof",
    width_us: int = WINDOW_US,
    now: Column | None = None,
) -> DataFrame:
    """Alert records of a bounded clean log and preference changelog.

    ``asof`` applies every change at its arrival; ``snapshot`` reads all changes
    before the first sighting.
    """
    configure(clean.sparkSession)
    # Written once: the join passes over the sightings several times.
    clean = stage(clean.select(*_NEEDED), "alerting-input")
    if mode == "asof":
        found = alerts.alerts_asof(clean, preferences.preference_history(changes), width_us)
    elif mode == "snapshot":
        found = alerts.alerts_snapshot(clean, preferences.preference_snapshot(changes), width_us)
    else:
        raise ValueError(f"unknown mode: {mode}")
    return alerts.alert_records(found, now)
