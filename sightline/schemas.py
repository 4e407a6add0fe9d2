"""Stream names, constants and record layouts."""

from __future__ import annotations

from pyspark.sql import types as T

# Stream names.
RAW = "bird_sightings_raw"
CLEAN = "bird_sightings_clean"
PREFERENCES = "target_species_preferences"
METRICS = "hotspot_activity_metrics"
ALERTS = "species_alerts"
QUALITY = "data_quality_events"
DEAD_LETTERS = "dead_letter_events"

# 15-minute windows, two minutes of allowed lateness.
WINDOW_US = 900 * 1_000_000
LATENESS_US = 120 * 1_000_000

# Every "first", "last" and "so far" follows this order.
ARRIVAL = ("arrival_us", "seq")

ISSUE = T.StructType(
    [T.StructField("code", T.StringType()), T.StructField("message", T.StringType())]
)

# A stream at rest: what a Kafka source yields, plus the arrival order.
LOG = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("arrival_us", T.LongType()),
        T.StructField("seq", T.LongType()),
    ]
)

# Declared layouts of the record values (extra fields are allowed).
SIGHTING = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("species_code", T.StringType()),
        T.StructField("common_name", T.StringType()),
        T.StructField("location_id", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lng", T.DoubleType()),
        T.StructField("event_time", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("source", T.StringType()),
    ]
)

PREFERENCE = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("species_code", T.StringType()),
        T.StructField("priority", T.StringType()),
        T.StructField("radius_km", T.DoubleType()),
        T.StructField("active", T.BooleanType()),
        T.StructField("updated_at", T.StringType()),
    ]
)

METRIC = T.StructType(
    [
        T.StructField("metric_id", T.StringType()),
        T.StructField("location_id", T.StringType()),
        T.StructField("species_code", T.StringType()),
        T.StructField("window_start", T.StringType()),
        T.StructField("window_end", T.StringType()),
        T.StructField("sighting_count", T.DecimalType(38, 0)),
        T.StructField("unique_birders", T.LongType()),
        T.StructField("watermark_at_emit", T.StringType()),
    ]
)

ALERT = T.StructType(
    [
        T.StructField("alert_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("species_code", T.StringType()),
        T.StructField("location_id", T.StringType()),
        T.StructField("window_start", T.StringType()),
        T.StructField("window_end", T.StringType()),
        T.StructField("sighting_event_id", T.StringType()),
        T.StructField("detected_at", T.StringType()),
        T.StructField("priority", T.StringType()),
    ]
)

QUALITY_EVENT = T.StructType(
    [
        T.StructField("signal_type", T.StringType()),
        T.StructField("event_id", T.StringType()),
        T.StructField("detail", T.StringType()),
        T.StructField("issues", T.ArrayType(ISSUE)),
        T.StructField("event_time", T.StringType()),
        T.StructField("window_end", T.StringType()),
        T.StructField("watermark", T.StringType()),
        T.StructField("observed_at", T.StringType()),
    ]
)
