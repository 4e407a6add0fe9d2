"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry import fixture
from sightline import schemas as S
from sightline.functions.times import iso_z, window_end_us, window_start_us
from sightline.operators import alerts, contracts, eventtime, hotspot, preferences, quality, radius
from sightline.operators.arrival import cut_points, range_id
from sightline.operators.decode import PREFERENCE_FIELDS, decodable, decode_json, raw_preview
from sightline.operators.validate import clean_fields, validate
from sightline.plans import refresh
from sightline.plans.cleaning import cleaning
from sightline.plans.metrics import metrics
from sightline.session import new_path, stage
from sightline.sources.backfill import with_provenance
from sightline.sources.topics import (
    json_value,
    message,
    read_topic,
    stream_topic,
    stream_topics,
    topic_writer,
    write_topics,
)
from sightline.streaming.alerting import alerting_stream
from sightline.streaming.cleaning import cleaning_stream
from sightline.streaming.metrics import HotspotStream, hotspot_native

Query = Callable[[SparkSession, str], DataFrame]

NOW = "2024-01-01T00:00:00Z"
#: More than any record of the fixture is behind, so nothing is dropped whatever the batches.
NATIVE_LATENESS_US = 1_800_000_000
#: Share of the rows from which a location and species is hot.
HOT_PPM = 66_700
#: How far ahead of its arrival a record may move the guarded watermark.
MAX_FUTURE_US = 3_600_000_000
#: Arrival time after which ``stream_alerts_ttl`` raises an alert again.
ALERT_TTL_US = 300_000_000


def _codes() -> Column:
    return F.array_join("issues.code", ",").alias("codes")


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate(decode_json(fixture.raw_log(spark, sf_dir)))


def _as_text(df: DataFrame, *names: str) -> DataFrame:
    """Numbers of up to 38 digits as text, which every engine compares alike."""
    return df.withColumns({name: F.col(name).cast("string") for name in names})


def event_time_parse(spark, sf_dir):
    decoded = _validated(spark, sf_dir).filter(F.col("reject").isNull())
    return decoded.select("seq", "et_us", iso_z(F.col("et_us")).alias("event_time"))


def window_bounds(spark, sf_dir):
    et = F.col("et_us")
    return fixture.sightings(spark, sf_dir).select(
        "seq",
        iso_z(window_start_us(et)).alias("window_start"),
        iso_z(window_end_us(et)).alias("window_end"),
    )


def window_identity(spark, sf_dir):
    start = window_start_us(F.col("et_us"))
    counts = (
        fixture.sightings(spark, sf_dir)
        .groupBy("location_id", "species_code", start.alias("start_us"))
        .agg(F.count("*").alias("n"))
    )
    return counts.select("location_id", "species_code", iso_z(F.col("start_us")).alias("window_start"), "n")


def decode_route(spark, sf_dir):
    decoded = decode_json(fixture.raw_log(spark, sf_dir))
    preview = F.when(F.col("reject") == "json_parse_error", raw_preview(F.col("value")))
    return decoded.select(
        "seq",
        F.coalesce("reject", F.lit("object")).alias("route"),
        quality.message_key().alias("key"),
        preview.alias("raw_preview"),
    )


def validate_issues(spark, sf_dir):
    return _validated(spark, sf_dir).filter(F.col("reject").isNull()).select("seq", _codes())


def issue_histogram(spark, sf_dir):
    return quality.issue_histogram(_validated(spark, sf_dir))


def dead_letters(spark, sf_dir):
    return quality.dead_letters(_validated(spark, sf_dir)).select(
        "key", "dead_letter_id", "original_topic", "reason_code", "raw_preview", "payload", _codes()
    )


def dq_validation_failed(spark, sf_dir):
    signals = quality.validation_signals(_validated(spark, sf_dir))
    return signals.select("key", "signal_type", "event_id", _codes())


def clean_sightings(spark, sf_dir):
    clean = cleaning(fixture.raw_log(spark, sf_dir)).clean.select(
        "key", "event_id", "user_id", "species_code", "location_id", "et_us", "cnt", "text",
        "arrival_us", "seq",
    )
    return _as_text(clean, "cnt")


def dq_duplicates(spark, sf_dir):
    signals = cleaning(fixture.raw_log(spark, sf_dir)).quality
    duplicates = signals.filter(F.col("signal_type") == "duplicate_event_id")
    return duplicates.select("key", "signal_type", "event_id", "seq")


def dq_all(spark, sf_dir):
    cleaned = cleaning(fixture.raw_log(spark, sf_dir))
    late = metrics(cleaned.clean).quality
    return cleaned.quality.unionByName(late).select("signal_type", "key", "event_id", "seq")


def running_watermark(spark, sf_dir):
    marked = eventtime.with_lateness(fixture.clean(spark, sf_dir))
    return marked.select("seq", "max_et_us", "watermark_us")


def lateness_class(spark, sf_dir):
    return eventtime.with_lateness(fixture.clean(spark, sf_dir)).select("seq", "lateness")


def window_closed(spark, sf_dir):
    marked = eventtime.with_lateness(fixture.clean(spark, sf_dir))
    closed = eventtime.window_closed(F.col("et_us"), F.col("window_end_us"), F.col("watermark_us"))
    return marked.select("seq", closed.alias("closed"))


def dq_late_events(spark, sf_dir):
    late = metrics(fixture.clean(spark, sf_dir)).quality
    return late.select("key", "signal_type", "event_id", "event_time", "window_end", "watermark")


def hotspot_totals(spark, sf_dir):
    return _as_text(hotspot.hotspot_totals(fixture.clean(spark, sf_dir, once=True)), "sighting_count")


def hotspot_salted(spark, sf_dir):
    return _as_text(hotspot.hotspot_salted(fixture.clean(spark, sf_dir, once=True)), "sighting_count")


def hotspot_panes(spark, sf_dir):
    records = hotspot.metric_records(hotspot.hotspot_panes(fixture.clean(spark, sf_dir)))
    return _as_text(records, "sighting_count")


def hotspot_open(spark, sf_dir):
    return _as_text(hotspot.hotspot_open(fixture.clean(spark, sf_dir)), "sighting_count")


def late_refresh_diff(spark, sf_dir):
    clean = fixture.clean(spark, sf_dir)
    diff = hotspot.late_refresh_diff(clean, hotspot.hotspot_panes(clean))
    return _as_text(diff, "full_count", "emitted_count", "missing")


def hot_key_share(spark, sf_dir):
    return quality.hot_key_share(fixture.clean(spark, sf_dir))


def quality_rates(spark, sf_dir):
    return quality.rates(quality.dead_letters(_validated(spark, sf_dir)), "reason_code")


def preference_changes(spark, sf_dir):
    changes = preferences.preference_changes(
        decodable(fixture.preference_log(spark, sf_dir), PREFERENCE_FIELDS)
    )
    return changes.select("user_id", "species_code", "priority", "active", "radius_km", "seq")


def pref_history(spark, sf_dir):
    return preferences.preference_history(fixture.changes(spark, sf_dir)).select(
        "user_id", "species_code", "priority", "active", "seq", "valid_from_us", "valid_to_us"
    )


def pref_snapshot(spark, sf_dir):
    snapshot = preferences.preference_snapshot(fixture.changes(spark, sf_dir))
    return snapshot.select("user_id", "species_code", "priority", "seq")


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preferences.preference_history(fixture.changes(spark, sf_dir))


def alert_matches(spark, sf_dir):
    matches = alerts.match_versions(fixture.clean(spark, sf_dir), _history(spark, sf_dir))
    return alerts.alert_matches(matches)


def alerts_asof(spark, sf_dir):
    return alerts.alerts_asof(fixture.clean(spark, sf_dir), _history(spark, sf_dir))


def alerts_snapshot(spark, sf_dir):
    snapshot = preferences.preference_snapshot(fixture.changes(spark, sf_dir))
    return alerts.alerts_snapshot(fixture.clean(spark, sf_dir), snapshot)


def alerts_radius(spark, sf_dir):
    clean = fixture.clean(spark, sf_dir)
    snapshot = preferences.preference_snapshot(fixture.changes(spark, sf_dir))
    endless = F.when(F.col("seq") % 71 == 0, F.lit(float("inf"))).otherwise(F.col("radius_km"))
    snapshot = snapshot.withColumn("radius_km", endless)
    return radius.alerts_within_radius(clean, snapshot, radius.last_positions(clean))


def backfill(spark, sf_dir):
    history = fixture.sightings(spark, sf_dir).withColumn("event_id", F.lit(""))
    provided = with_provenance(history, "archive", F.col("seq"))
    return provided.select("event_id", "source", "provider_record_id", "arrival_us", "seq")


def alert_records(spark, sf_dir):
    return alerts.alert_records(alerts_asof(spark, sf_dir)).drop("detected_at")


def _violations(log: DataFrame, contract: dict[str, str]) -> DataFrame:
    decoded = decodable(log, contracts.fields_of(contract))
    return contracts.contract_violations(decoded, contract)


def contract_sighting(spark, sf_dir):
    found = _violations(fixture.raw_log(spark, sf_dir), contracts.SIGHTING_CONTRACT)
    return found.select("seq", F.array_join("violations", ",").alias("violations"))


def contract_preference(spark, sf_dir):
    found = _violations(fixture.preference_log(spark, sf_dir), contracts.PREFERENCE_CONTRACT)
    return found.select("seq", F.array_join("violations", ",").alias("violations"))


def contract_alert(spark, sf_dir):
    records = alerts.alert_records(alerts_asof(spark, sf_dir), F.lit("2024-01-01T00:00:00Z"))
    ends = lambda digit: F.col("sighting_event_id").endswith(digit)
    broken = records.withColumns(
        {
            "window_start": F.when(ends("1"), F.substring("window_start", 1, 10)).otherwise(F.col("window_start")),
            "detected_at": F.when(ends("4"), "2024-02-30T00:00:00Z").otherwise(F.col("detected_at")),
            "priority": F.when(~ends("2"), F.col("priority")),
        }
    )
    value = F.to_json(F.struct(*[c for c in broken.columns if c != "key"]))
    log = broken.select("alert_id", value.alias("value"))
    found = _violations(log, contracts.ALERT_CONTRACT)
    return found.select("alert_id", F.array_join("violations", ",").alias("violations"))


def hot_keys(spark, sf_dir):
    return quality.hot_keys(fixture.clean(spark, sf_dir), ["location_id", "species_code"], HOT_PPM)


def hotspot_salted_hot(spark, sf_dir):
    return _as_text(hotspot.hotspot_salted_hot(fixture.clean(spark, sf_dir), HOT_PPM), "sighting_count")


def hotspot_birders_sketch(spark, sf_dir):
    """Main and late panes merged, the estimate held against the exact number."""
    clean = fixture.clean(spark, sf_dir)
    found = hotspot.merged_birders(hotspot.sketched_panes(clean))
    closed = eventtime.closings(clean)
    late = eventtime.behind_watermark(clean, closed).filter(F.col("lateness") == eventtime.LATE).select(*S.ARRIVAL)
    counted = eventtime.with_window(clean).join(late, list(S.ARRIVAL), "left_anti")
    exact = counted.groupBy(*hotspot.KEYS).agg(F.count_distinct(hotspot.birder()).alias("unique_birders"))
    # Three standard errors.
    bound = F.ceil(3 * 1.04 / 2 ** (hotspot.SKETCH_BITS / 2) * F.col("unique_birders"))
    near = F.abs(F.col("birders_estimate") - F.col("unique_birders")) <= bound
    joined = found.join(exact, hotspot.KEYS).withColumn("within_bound", near)
    return _as_text(joined.drop("birders_estimate"), "sighting_count")


def late_refresh_totals(spark, sf_dir):
    """Totals of the records in time, refreshed for the windows that got others."""
    hour = 3_600_000_000
    clean, totals = new_path(spark, "clean-table"), new_path(spark, "totals-table")
    marked = stage(eventtime.with_lateness(fixture.clean(spark, sf_dir)), "marked")
    in_time = marked.filter(F.col("lateness") == eventtime.ON_TIME)
    columns = [*S.ARRIVAL, "event_id", "user_id", "species_code", "location_id", "et_us", "cnt"]
    refresh.write_totals(in_time, totals, hour)
    refresh.append_clean(marked.select(*columns), clean, hour)
    refresh.refresh_totals(clean, refresh.touched_windows(marked), totals, hour)
    return _as_text(spark.read.parquet(totals).drop(refresh.PART), "sighting_count")


def _odd_clean(spark, sf_dir):
    """Clean rows as another writer may leave them: no time, no user, no species, no place."""
    without = lambda name, rest, empty: F.when(F.col("seq") % 23 == rest, empty).otherwise(F.col(name))
    nothing = F.lit(None).cast("bigint")
    return fixture.clean(spark, sf_dir).withColumns(
        {
            "et_us": without("et_us", 5, nothing),
            "user_id": without("user_id", 6, F.lit("")),
            "species_code": without("species_code", 7, F.lit("")),
            "location_id": without("location_id", 8, F.lit("")),
        }
    )


def hotspot_odd_rows(spark, sf_dir):
    found = hotspot.hotspot_panes(_odd_clean(spark, sf_dir))
    return _as_text(found.select(*hotspot.KEYS, "pane", "event_id", "sighting_count", "unique_birders", "watermark_us"), "sighting_count")


def alerts_odd_rows(spark, sf_dir):
    return alerts.alerts_asof(_odd_clean(spark, sf_dir), _history(spark, sf_dir))


def lateness_guarded(spark, sf_dir):
    """Classes under a guarded watermark, with some records ten days ahead."""
    ahead = F.when(F.col("seq") % 499 == 7, 10 * 86_400_000_000).otherwise(0)
    rows = fixture.clean(spark, sf_dir).withColumn("et_us", F.col("et_us") + ahead)
    found = eventtime.with_lateness(rows, max_future_us=MAX_FUTURE_US)
    return found.select("seq", "watermark_us", "lateness")


def _slices(log: DataFrame, folder: str, run: Callable[[], None], slices: int = 3) -> None:
    """Append the log in slices of arrival order, running the stream after each.

    Every run resumes from the checkpoint of the run before, as after a restart. A slice
    is a folder of its own, so appending one reads no other.
    """
    sliced = log.withColumn("slice", range_id(cut_points(log, slices)))
    path = new_path(log.sparkSession, "slices")
    sliced.write.partitionBy("slice").parquet(path)
    written = log.sparkSession.read.schema(sliced.schema).parquet(path)
    for number in range(slices):
        part = written.filter(F.col("slice") == number).drop("slice")
        write_topics(part, folder)
        run()


def _clean_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = {
        "event_id": F.col("event_id"),
        "user_id": F.col("user_id"),
        "species_code": F.col("species_code"),
        "location_id": F.col("location_id"),
        "event_time": iso_z(F.col("et_us")),
        "count": F.col("cnt"),
    }
    routed = message(S.CLEAN, F.col("location_id"), json_value(fields))
    return fixture.clean(spark, sf_dir).select(F.inline(F.array(routed)), *S.ARRIVAL)


def topic_replay(spark, sf_dir):
    folder = new_path(spark, "topic-replay")
    write_topics(fixture.raw_log(spark, sf_dir).withColumn("topic", F.lit(S.RAW)), folder)
    rows = read_topic(spark, S.RAW, folder)
    text = {name: F.col(name).cast("string") for name in ("key", "value")}
    return rows.withColumns(text)


def topic_replay_span(spark, sf_dir):
    """Hours of the log that begin on one day and end on the next."""
    folder = new_path(spark, "topic-span")
    log = fixture.raw_log(spark, sf_dir).withColumn("arrival_us", F.col("arrival_us") * 4 - 3 * fixture.EPOCH_US)
    write_topics(log.withColumn("topic", F.lit(S.RAW)), folder)
    rows = read_topic(spark, S.RAW, folder, since_us=fixture.EPOCH_US + 60_000_000_000, until_us=fixture.EPOCH_US + 100_000_000_000)
    text = {name: F.col(name).cast("string") for name in ("key", "value")}
    return rows.withColumns(text)


def _run_now(writer) -> None:
    writer.trigger(availableNow=True).start().awaitTermination()


def _cleaning_values(out: DataFrame) -> DataFrame:
    """Key and value of every record of the cleaning topics, all fields of the values."""
    value = F.col("value").cast("string")
    fields = T.StructType(
        [
            *[T.StructField(name, T.StringType()) for name in ("dead_letter_id", "original_topic", "reason_code", "raw_preview", "ingested_at")],
            *S.QUALITY_EVENT.fields,
        ]
    )
    v = F.from_json(value, fields).alias("v")
    clean, dead = F.col("topic") == S.CLEAN, F.col("topic") == S.DEAD_LETTERS
    # A dead letter ends with its payload, JSON text as it came.
    payload = F.get(F.split(F.col("value"), ',"payload":', 2), F.lit(1))
    rows = out.select("topic", F.col("key").cast("string").alias("key"), value.alias("value"), v, "arrival_us", "seq")
    return rows.select(
        "topic",
        "key",
        F.when(clean, F.col("value")).when(dead, F.substring(payload, F.lit(1), F.length(payload) - 1)).alias("text"),
        *[F.when(~clean, F.col(f"v.{name}")).alias(name) for name in fields.names if name != "issues"],
        F.when(~clean, F.array_join("v.issues.code", ",")).alias("codes"),
        "arrival_us",
        "seq",
    )


def stream_clean(spark, sf_dir):
    folder = new_path(spark, "stream-clean")
    log = fixture.raw_log(spark, sf_dir).withColumn("topic", F.lit(S.RAW))

    def run():
        routed = cleaning_stream(stream_topic(spark, S.RAW, f"{folder}/in"), now=F.lit(NOW))
        _run_now(topic_writer(routed, f"{folder}/checkpoint", f"{folder}/out"))

    _slices(log, f"{folder}/in", run)
    return _cleaning_values(spark.read.parquet(f"{folder}/out"))


def stream_hotspot_exact(spark, sf_dir):
    folder = new_path(spark, "stream-hotspot")
    job = HotspotStream(spark, f"{folder}/job", now=F.lit(NOW))

    def run():
        clean = clean_fields(decodable(stream_topic(spark, S.CLEAN, f"{folder}/in")))
        writer = clean.writeStream.foreachBatch(job)
        _run_now(writer.option("checkpointLocation", f"{folder}/checkpoint"))

    _slices(_clean_topic(spark, sf_dir), f"{folder}/in", run)
    metric = [*S.METRIC.fields, T.StructField("pane", T.StringType())]
    signal = [f for f in S.QUALITY_EVENT.fields if f.name not in S.METRIC.names]
    value = F.from_json(F.col("value").cast("string"), T.StructType([*metric, *signal])).alias("v")
    out = spark.read.parquet(f"{folder}/job/out").select("topic", F.col("key").cast("string").alias("key"), value)
    return _as_text(out.select("topic", "key", "v.*").drop("issues"), "sighting_count")


def stream_hotspot_native(spark, sf_dir):
    folder = new_path(spark, "stream-native")

    def run():
        clean = clean_fields(decodable(stream_topic(spark, S.CLEAN, f"{folder}/in")))
        writer = hotspot_native(clean, lateness_us=NATIVE_LATENESS_US).writeStream.format("parquet").outputMode("append")
        writer = writer.option("path", f"{folder}/out")
        _run_now(writer.option("checkpointLocation", f"{folder}/checkpoint"))

    _slices(_clean_topic(spark, sf_dir), f"{folder}/in", run)
    return _as_text(spark.read.parquet(f"{folder}/out"), "sighting_count")


def _alert_stream(spark: SparkSession, sf_dir: str, ttl_us: int | None) -> DataFrame:
    folder = new_path(spark, "stream-alerts")
    changes = fixture.changes(spark, sf_dir)
    fields = {name: F.col(name) for name in ("user_id", "species_code", "priority", "active")}
    routed = message(S.PREFERENCES, F.col("user_id"), json_value(fields))
    changes = changes.select(F.inline(F.array(routed)), *S.ARRIVAL)
    log = _clean_topic(spark, sf_dir).unionByName(changes)

    def run():
        rows = stream_topics(spark, [S.CLEAN, S.PREFERENCES], f"{folder}/in")
        alerting = alerting_stream(rows, ttl_us=ttl_us)
        _run_now(topic_writer(alerting, f"{folder}/checkpoint", f"{folder}/out"))

    _slices(log, f"{folder}/in", run)
    out = spark.read.parquet(f"{folder}/out").filter(F.col("topic") == S.ALERTS)
    value = F.from_json(F.col("value").cast("string"), S.ALERT)
    records = out.select(F.col("key").cast("string").alias("key"), value.alias("v"))
    return records.select("key", "v.*").drop("detected_at")


def stream_alerts(spark, sf_dir):
    return _alert_stream(spark, sf_dir, None)


def stream_alerts_ttl(spark, sf_dir):
    return _alert_stream(spark, sf_dir, ALERT_TTL_US)


_QUERIES = [
    event_time_parse,
    window_bounds,
    window_identity,
    decode_route,
    validate_issues,
    issue_histogram,
    dead_letters,
    dq_validation_failed,
    clean_sightings,
    dq_duplicates,
    dq_all,
    running_watermark,
    lateness_class,
    window_closed,
    dq_late_events,
    hotspot_totals,
    hotspot_salted,
    hotspot_panes,
    hotspot_open,
    late_refresh_diff,
    late_refresh_totals,
    hot_key_share,
    hotspot_odd_rows,
    alerts_odd_rows,
    lateness_guarded,
    hot_keys,
    hotspot_salted_hot,
    hotspot_birders_sketch,
    quality_rates,
    preference_changes,
    pref_history,
    pref_snapshot,
    alert_matches,
    alerts_asof,
    alerts_snapshot,
    alerts_radius,
    backfill,
    alert_records,
    topic_replay,
    topic_replay_span,
    contract_sighting,
    contract_preference,
    contract_alert,
    stream_clean,
    stream_hotspot_exact,
    stream_hotspot_native,
    stream_alerts,
    stream_alerts_ttl,
]


def queries() -> dict[str, Query]:
    return {query.__name__: query for query in _QUERIES}
