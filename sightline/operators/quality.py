"""Dead-letter rows, data-quality signals and their rates."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline import schemas as S
from sightline.functions.ids import stable_id
from sightline.functions.times import iso_z, now_z, window_start_us
from sightline.operators.decode import INVALID_RECORD_TYPE, JSON_PARSE_ERROR, raw_preview
from sightline.operators.validate import is_invalid

VALIDATION_FAILED = "validation_failed"

# Detail texts.
PARSE_DETAIL = "Record is not one complete JSON value"
TYPE_DETAIL = "Record JSON must be an object"
DUPLICATE_DETAIL = "Duplicate event_id after retry or at-least-once replay"
LATE_DETAIL = "Event arrived beyond allowed lateness after watermark"


def message_key() -> Column:
    """The incoming key as text; invalid bytes are replaced."""
    return F.make_valid_utf8(F.col("key").cast("string"))


def record_key() -> Column:
    """Location of the record when it has one, else the incoming key."""
    return F.coalesce(F.col("location_id"), message_key())


def is_rejected() -> Column:
    """Not a JSON object at all."""
    return F.col("reject").isNotNull()


def dead_letter_key() -> Column:
    return F.when(is_rejected(), message_key()).otherwise(record_key())


def dead_letter_fields(topic: str = S.RAW, ingested_at: Column | None = None) -> dict[str, Column]:
    """Fields of a dead letter; ``payload`` is the record's JSON text."""
    reason = F.coalesce(F.col("reject"), F.lit(VALIDATION_FAILED))
    unparsed = reason == JSON_PARSE_ERROR
    return {
        "dead_letter_id": stable_id("dl_", F.lit(topic), F.col("seq")),
        "original_topic": F.lit(topic),
        "reason_code": reason,
        "detail": F.when(unparsed, PARSE_DETAIL).when(reason == INVALID_RECORD_TYPE, TYPE_DETAIL),
        "raw_preview": F.when(unparsed, raw_preview(F.col("value"))),
        "payload": F.when(~unparsed, F.col("text")),
        "issues": F.when(~is_rejected(), F.col("issues")),
        "ingested_at": now_z() if ingested_at is None else ingested_at,
    }


def dead_letters(
    validated: DataFrame, topic: str = S.RAW, ingested_at: Column | None = None
) -> DataFrame:
    """One row per record that did not parse, is no object, or failed validation."""
    fields = dead_letter_fields(topic, ingested_at)
    return validated.filter(is_rejected() | is_invalid()).select(
        dead_letter_key().alias("key"), *_named(fields), *S.ARRIVAL
    )


def _named(fields: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in fields.items()]


def _signal(observed_at: Column | None, **fields: Column) -> dict[str, Column]:
    """A data-quality event: the shared layout, null where a signal has no value."""
    fields["observed_at"] = now_z() if observed_at is None else observed_at
    return {
        f.name: fields.get(f.name, F.lit(None)).cast(f.dataType) for f in S.QUALITY_EVENT.fields
    }


def validation_signal(observed_at: Column | None = None) -> dict[str, Column]:
    return _signal(
        observed_at,
        signal_type=F.lit(VALIDATION_FAILED),
        event_id=F.when(F.col("event_id_is_text"), F.coalesce("event_id", F.lit(""))),
        issues=F.col("issues"),
    )


def duplicate_signal(observed_at: Column | None = None) -> dict[str, Column]:
    return _signal(
        observed_at,
        signal_type=F.lit("duplicate_event_id"),
        event_id=F.col("event_id"),
        detail=F.lit(DUPLICATE_DETAIL),
    )


def validation_signals(validated: DataFrame, observed_at: Column | None = None) -> DataFrame:
    """``validation_failed`` for every decoded record with issues."""
    fields = validation_signal(observed_at)
    return validated.filter(is_invalid()).select(
        record_key().alias("key"), *_named(fields), *S.ARRIVAL
    )


def duplicate_signals(duplicates: DataFrame, observed_at: Column | None = None) -> DataFrame:
    """``duplicate_event_id`` for every arrival after the first of its id."""
    fields = duplicate_signal(observed_at)
    return duplicates.select(F.col("location_id").alias("key"), *_named(fields), *S.ARRIVAL)


def late_signals(late: DataFrame, observed_at: Column | None = None) -> DataFrame:
    """``late_event_dropped`` for every record beyond the allowed lateness."""
    fields = _signal(
        observed_at,
        signal_type=F.lit("late_event_dropped"),
        event_id=F.col("event_id"),
        detail=F.lit(LATE_DETAIL),
        event_time=iso_z(F.col("et_us")),
        window_end=iso_z(F.col("window_end_us")),
        watermark=iso_z(F.col("watermark_us")),
    )
    return late.select(F.col("location_id").alias("key"), *_named(fields), *S.ARRIVAL)


def rates(events: DataFrame, reason: str, width_us: int = S.WINDOW_US) -> DataFrame:
    """Rows per reason and arrival window, the input of a quality objective."""
    return events.groupBy(
        window_start_us(F.col("arrival_us"), width_us).alias("window_start_us"), F.col(reason)
    ).agg(F.count("*").alias("n"))


def issue_histogram(validated: DataFrame) -> DataFrame:
    """How often each issue code occurs."""
    return (
        validated.filter(is_invalid())
        .select(F.explode("issues.code").alias("code"))
        .groupBy("code")
        .agg(F.count("*").alias("n"))
    )


def hot_key_share(df: DataFrame, key: str = "location_id") -> DataFrame:
    """Rows per key and their share of all rows, in parts per million."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    total = df.select(F.count("*").alias("total"))
    shares = counts.withColumn("_total", total.scalar())
    return shares.withColumn("share_ppm", F.expr("n * 1000000 div _total")).drop("_total")


def _key_text(keys: list[str]) -> Column:
    return F.to_json(F.array(*[F.col(k).cast("string") for k in keys]))


def heavy_keys(df: DataFrame, keys: list[str], share_ppm: int) -> tuple[list[str], int]:
    """Texts of the keys that may hold ``share_ppm`` of the rows or more, and the rows.

    One pass with a frequent-items sketch of fixed size: it misses no key whose share is
    above twice its error, and its error is a quarter of the share asked for. The keys
    it gives too many hold at least half of that share, so they are few as well.
    """
    share = share_ppm / 1_000_000
    if not 0 < share <= 1:
        raise ValueError("share_ppm must be above 0 and at most 1000000")
    # A map of that size has an error of 3.5 / size of the rows.
    size = max(64, math.ceil(4 * 3.5 / share))
    wanted = min(math.ceil(2 / share), size)
    row = df.select(_key_text(keys).alias("_key")).agg(
        F.expr(f"approx_top_k(_key, {wanted}, {size})").alias("top"), F.count("*").alias("rows")
    ).first()
    return [item["item"] for item in row["top"] or []], row["rows"]


def is_heavy(keys: list[str], heavy: list[str]) -> Column:
    return _key_text(keys).isin(heavy) if heavy else F.lit(False)


def hot_keys(df: DataFrame, keys: list[str], share_ppm: int = 10_000) -> DataFrame:
    """Every key with ``share_ppm`` of the rows or more: its exact rows and share.

    Only rows of the keys the sketch found are counted, so nothing is shuffled but those
    counts, however many keys there are.
    """
    heavy, total = heavy_keys(df, keys, share_ppm)
    counts = df.filter(is_heavy(keys, heavy)).groupBy(*keys).agg(F.count("*").alias("n"))
    shares = counts.withColumn("share_ppm", F.expr(f"n * 1000000 div {max(total, 1)}"))
    return shares.filter(F.col("share_ppm") >= share_ppm)
