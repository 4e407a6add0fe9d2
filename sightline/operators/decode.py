"""Strict JSON decoding and the structural gate in front of validation."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.session import once

JSON_PARSE_ERROR = "json_parse_error"
INVALID_RECORD_TYPE = "invalid_record_type"
PREVIEW_BYTES = 512

# Fields the jobs read. VARIANT where the JSON type of a value matters.
SIGHTING_FIELDS = (
    "event_id variant, user_id string, species_code string, location_id string, "
    "event_time string, count variant"
)
PREFERENCE_FIELDS = (
    "user_id string, species_code string, priority variant, active variant, "
    "radius_km variant, updated_at variant"
)

_STRICT = {"allowNonNumericNumbers": "false", "allowSingleQuotes": "false"}


def raw_preview(value: Column) -> Column:
    """First 512 bytes as text, undecodable bytes replaced."""
    return F.make_valid_utf8(F.substring(value.cast("binary"), 1, PREVIEW_BYTES).cast("string"))


def decode_json(df: DataFrame, fields: str = SIGHTING_FIELDS) -> DataFrame:
    """Add ``text``, ``rec`` and ``reject`` to rows that carry a ``value``.

    ``rec`` holds the named fields of a JSON object; ``reject`` is null for an
    object and the reason otherwise. The parser stops after one value and would
    accept trailing text, so the value is parsed as the first element of an array
    whose second element carries a random token: only one complete value is
    followed by that token.
    """
    token = f"t{uuid.uuid4().hex}"
    raw = F.col("value").cast("string")
    text = F.col("text")
    framed = F.concat(F.lit("["), text, F.lit(f',{{"{token}":true}}]'))
    parsed = df.withColumn("text", F.when(F.is_valid_utf8(raw), raw)).withColumn(
        "_array", F.from_json(framed, f"array<struct<{fields}, {token} boolean>>", _STRICT)
    )
    is_object = (
        (F.size("_array") == 2)
        & F.get("_array", F.lit(0)).isNotNull()
        & F.coalesce(F.get("_array", F.lit(1))[token], F.lit(False))
    )
    # Reached for the few rows that are no object: is it JSON of another type?
    other = F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{token}"]')))
    is_json = F.coalesce(F.try_variant_get(other, "$[1]", "string") == token, F.lit(False))
    reject = (
        F.when(is_object, None)
        .when(F.col("value").isNull() | is_json, INVALID_RECORD_TYPE)
        .otherwise(JSON_PARSE_ERROR)
    )
    rec = F.when(is_object, F.get("_array", F.lit(0)).dropFields(token))
    return once(parsed, {"text": text, "rec": rec, "reject": reject}).drop("_array")


def decodable(df: DataFrame, fields: str = SIGHTING_FIELDS) -> DataFrame:
    """Tolerant decoding: rows that are not JSON objects are skipped."""
    return decode_json(df, fields).filter(F.col("reject").isNull())
