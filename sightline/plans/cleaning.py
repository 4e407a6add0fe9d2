"""Cleaning job: raw records to clean sightings, dead letters and quality signals."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.operators import quality
from sightline.operators.decode import JSON_PARSE_ERROR, decode_json
from sightline.operators.dedup import mark_first
from sightline.operators.validate import is_valid, validate
from sightline.session import configure, stage


@dataclass
class Cleaned:
    """The three outputs of the cleaning job."""

    clean: DataFrame
    dead_letters: DataFrame
    quality: DataFrame


def clean_records(first: DataFrame) -> DataFrame:
    """Clean rows: typed columns beside the original text, keyed by location."""
    return first.select(
        F.col("location_id").alias("key"),
        "text",
        "event_id",
        "user_id",
        "species_code",
        "location_id",
        "et_us",
        "cnt",
        "arrival_us",
        "seq",
    )


def cleaning(raw: DataFrame, now: Column | None = None) -> Cleaned:
    """Decode, validate and deduplicate a bounded raw log.

    The validated rows are written once: every output reads them from there, so
    the JSON is decoded once, and the pass that finds first arrivals reads three
    columns.
    """
    configure(raw.sparkSession)
    # Only a record that did not parse is still needed as bytes.
    unparsed = F.when(F.col("reject") == JSON_PARSE_ERROR, F.col("value"))
    validated = stage(validate(decode_json(raw)).withColumn("value", unparsed), "validated")
    marked = mark_first(validated.filter(is_valid()))
    duplicates = quality.duplicate_signals(marked.filter(~F.col("is_first")), now)
    return Cleaned(
        clean=clean_records(marked.filter("is_first")),
        dead_letters=quality.dead_letters(validated, ingested_at=now),
        quality=quality.validation_signals(validated, now).unionByName(duplicates),
    )
