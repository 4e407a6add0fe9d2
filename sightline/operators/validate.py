"""Sighting validation: typed fields plus an ordered list of issues per record."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.functions import variants as V
from sightline.functions.times import event_time_us
from sightline.schemas import ISSUE
from sightline.session import once

# Issue codes and messages, in the order they are reported.
ISSUES = {
    "missing_user_id": "user_id is required",
    "missing_species_code": "species_code is required",
    "invalid_count_type": "count must be an integer",
    "negative_count": "count must be non-negative",
    "missing_event_time": "event_time is required",
    "invalid_event_time": "event_time must be ISO-8601",
    "missing_event_id": "event_id is required",
    "missing_location_id": "location_id is required",
    "invalid_event_id_type": "event_id must be a string",
}


def issue_list(rules: dict[str, Column]) -> Column:
    """Ordered array of ``{code, message}`` for the rules that hold.

    Most records break no rule; the list is put together only for the others.
    """
    broken = reduce(or_, (F.coalesce(rule, F.lit(False)) for rule in rules.values()))
    found = [
        F.when(rules[code], F.struct(F.lit(code).alias("code"), F.lit(message).alias("message")))
        for code, message in ISSUES.items()
        if code in rules
    ]
    none = F.array().cast(T.ArrayType(ISSUE))
    return F.when(broken, F.array_compact(F.array(*found))).otherwise(none)


def count_delta(count: Column, kind: Column) -> Column:
    """Contribution of one record: a non-negative integer counts as itself, else 1.

    JSON booleans are integers here: true is 1, false is 0. Integers have up to 38
    digits.
    """
    number = F.try_variant_get(count, "$", "decimal(38,0)")
    return (
        F.when(V.is_integer(kind) & (number >= 0), number)
        .when(kind == "BOOLEAN", F.try_variant_get(count, "$", "boolean").cast("int"))
        .otherwise(1)
        .cast("decimal(38,0)")
    )


_FIELDS = ["event_id", "event_id_is_text", "user_id", "species_code", "location_id"]
_FIELDS += ["event_time", "et_us", "cnt"]


def sighting_fields(decoded: DataFrame) -> DataFrame:
    """Typed columns of a decoded sighting; ids are null when they are falsy."""
    event_id, count = F.col("rec.event_id"), F.col("rec.count")
    idents = {
        name: F.when(
            V.truthy_text(F.col(f"rec.{name}"), name, F.col("text")), F.col(f"rec.{name}")
        )
        for name in ("user_id", "species_code", "location_id")
    }
    return decoded.withColumns(
        idents
        | {
            "event_id": V.truthy_scalar(event_id),
            "event_id_is_text": V.is_text(event_id),
            "event_time": F.col("rec.event_time"),
            "count": count,
            "count_kind": F.coalesce(V.kind(count), F.lit("VOID")),
        }
    ).withColumns(
        {"cnt": count_delta(F.col("count"), F.col("count_kind")), "et_us": event_time_us("event_time")}
    )


def clean_fields(decoded: DataFrame) -> DataFrame:
    """Typed columns of an already cleaned record; missing texts are empty."""
    texts = {
        name: F.coalesce(F.col(f"rec.{name}"), F.lit(""))
        for name in ("user_id", "species_code", "location_id")
    }
    fields = texts | {
        "event_id": V.scalar_text(F.col("rec.event_id")),
        "et_us": event_time_us("rec.event_time"),
        "cnt": count_delta(F.col("rec.count"), V.kind(F.col("rec.count"))),
    }
    return once(decoded, fields).select(*fields, "text", "arrival_us", "seq")


def validate(decoded: DataFrame) -> DataFrame:
    """Typed columns plus ``issues``; a record is valid when the list is empty.

    Rows that did not decode keep null fields and get no issues.
    """
    typed = sighting_fields(decoded)
    kind = F.col("count_kind")
    integer = V.is_integer(kind)
    number = F.try_variant_get("count", "$", "decimal(38,0)")
    rules = {
        "missing_user_id": F.col("user_id").isNull(),
        "missing_species_code": F.col("species_code").isNull(),
        "invalid_count_type": ~integer & ~kind.isin("VOID", "BOOLEAN"),
        "negative_count": integer & (number < 0),
        "missing_event_time": F.col("event_time").isNull(),
        "invalid_event_time": F.col("event_time").isNotNull() & F.col("et_us").isNull(),
        "missing_event_id": F.col("event_id").isNull(),
        "missing_location_id": F.col("location_id").isNull(),
        "invalid_event_id_type": F.col("event_id").isNotNull() & ~F.col("event_id_is_text"),
    }
    issues = F.when(F.col("reject").isNull(), issue_list(rules))
    fields = {name: F.col(name) for name in _FIELDS}
    return once(typed.drop("rec"), fields | {"issues": issues}).drop("count", "count_kind")


def is_valid() -> Column:
    """Decoded and free of issues."""
    return F.col("reject").isNull() & (F.size("issues") == 0)


def is_invalid() -> Column:
    """Decoded, but with at least one issue."""
    return F.col("reject").isNull() & (F.size("issues") > 0)
