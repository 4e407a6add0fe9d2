"""Declared record contracts, reported as a list of violations per row.

Stricter than validation (every field is required, ranges are checked) and for
reporting only: nothing is routed by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.functions import variants as V

# RFC 3339: a full date, a time and an offset. The day is checked by the calendar.
_DATE_TIME = (
    r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])[Tt]([01]\d|2[0-3]):[0-5]\d:([0-5]\d|60)"
    r"(\.\d+)?([Zz]|[+-]([01]\d|2[0-3]):[0-5]\d)$"
)

# Field contracts. "id" is a non-empty string.
SIGHTING_CONTRACT = {
    "event_id": "id",
    "user_id": "id",
    "species_code": "id",
    "common_name": "string",
    "location_id": "id",
    "lat": "number",
    "lng": "number",
    "event_time": "date-time",
    "count": "integer>=0",
    "confidence": "number 0..1",
    "source": "string",
}
PREFERENCE_CONTRACT = {
    "user_id": "id",
    "species_code": "id",
    "priority": "low|medium|high",
    "radius_km": "number>=0",
    "active": "boolean",
    "updated_at": "date-time",
}
ALERT_CONTRACT = {
    "alert_id": "string",
    "user_id": "string",
    "species_code": "string",
    "location_id": "string",
    "window_start": "date-time",
    "window_end": "date-time",
    "sighting_event_id": "string",
    "detected_at": "date-time",
    "priority": "string",
}


def fields_of(contract: dict[str, str]) -> str:
    """The fields to decode, each with its JSON type."""
    return ", ".join(f"{name} variant" for name in contract)


def _is_date_time(text: Column) -> Column:
    day = F.substring(text, 1, 10).try_cast("date")
    return text.rlike(_DATE_TIME) & day.isNotNull()


def _checks(name: str, rule: str) -> list[Column]:
    value, kind, text = F.col(f"_{name}"), F.col(f"_{name}_kind"), F.col(f"_{name}_text")
    number = text.try_cast("double")
    is_number = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
    is_string = kind == "STRING"
    # A whole-valued number is an integer under the contract, 3.0 included.
    rules = {
        "id": lambda: (is_string, {"minLength": text == ""}),
        "string": lambda: (is_string, {}),
        "date-time": lambda: (is_string, {"format": ~_is_date_time(text)}),
        "low|medium|high": lambda: (is_string, {"enum": ~text.isin("low", "medium", "high")}),
        "boolean": lambda: (kind == "BOOLEAN", {}),
        "number": lambda: (is_number, {}),
        "number>=0": lambda: (is_number, {"minimum": number < 0}),
        "number 0..1": lambda: (is_number, {"minimum": number < 0, "maximum": number > 1}),
        "integer>=0": lambda: (is_number & (number == F.rint(number)), {"minimum": number < 0}),
    }
    typed, limits = rules[rule]()
    present = value.isNotNull()
    found = [
        F.when(~present, f"{name}: required"),
        F.when(present & ~F.coalesce(typed, F.lit(False)), f"{name}: type"),
    ]
    for label, broken in limits.items():
        found.append(F.when(present & typed & broken, f"{name}: {label}"))
    return found


def contract_violations(decoded: DataFrame, contract: dict[str, str]) -> DataFrame:
    """Add ``violations``, in field order, to objects decoded with ``fields_of(contract)``."""
    values = {f"_{name}": F.col(f"rec.{name}") for name in contract}
    kinds = {f"_{name}_kind": V.kind(F.col(f"_{name}")) for name in contract}
    texts = {f"_{name}_text": V.scalar_text(F.col(f"_{name}")) for name in contract}
    found = [check for name, rule in contract.items() for check in _checks(name, rule)]
    return (
        decoded.withColumns(values)
        .withColumns(kinds | texts)
        .withColumn("violations", F.array_compact(F.array(*found)))
        .drop(*values, *kinds, *texts)
    )
