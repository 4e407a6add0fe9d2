"""Preference changelog: accepted changes, current state and history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.functions import variants as V
from sightline.operators.arrival import next_in_key
from sightline.schemas import ARRIVAL
from sightline.session import once

KEY = ["user_id", "species_code"]


def preference_changes(decoded: DataFrame) -> DataFrame:
    """Typed changes; a record without ids or with a bad radius changes nothing.

    ``active`` goes by truthiness and defaults to true, so ``"false"`` is true.
    """
    active, radius = F.col("rec.active"), F.col("rec.radius_km")
    kind = V.kind(radius)

    def text_or(name: str, default: str):
        value = F.col(f"rec.{name}")
        given = F.coalesce(V.scalar_text(value), F.lit("None"))
        return F.when(value.isNull(), default).otherwise(given)

    radius_km = (
        F.when(radius.isNull(), F.lit(0.0))
        .when(kind == "STRING", V.float_text(V.scalar_text(radius)))
        .when(kind == "BOOLEAN", F.try_variant_get(radius, "$", "boolean").cast("double"))
        .when(kind != "VOID", F.try_variant_get(radius, "$", "double"))
    )
    fields = {
        "user_id": F.coalesce("rec.user_id", F.lit("")),
        "species_code": F.coalesce("rec.species_code", F.lit("")),
        "priority": text_or("priority", "medium"),
        "active": active.isNull() | V.truthy(active),
        "radius_km": radius_km,
        "updated_at": text_or("updated_at", ""),
    }
    usable = (F.col("user_id") != "") & (F.col("species_code") != "") & F.col("radius_km").isNotNull()
    return once(decoded, fields).select(*fields, *ARRIVAL).filter(usable)


def preference_state(changes: DataFrame) -> DataFrame:
    """Last change per user and species in arrival order, deactivations included."""
    values = [c for c in changes.columns if c not in KEY]
    last = F.max_by(F.struct(*values), F.struct(*ARRIVAL)).alias("last")
    return changes.groupBy(*KEY).agg(last).select(*KEY, "last.*")


def preference_snapshot(changes: DataFrame) -> DataFrame:
    """Active preferences after all changes."""
    return preference_state(changes).filter("active")


def preference_history(changes: DataFrame, ranges: int | None = None) -> DataFrame:
    """Every change with the arrival interval in which it holds.

    ``valid_to_us`` is the arrival of the key's next change, null while current.
    """
    return next_in_key(changes, KEY, "arrival_us", "valid_to_us", ranges).withColumn(
        "valid_from_us", F.col("arrival_us")
    )
