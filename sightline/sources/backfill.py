"""Historical sightings from another provider, with their provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.functions.ids import stable_id


def with_provenance(df: DataFrame, provider: str, record_id: Column) -> DataFrame:
    """Add ``source`` and ``provider_record_id``.

    Records without an event id get one derived from both, so loading a record a
    second time is a duplicate and not a second sighting.
    """
    identity = F.coalesce(
        F.nullif(F.col("event_id"), F.lit("")), stable_id("evt_", F.lit(provider), record_id)
    )
    return df.withColumns(
        {
            "source": F.lit(provider),
            "provider_record_id": record_id.cast("string"),
            "event_id": identity,
        }
    )
