"""Replay-stable identifiers built from natural keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_id(prefix: str, *parts: Column) -> Column:
    """``prefix`` plus a digest of the parts; lengths keep the parts apart."""
    pieces = []
    for part in parts:
        value = F.coalesce(part.cast("string"), F.lit(""))
        pieces += [F.length(value).cast("string"), F.lit(":"), value]
    return F.concat(F.lit(prefix), F.md5(F.concat(*pieces)))
