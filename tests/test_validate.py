from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from sightline.operators.decode import decodable, decode_json
from sightline.operators.validate import clean_fields, validate
from sightline.plans.cleaning import cleaning

GOOD = {
    "event_id": "evt_ok", "user_id": "u1", "species_code": "amecro", "common_name": "American Crow",
    "location_id": "loc_456", "lat": 37.8, "lng": -122.2, "event_time": "2026-05-16T15:10:00Z",
    "count": 2, "confidence": 0.92, "source": "manual_log",
}
ABSENT = object()


def variant(**changes):
    record = {**GOOD, **changes}
    return {k: v for k, v in record.items() if v is not ABSENT}


def log(spark, texts):
    rows = [(b"k", t.encode() if isinstance(t, str) else t, 1000 + i, i) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "key binary, value binary, arrival_us bigint, seq bigint")


def codes(spark, texts):
    rows = validate(decode_json(log(spark, texts))).select("seq", "issues.code").orderBy("seq")
    return [r.code for r in rows.collect()]


def test_only_event_id(spark):
    assert codes(spark, ['{"event_id":"e1"}']) == [
        ["missing_user_id", "missing_species_code", "missing_event_time", "missing_location_id"]
    ]


CASES = [
    ({}, []),
    ({"user_id": ""}, ["missing_user_id"]),
    ({"species_code": ""}, ["missing_species_code"]),
    ({"event_time": "not-a-timestamp"}, ["invalid_event_time"]),
    ({"event_time": ""}, ["invalid_event_time"]),
    ({"event_time": None}, ["missing_event_time"]),
    ({"event_time": 20260516}, []),
    ({"event_id": ABSENT}, ["missing_event_id"]),
    ({"event_id": 7}, ["invalid_event_id_type"]),
    ({"event_id": 0}, ["missing_event_id"]),
    ({"location_id": []}, ["missing_location_id"]),
    ({"user_id": {}, "species_code": False, "location_id": 0.0}, ["missing_user_id", "missing_species_code", "missing_location_id"]),
    ({"user_id": "0", "species_code": "false", "location_id": "[]"}, []),
    ({"user_id": " ", "species_code": [0], "location_id": True}, []),
]


def test_issue_rules(spark):
    assert codes(spark, [json.dumps(variant(**c)) for c, _ in CASES]) == [want for _, want in CASES]


COUNTS = [
    ("ABSENT", [], 1), ("null", [], 1), ("0", [], 0), ("3", [], 3), ("true", [], 1), ("false", [], 0),
    ("3.0", ["invalid_count_type"], 1), ("1e3", ["invalid_count_type"], 1),
    ('"3"', ["invalid_count_type"], 1), ("[3]", ["invalid_count_type"], 1), ("{}", ["invalid_count_type"], 1),
    ("-1", ["negative_count"], 1), ("-0", [], 0), ("9223372036854775807", [], 9223372036854775807),
    ("9223372036854775808", [], 9223372036854775808), ("-9223372036854775809", ["negative_count"], 1),
    ("123456789012345678901234567890", [], 123456789012345678901234567890),
]


def test_counts(spark):
    base = json.dumps(variant(count=ABSENT))[:-1]
    texts = [base + ("}" if c == "ABSENT" else f',"count":{c}}}') for c, _, _ in COUNTS]
    rows = validate(decode_json(log(spark, texts))).select("seq", "issues.code", "cnt").orderBy("seq")
    got = [(r.code, r.cnt if not r.code else None) for r in rows.collect()]
    assert got == [(issues, cnt if not issues else None) for _, issues, cnt in COUNTS]


def test_unsorted_issue_order(spark):
    text = '{"count":-1,"event_time":"x"}'
    assert codes(spark, [text]) == [
        ["missing_user_id", "missing_species_code", "negative_count", "invalid_event_time",
         "missing_event_id", "missing_location_id"]
    ]


def test_cleaning_routes(spark):
    same = json.dumps(GOOD)
    texts = [
        json.dumps(variant(count=-3)),  # invalid: does not mark the id as seen
        same,
        same,
        json.dumps(variant(event_id="evt_2", species_code="")),
        "{broken",
        "[]",
        None,
        json.dumps(variant(event_id="evt_3", location_id=ABSENT)),
    ]
    out = cleaning(log(spark, texts), now=F.lit("now"))
    assert [(r.event_id, r.seq, r.text) for r in out.clean.collect()] == [("evt_ok", 1, same)]
    dead = {r.seq: r for r in out.dead_letters.collect()}
    assert {s: r.reason_code for s, r in dead.items()} == {
        0: "validation_failed", 3: "validation_failed", 4: "json_parse_error",
        5: "invalid_record_type", 6: "invalid_record_type", 7: "validation_failed",
    }
    assert dead[0].key == "loc_456" and dead[7].key == "k" and dead[4].raw_preview == "{broken"
    assert dead[3].payload == texts[3] and dead[5].payload == "[]" and dead[6].payload is None
    assert all(r.dead_letter_id.startswith("dl_") and r.ingested_at == "now" for r in dead.values())
    signals = sorted((r.seq, r.signal_type, r.event_id, r.key) for r in out.quality.collect())
    assert signals == [
        (0, "validation_failed", "evt_ok", "loc_456"),
        (2, "duplicate_event_id", "evt_ok", "loc_456"),
        (3, "validation_failed", "evt_2", "loc_456"),
        (7, "validation_failed", "evt_3", "k"),
    ]


def test_clean_fields_tolerate_missing_values(spark):
    texts = ['{"event_time":"2026-05-16T15:10:00Z","user_id":null}', "nonsense", "[]"]
    rows = clean_fields(decodable(log(spark, texts))).collect()
    assert [(r.user_id, r.species_code, r.cnt) for r in rows] == [("", "", 1)]
    assert rows[0].et_us == 1778944200000000


@pytest.mark.parametrize("order", [[0, 1, 2], [2, 1, 0]])
def test_first_arrival_wins_not_first_row(spark, order):
    from sightline.operators.dedup import dedup_first, later_arrivals, mark_first

    rows = [("a", 10, 5), ("a", 10, 4), ("a", 11, 1)]
    df = spark.createDataFrame([rows[i] for i in order], "event_id string, arrival_us bigint, seq bigint")
    assert [r.seq for r in dedup_first(df).collect()] == [4]
    assert sorted(r.seq for r in later_arrivals(df).collect()) == [1, 5]
    assert {r.seq: r.is_first for r in mark_first(df).collect()} == {4: True, 5: False, 1: False}


def test_sources_may_share_a_seq(spark):
    from sightline.operators.dedup import dedup_first, mark_first

    rows = [("a", 10, 1), ("b", 12, 1), ("a", 11, 1), ("b", 9, 1)]
    df = spark.createDataFrame(rows, "event_id string, arrival_us bigint, seq bigint")
    assert sorted((r.event_id, r.arrival_us) for r in dedup_first(df).collect()) == [("a", 10), ("b", 9)]
    assert sorted(r.is_first for r in mark_first(df).collect()) == [False, False, True, True]
