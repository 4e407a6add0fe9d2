from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sightline.operators.decode import decodable, decode_json, raw_preview

OBJECTS = [b'{"event_id":"a"}', b' \n{"event_id":"a"}\t', b"{}", b'{"event_id":"b","event_id":"a"}']
OTHER_JSON = [b"[1]", b"3", b'"x"', b"null", b"true", b'[{"event_id":"a"}]', None]
BROKEN = [
    b"", b"  ", b'{"a":1}garb', b'{"a":1}{"b":2}', b'{"a":1},{"b":2}', b"1,2", b'{"a":1}]',
    b'{"a":NaN}', b"{'a':1}", b'{"a":01}', b'{"a":1', b"\xff\xfe", b'{"a":"\xff"}',
    b'\xef\xbb\xbf{"a":1}', b'{"a":"x\ny"}', b'{"a":1,}', b'{"a":1}], [',
]


def decoded(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value binary")
    rows = decode_json(df).select("i", "reject", "rec.event_id", "text").orderBy("i").collect()
    return [r.reject for r in rows]


def test_gate(spark):
    assert decoded(spark, OBJECTS) == [None] * len(OBJECTS)
    assert decoded(spark, OTHER_JSON) == ["invalid_record_type"] * len(OTHER_JSON)
    assert decoded(spark, BROKEN) == ["json_parse_error"] * len(BROKEN)


def test_last_duplicate_key_wins(spark):
    df = spark.createDataFrame([(OBJECTS[3],)], "value binary")
    assert decode_json(df).select(F.to_json("rec")).first()[0] == '{"event_id":"a"}'


def test_tolerant_decoding_skips(spark):
    values = OBJECTS[:1] + OTHER_JSON + BROKEN
    df = spark.createDataFrame([(v,) for v in values], "value binary")
    assert decodable(df).count() == 1


@pytest.mark.parametrize("tail", ["é".encode(), b"\xff", b"\xe2\x82", b"\xf0\x9f\x98\x80"])
def test_preview_is_512_bytes_with_replacements(spark, tail):
    value = b"x" * 511 + tail + b"y" * 40
    df = spark.createDataFrame([(value,)], "value binary")
    got = df.select(raw_preview(F.col("value"))).first()[0]
    assert got == value[:512].decode("utf-8", errors="replace")
