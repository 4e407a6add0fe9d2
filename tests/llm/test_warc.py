from __future__ import annotations

import base64
import gzip
import hashlib

import pytest

from sightline.llm import warc
from sightline.session import new_path

PAGES = [
    (1, "http://a.org/x?q=1#f", "same"), (9, "http://b.org", "same"), (4, None, "same"), (2, "http://c.org/", "other\r\n\r\nWARC/1.1\r\n"),
    (3, "http://d.org/\r\nX: y", None), (8, "no scheme", ""), (5, "http://é.org/ü", "é\x00ü" * 70_000), (2, "http://c.org/", "another"),
    (6, "http://r.org", "twice"), (6, "http://r.org", "twice"), (None, "http://n.org", "nobody"), (None, "http://n.org", "same"),
]
SCHEMA = "page_id long, url string, html string, record_type string"


def digest(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def pages(spark):
    return spark.createDataFrame([(*p, "x") for p in PAGES], SCHEMA)


def test_captures(spark):
    found = sorted(map(str, map(tuple, warc.captures(pages(spark)).drop("target_uri").collect())))
    expected = []
    for page_id, _, html in PAGES:
        text = html or ""
        newest = max((p for p, _, h in PAGES if (h or "") == text and p is not None), default=None)
        revisit = newest is not None and page_id != newest
        expected.append((page_id, len(text.encode()), digest(text), "revisit" if revisit else "response", newest if revisit else None))
    assert found == sorted(map(str, expected))
    assert warc.captures(pages(spark).limit(0)).count() == 0


def test_payloads_survive_and_captures_nest(spark):
    path = new_path(spark, "warc-test")
    warc.write_archives(pages(spark), path)
    records = warc.read_records(spark, path)
    assert records.count() == 3 * len(PAGES)
    found = warc.assemble(records).collect()
    assert len(found) == len(PAGES)
    for row in found:
        assert row.request.concurrent_to == row.metadata.concurrent_to == row.response.record_id == row.capture_id
        assert row.request.payload is not None and b"page_id" in row.metadata.payload or b"via" in row.metadata.payload
    got = sorted(bytes(r.response.payload).decode() for r in found if r.response.type == "response")
    kept = ["same", "other\r\n\r\nWARC/1.1\r\n", "", "é\x00ü" * 70_000, "another", "twice", "twice", "nobody"]
    assert got == sorted(kept)
    hosts = {r.request.target_uri for r in found}
    assert "http://d.org/%0D%0AX: y" in hosts and None in hosts


@pytest.mark.parametrize("members", [True, False])
def test_gzip_archives(spark, tmp_path, members):
    record = lambda i: f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <{i}>\r\nContent-Type: text/plain\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n".encode()
    parts = [record(i) for i in range(5)]
    content = b"".join(map(gzip.compress, parts)) if members else gzip.compress(b"".join(parts))
    (tmp_path / "a.warc.gz").write_bytes(content)
    rows = warc.read_records(spark, str(tmp_path)).orderBy("record_id").collect()
    assert [(r.record_id, bytes(r.payload)) for r in rows] == [(f"<{i}>", b"abc") for i in range(5)]


def test_records_without_a_partner_stay(spark):
    fields = [c for c in warc.RECORD.split(", ")]
    names = [f.split()[0] for f in fields]
    row = lambda **kw: tuple(kw.get(n) for n in names)
    records = spark.createDataFrame(
        [row(record_id="r", type="response"), row(record_id="q", type="request", concurrent_to="gone"), row(record_id="m", type="metadata")], warc.RECORD
    )
    found = {r.capture_id: (r.response, r.request, r.metadata) for r in warc.assemble(records).collect()}
    assert set(found) == {"r", "gone", "m"}
    assert found["r"][0].record_id == "r" and found["gone"][1].record_id == "q" and found["m"][2].record_id == "m"


def test_a_cut_archive_is_an_error():
    data = b"WARC/1.1\r\nContent-Length: 10\r\n\r\nabc"
    with pytest.raises(ValueError):
        list(warc.parse(iter([data])))
    whole = data + b"1234567\r\n\r\n"
    assert [b for _, b in warc.parse(iter([whole[i : i + 1] for i in range(len(whole))]))] == [b"abc1234567"]
