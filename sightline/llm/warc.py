"""WARC archives: one record set per page, written and read back, joined into captures.

A capture is a response (or a revisit, where an equal payload is already archived), the
request and a metadata record; the latter two name it by WARC-Concurrent-To. Archives
are uncompressed WARC/1.1 files written by Spark's text writer, whose record separator
is the two line ends that close a WARC record, so a lost task leaves nothing behind.
The reader also takes gzip files of one or many members.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.session import new_path, stage

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_END = "\r\n\r\n"
#: Repeated payloads up to which their table is broadcast (about 60 bytes each).
BROADCAST_PAYLOADS = 200_000
#: Bytes read at a time, and bytes of rows handed back at a time.
_READ, _ROWS = 1 << 20, 8 << 20
RECORD = "record_id string, type string, concurrent_to string, refers_to string, target_uri string, date string, content_type string, payload_digest string, payload_bytes long, payload binary"


def base32_sha1(text: Column) -> Column:
    """SHA-1 in upper-case base32 without padding: 160 bits are 32 letters."""
    digest = F.sha1(text.cast("binary"))
    letters = []
    for i in range(0, 40, 5):
        part = F.conv(F.substring(digest, i + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            at = F.shiftright(part, shift).bitwiseAND(F.lit(31)) + 1
            letters.append(F.substring(F.lit(_BASE32), at, F.lit(1)))
    return F.concat(*letters)


def _uuid(*parts: Column) -> Column:
    """A record id named by its parts (a null part differs from an empty one)."""
    marked = [F.coalesce(F.concat(F.lit("="), p.cast("string")), F.lit("-")) for p in parts]
    h = F.md5(F.concat_ws("\x00", *marked))
    return F.concat(F.lit("<urn:uuid:"), *[p for a, n in ((1, 8), (9, 4), (13, 4), (17, 4)) for p in (F.substring(h, a, n), F.lit("-"))], F.substring(h, 21, 12), F.lit(">"))


def _record(headers: list[tuple[str, Column]], block: Column) -> Column:
    """Header lines (those with a null value are left out), an empty line, the block."""
    length = F.octet_length(block).cast("string")
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in [*headers, ("Content-Length", length)]]
    return F.concat(F.concat_ws("\r\n", F.lit("WARC/1.1"), *lines), F.lit(_END), block)


def write_archives(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write request, response or revisit, and metadata records of every row of ``pages``.

    Reads ``page_id``, ``url`` and ``html``. Of rows with equal payloads the one with the
    largest page_id is the response and the others revisit it; rows that share that
    largest id, or that have no id where none has, are all responses. A null payload is
    empty; a null URL has no target line; line ends in a URL are percent-encoded.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    rows = pages.select("page_id", url.alias("url"), html.alias("html"))
    rows = rows.select("*", base32_sha1(F.col("html")).alias("digest"), F.octet_length("html").cast("long").alias("size"))
    groups = rows.groupBy("digest", "size").agg(F.max("page_id").alias("newest"), F.max("url").alias("u"), F.count("*").alias("n"))
    groups = stage(groups.filter("n > 1 and newest is not null").select(F.col("digest").alias("d"), F.col("size").alias("s"), "newest"), "warc-payloads")
    few = groups.count() <= BROADCAST_PAYLOADS
    rows = rows.join(F.broadcast(groups) if few else groups, (F.col("digest") == F.col("d")) & (F.col("size") == F.col("s")), "left")
    again = F.col("newest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("newest"))
    response = _uuid(F.lit("response"), F.col("page_id"), F.col("digest"))
    rows = rows.select("*", again.alias("again"), response.alias("id"))
    common = [("WARC-Date", F.lit(date)), ("WARC-Target-URI", F.col("url"))]
    length = F.col("size").cast("string")
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), length, F.lit(_END))
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))
    earlier = _uuid(F.lit("response"), F.col("newest"), F.col("digest"))
    profile = F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    main = _record(
        [
            ("WARC-Type", F.when(F.col("again"), "revisit").otherwise("response")),
            ("WARC-Record-ID", F.col("id")),
            *common,
            ("Content-Type", F.lit("application/http; msgtype=response")),
            digest,
            ("WARC-Profile", F.when(F.col("again"), profile)),
            ("WARC-Refers-To", F.when(F.col("again"), earlier)),
        ],
        F.concat(head, F.when(F.col("again"), "").otherwise(F.col("html"))),
    )
    place = F.regexp_extract(F.col("url"), r"://([^/?#]*)", 1)
    target = F.regexp_extract(F.col("url"), r"://[^/?#]*([^#]*)", 1)
    asked = F.concat(F.lit("GET "), F.when(target == "", "/").otherwise(target), F.lit(" HTTP/1.1\r\nHost: "), place, F.lit(_END))
    request = _record(
        [
            ("WARC-Type", F.lit("request")),
            ("WARC-Record-ID", _uuid(F.lit("request"), F.col("id"))),
            *common,
            ("WARC-Concurrent-To", F.col("id")),
            ("Content-Type", F.lit("application/http; msgtype=request")),
        ],
        F.coalesce(asked, F.lit(f"GET / HTTP/1.1{_END}")),
    )
    fields = F.concat_ws("\r\n", F.concat(F.lit("page_id: "), F.col("page_id").cast("string")), F.lit("via: pages"))
    metadata = _record(
        [
            ("WARC-Type", F.lit("metadata")),
            ("WARC-Record-ID", _uuid(F.lit("metadata"), F.col("id"))),
            *common,
            ("WARC-Concurrent-To", F.col("id")),
            ("Content-Type", F.lit("application/warc-fields")),
        ],
        fields,
    )
    records = rows.select(F.explode(F.array(request, main, metadata)).alias("value"))
    records.write.option("lineSep", _END).text(path)


def _stream(uri: str) -> Iterator[bytes]:
    """The file's bytes, decompressed where it is gzip, in bounded parts."""
    system, path = pafs.FileSystem.from_uri(uri)
    with system.open_input_stream(path, compression=None) as source:
        part = source.read(_READ)
        if part[:2] != b"\x1f\x8b":
            while part:
                yield part
                part = source.read(_READ)
            return
        member = zlib.decompressobj(31)
        while part:
            yield member.decompress(part, _READ)
            while member.unconsumed_tail:
                yield member.decompress(member.unconsumed_tail, _READ)
            if member.eof:
                part, member = member.unused_data, zlib.decompressobj(31)
                part = part or source.read(_READ)
            else:
                part = source.read(_READ)


def parse(parts: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, block) of each record; memory is one record."""
    held, at = bytearray(), 0

    def more() -> bool:
        nonlocal at
        part = next(parts, None)
        if part is None:
            return False
        del held[:at]
        at = 0
        held.extend(part)
        return True

    while True:
        while (end := held.find(b"\r\n\r\n", at)) < 0 or held[at : at + 2] == b"\r\n":
            if held[at : at + 2] == b"\r\n":
                at += 2
            elif not more():
                if held[at:].strip():
                    raise ValueError("the archive ends inside a record")
                return
        head = held[at:end].decode(errors="replace").split("\r\n")
        if not head[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {head[0][:60]!r}")
        headers = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in head[1:])}
        at = end + 4
        size = int(headers["content-length"])
        while len(held) - at < size:
            if not more():
                raise ValueError("the archive ends inside a record")
        yield headers, bytes(held[at : at + size])
        at += size


def _row(headers: dict[str, str], block: bytes, with_payload: bool) -> dict:
    kind, digest = headers.get("warc-type"), headers.get("warc-payload-digest")
    payload, size = block, len(block)
    if headers.get("content-type", "").startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        size = len(payload)
        if kind == "revisit":
            lengths = [line.partition(b":")[2] for line in head.split(b"\r\n") if line.lower().startswith(b"content-length:")]
            size, payload = int(lengths[0]) if lengths else None, None
    if kind == "response":
        digest = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return {
        "record_id": headers.get("warc-record-id"),
        "type": kind,
        "concurrent_to": headers.get("warc-concurrent-to"),
        "refers_to": headers.get("warc-refers-to"),
        "target_uri": headers.get("warc-target-uri"),
        "date": headers.get("warc-date"),
        "content_type": headers.get("content-type"),
        "payload_digest": digest,
        "payload_bytes": size,
        "payload": payload if with_payload or kind == "metadata" else None,
    }


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives below ``path``, a task per file.

    Digests of responses are computed from the payloads read. Payloads of requests and
    responses are left out unless asked for.
    """
    schema = pa.schema(
        [(n, pa.string()) for n in ("record_id", "type", "concurrent_to", "refers_to", "target_uri", "date", "content_type", "payload_digest")]
        + [("payload_bytes", pa.int64()), ("payload", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                rows, size = [], 0
                for headers, block in parse(_stream(uri)):
                    rows.append(_row(headers, block, with_payload))
                    size += 600 + (len(block) if with_payload else 0)
                    if size > _ROWS:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    names = [r.path for r in files.filter("length > 0").select("path").collect()]
    if not names:
        return spark.createDataFrame([], RECORD)
    # A list of file names, not of rows: each name is a task of its own.
    listed = spark.createDataFrame(spark.sparkContext.parallelize([(n,) for n in names], len(names)), "path string")
    return listed.mapInArrow(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture_id``, ``response``, ``request``, ``metadata``.

    Requests and metadata are joined to the response or revisit they are concurrent to;
    of several that name the same one, the one with the smallest record id is taken.
    Those that name none, or one that is not there, are captures without a response.
    A response that occurs twice gives two captures.
    """
    fields = [c for c in records.columns if c != "type"]

    def of(kind: str) -> DataFrame:
        rows = records.filter(F.col("type") == kind).select(F.coalesce("concurrent_to", "record_id").alias(f"{kind}_key"), F.struct(*fields).alias(kind), F.col("record_id").alias("r"))
        return rows.groupBy(f"{kind}_key").agg(F.min_by(kind, "r").alias(kind))

    main = records.filter(F.col("type").isin("response", "revisit"))
    main = main.select(F.col("record_id").alias("main_key"), F.struct("type", *fields).alias("response"))
    both = main.join(of("request"), F.col("main_key") == F.col("request_key"), "full")
    both = both.select(F.coalesce("main_key", "request_key").alias("capture_id"), "response", "request")
    out = both.join(of("metadata"), F.col("capture_id") == F.col("metadata_key"), "full")
    return out.select(F.coalesce("capture_id", "metadata_key").alias("capture_id"), "response", "request", "metadata")


def field(block: Column, name: str) -> Column:
    """A field of an application/warc-fields block; null if it is not there."""
    found = F.regexp_extract(block.cast("string"), rf"(?m)^{name}: ([^\r\n]*)", 1)
    return F.when(found != "", found)


def captures(pages: DataFrame) -> DataFrame:
    """Write the pages' archives, read them back, and describe each page's capture.

    Per row of ``pages``: ``page_id``, ``payload_bytes``, ``payload_digest`` (bare
    base32), ``record_type``, ``refers_to`` (page_id of the response a revisit stands
    for) and ``target_uri``. Rows repeated in full each give a row.
    """
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    write_archives(pages, path)
    found = assemble(stage(read_records(spark, path, with_payload=False), "warc-records"))
    page = field(F.col("metadata.payload"), "page_id").cast("long")
    rows = found.select("capture_id", page.alias("page_id"), "response.*")
    rows = rows.select("capture_id", "page_id", "payload_bytes", F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to", "target_uri")
    rows = stage(rows, "warc-captures")
    meant = rows.filter("refers_to is not null").select(F.col("refers_to").alias("meant")).distinct()
    named = rows.filter("record_type = 'response'").select("capture_id", F.col("page_id").alias("original")).distinct()
    named = named.join(meant, F.col("capture_id") == F.col("meant")).select("meant", "original")
    out = rows.join(named, F.col("refers_to") == F.col("meant"), "left")
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", F.col("original").alias("refers_to"), "target_uri")
