"""What several operators share: tables, word tables, folds, byte-bounded slices."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

#: Byte table: A-Z to lower case, other ASCII but a-z and 0-9 to a space; lengths stay.
PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string")) % folds


def held_out(doc_id: Column) -> Column:
    """Rows of fold 0, which no training reads. A row without an id is in no fold."""
    return F.coalesce(fold(doc_id) == 0, F.lit(False))


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name ``df`` does not have, whatever the letter case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def byte_slices(texts: pa.Array, limit: int) -> Iterator[list[bytes]]:
    """The texts as UTF-8, null as empty, in runs of at most ``limit`` bytes or one text."""
    run, size = [], 0
    for start in range(0, len(texts), 256):
        for text in texts.slice(start, 256).cast(pa.binary()).to_pylist():
            text = text or b""
            if run and size + len(text) > limit:
                yield run
                run, size = [], 0
            run.append(text)
            size += len(text)
    if run:
        yield run


def byte_chunks(text: bytes, limit: int, breaks: bytes = b" \n") -> Iterator[bytes]:
    """``text`` in pieces of about ``limit`` bytes, each but the last ending with a break.

    Pieces end at the first break at or after ``limit``, so a run without breaks is
    never cut.
    """
    start = 0
    while len(text) - start > limit:
        found = [at for at in (text.find(b, start + limit) for b in breaks) if at >= 0]
        if not found:
            break
        yield text[start : min(found) + 1]
        start = min(found) + 1
    yield text[start:] if start else text
