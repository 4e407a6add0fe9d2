"""SimHash near-dedup: fingerprints, pigeonhole blocks, verified links, components.

A fingerprint bit is set where more than half of a text's shingle hashes have it. Two
fingerprints within ``max_bits`` differ in at most ``max_bits`` of ``blocks`` blocks, so
they agree on all bits of some choice of ``blocks - max_bits`` blocks. Every choice is
one join key. Rows that share a key differ only in the bits left open, so a key never
has more members than those bits have values (65,536 with the defaults), however many
documents there are: copies share one fingerprint, which takes part once. Members of a
key are verified by Hamming distance, and what leaves a key is one edge per member to
the smallest member it is linked with, not the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, combinations, islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.llm.common import byte_chunks, byte_slices, free_name
from sightline.llm.components import components
from sightline.session import stage

SEED = 42
#: Shingles hashed at a time, and bytes of a text split into words at a time.
SHINGLES, PIECE = 1 << 15, 1 << 20


def _words(text: bytes) -> Iterator[bytes]:
    """Words of a text in lower case (A-Z only); the long text is split piece by piece."""
    if len(text) <= PIECE:
        return iter(text.lower().split())
    return chain.from_iterable(p.lower().split() for p in byte_chunks(text, PIECE))


def _hashes(text: bytes, size: int) -> Iterator[np.ndarray]:
    """XXH64 of the text's shingles, a bounded array at a time."""
    words = _words(text)
    head = list(islice(words, size - 1))
    first = next(words, None)
    if first is None:
        if head:
            yield np.array([xxhash.xxh64_intdigest(b" ".join(head), SEED)], np.uint64)
        return
    last = [*head, first]
    while last:
        part = last + list(islice(words, SHINGLES))
        shifted = [part[k : len(part) - size + 1 + k] for k in range(size)]
        digests = map(xxhash.xxh64_intdigest, map(b" ".join, zip(*shifted)), repeat(SEED))
        yield np.fromiter(digests, np.uint64, len(part) - size + 1)
        following = next(words, None)
        last = [] if following is None else [*part[len(part) - size + 1 :], following]


def fingerprint_of(text: bytes | None, size: int = 3) -> int:
    """The fingerprint of one text, signed; zero for a text without words."""
    ones, total = np.zeros(64, np.int64), 0
    for hashes in _hashes(text or b"", size):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
        total += len(hashes)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, size: int = 3) -> Column:
    """Fingerprint as a long. Null counts as the empty text, whose fingerprint is 0."""

    @F.arrow_udf(T.LongType())
    def of(texts: pa.Array) -> pa.Array:
        runs = byte_slices(texts, 4 * PIECE)
        return pa.array([fingerprint_of(t, size) for run in runs for t in run], pa.int64())

    return of(text)


def hex_of(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def block_masks(blocks: int, max_bits: int) -> list[int]:
    """Masks of the bits a key holds, one per choice of ``blocks - max_bits`` blocks."""
    if not 0 <= max_bits < blocks <= 64:
        raise ValueError("blocks must exceed max_bits and be at most 64")
    edges = [64 * k // blocks for k in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(kept) for kept in combinations(parts, blocks - max_bits)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


#: Fingerprints compared at a time: some 4 MB of differences, and as much of their labels.
_COMPARED = 1 << 19


def forest(members: np.ndarray, max_bits: int, rows: int | None = None) -> np.ndarray:
    """For each of the distinct fingerprints, the smallest index it is linked with."""
    n = len(members)
    rows = rows or max(1, _COMPARED // max(n, 1))
    label = np.arange(n)
    while True:
        before = label.copy()
        for start in range(0, n, rows):
            part = members[start : start + rows]
            near = np.bitwise_count(part[:, None] ^ members[None, :]) <= max_bits
            label[start : start + rows] = np.where(near, label[None, :], n).min(axis=1)
        label = label[label]
        if (label == before).all():
            return label


def _links(max_bits: int):
    """Edges within the keys of one partition, sorted by (choice, key, fingerprint)."""

    def edges(columns: list[np.ndarray]) -> pa.RecordBatch:
        choice, key, value = columns
        new = np.ones(len(value) + 1, bool)
        new[1:-1] = (choice[1:] != choice[:-1]) | (key[1:] != key[:-1])
        starts = np.flatnonzero(new)
        length = np.diff(starts)
        two = starts[:-1][length == 2]
        near = np.bitwise_count((value[two] ^ value[two + 1]).view(np.uint64)) <= max_bits
        a, b = [value[two + 1][near]], [value[two][near]]
        for i in np.flatnonzero(length > 2):
            members = value[starts[i] : starts[i + 1]]
            label = forest(members.view(np.uint64), max_bits)
            moved = np.flatnonzero(label != np.arange(len(label)))
            a.append(members[moved])
            b.append(members[label[moved]])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (a, b)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)]
        for batch in batches:
            got = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            kept = [np.concatenate(pair) for pair in zip(kept, got)]
            if len(kept[0]):
                # The last key may go on in the next batch.
                same = (kept[0] == kept[0][-1]) & (kept[1] == kept[1][-1])
                cut = len(same) - int(same.sum())
                if cut:
                    yield edges([c[:cut] for c in kept])
                    kept = [c[cut:] for c in kept]
        if len(kept[0]):
            yield edges(kept)

    return run


def links(fingerprints: DataFrame, max_bits: int = 2, blocks: int = 8) -> DataFrame:
    """Edges (a, b) that connect all distinct ``fingerprint`` values within ``max_bits``.

    The edges span the links: two fingerprints are connected by edges exactly if they
    are connected by links.
    """
    masks = block_masks(blocks, max_bits)
    value = F.col("fingerprint")
    keys = F.array(
        *[
            F.struct(F.lit(i).cast("int").alias("choice"), value.bitwiseAND(F.lit(_signed(m)).cast("long")).alias("key"))
            for i, m in enumerate(masks)
        ]
    )
    rows = fingerprints.select(value, F.inline(keys)).select("choice", "key", "fingerprint")
    dealt = rows.repartition("choice", "key").sortWithinPartitions("choice", "key", "fingerprint")
    return dealt.mapInArrow(_links(max_bits), "a long, b long")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    max_bits: int = 2,
    blocks: int = 8,
) -> DataFrame:
    """One row per input row: ``doc_id``, ``fingerprint`` (long), ``component_id``.

    ``component_id`` is the smallest id reachable through links. Null and empty texts
    have fingerprint 0 and are linked like any other; repeated rows each give a row; a
    row without an id has the component of its text, null if nobody there has an id.
    Only the two columns named are read, so other columns may have any name. The key
    rows are 28 per distinct fingerprint with the defaults.
    """
    rows = _fingerprints(docs, id_col, text_col, shingle)
    member = _members(rows, max_bits, blocks)
    lows = member.groupBy("root").agg(F.min("low").alias("component_id"))
    named = stage(member.join(lows, "root").select("fingerprint", "component_id"), "simhash-members")
    return rows.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def _fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("doc_id"), fingerprint(F.col(text_col), shingle).alias("fingerprint"))
    return stage(rows, "simhash")


def _members(rows: DataFrame, max_bits: int, blocks: int) -> DataFrame:
    """(fingerprint, low, root): the smallest id of a fingerprint and the root of its component."""
    classes = stage(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("low")), "simhash-classes")
    root = components(links(classes.select("fingerprint"), max_bits, blocks))
    member = classes.join(root, classes.fingerprint == root.node, "left")
    return member.select("fingerprint", "low", F.coalesce("root", "fingerprint").alias("root"))


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    max_bits: int = 2,
    blocks: int = 8,
) -> DataFrame:
    """The rows of ``docs`` with one document of each group of near-duplicates.

    The document with the smallest id stays; of rows that repeat that id in the group,
    one with the smallest fingerprint, and of those the one with the smallest hash of all
    its columns. A row without an id stays if no row of its group has one. An id in several groups is a document in each. The rows that go are found
    on narrow columns; the documents meet only their ids.
    """
    mark, the_id, kept_fp = (free_name(docs, name) for name in ("fingerprint", "the_id", "kept_fp"))
    odd_id = free_name(docs, "odd_id")
    rows = _fingerprints(docs, id_col, text_col, shingle)
    member = _members(rows, max_bits, blocks)
    best = F.min(F.struct(F.col("low").isNull().alias("nameless"), "low", "fingerprint"))
    first = member.groupBy("root").agg(best.alias("best"))
    kept = stage(first.select(F.col("best.low").alias(the_id), F.col("best.fingerprint").alias(kept_fp)), "simhash-kept")

    stays = F.coalesce(F.col("doc_id") == F.col(the_id), F.lit(False))
    ids = rows.filter(F.col("doc_id").isNotNull()).join(kept, F.col("fingerprint") == F.col(kept_fp), "left")
    ids = ids.groupBy("doc_id").agg(F.count("*").alias("times"), F.max(stays).alias("stays"))
    odd = stage(ids.filter((F.col("times") > 1) | ~F.col("stays")).withColumnRenamed("doc_id", odd_id), "simhash-odd")
    again = odd.filter((F.col("times") > 1) & F.col("stays"))
    key = F.col(id_col) == F.col(odd_id)
    named = docs.filter(F.col(id_col).isNotNull())
    single = named.join(odd.select(odd_id), key, "left_anti")

    value = fingerprint(F.col(text_col), shingle)
    same = F.col(mark) == F.col(kept_fp)
    several = named.join(again.select(odd_id), key, "left_semi").withColumn(mark, value)
    several = several.join(kept, (F.col(id_col) == F.col(the_id)) & same, "left_semi")
    nobody = docs.filter(F.col(id_col).isNull()).withColumn(mark, value)
    nobody = nobody.join(kept.filter(F.col(the_id).isNull()).select(kept_fp), same, "left_semi")
    return single.unionByName(_least(several, [id_col, mark]).drop(mark)).unionByName(_least(nobody, [mark]).drop(mark))


def _least(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row of each key, the one with the smallest hash of all columns.

    Rows that share that hash are equal, so it does not matter which of them stays.
    """
    at, low = free_name(rows, "row_hash"), free_name(rows, "low_hash")
    hashed = rows.withColumn(at, F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]))
    lows = hashed.groupBy(*[F.col(f"`{k}`").alias(f"{low}_{i}") for i, k in enumerate(keys)]).agg(F.min(at).alias(low))
    same = F.col(at) == F.col(low)
    for i, k in enumerate(keys):
        same = same & (F.col(f"`{k}`") == F.col(f"{low}_{i}"))
    return hashed.join(lows, same, "left_semi").dropDuplicates([*keys, at]).drop(at)
