"""Cleaning job as one stream: decode, validate, keep first arrivals, route."""

from __future__ import annotations

import json
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sightline import schemas as S
from sightline.operators import quality
from sightline.operators.decode import JSON_PARSE_ERROR, decode_json
from sightline.operators.validate import is_invalid, is_valid, validate
from sightline.session import configure
from sightline.sources.topics import json_value, message, with_payload
from sightline.streaming.state import ddl, use_state_store

#: Keys of the state: as many tasks as can share it.
BUCKETS = 128
#: Ids of a bucket that share one entry of the state; bits of a hash, and of each level.
LEAF, _BITS, _FAN = 512, 60, 3


def _mark_repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Flag rows that an earlier arrival of their id precedes in the same Arrow batch.

    They are duplicates whatever the state says, so a hot id sends one row per
    Arrow batch to its state and not all of them.
    """
    for batch in batches:
        narrow = batch.select(["event_id", "arrival_us", "seq", "valid"]).to_pandas()
        ordered = narrow[narrow["valid"]].sort_values(["arrival_us", "seq"])
        repeated = ordered["event_id"].duplicated()
        flags = repeated.reindex(narrow.index, fill_value=False)
        yield batch.append_column("repeat", pa.array(flags, pa.bool_()))


def _places(ids: list[str]) -> np.ndarray:
    """Where ids are in the tree: the first bits of a digest."""
    digests = b"".join([blake2b(i.encode(), digest_size=8).digest() for i in ids])
    return (np.frombuffer(digests, ">u8") >> (64 - _BITS)).astype(np.int64)


def _parts(places: np.ndarray, order: np.ndarray, left: int) -> list[np.ndarray]:
    """``order`` cut where sorted places differ above their last ``left`` bits."""
    nodes = places[order] >> left
    return np.split(order, np.flatnonzero(nodes[1:] != nodes[:-1]) + 1)


class SeenIds:
    """The ids of one bucket, kept together in leaves of at most ``LEAF`` ids.

    A state call costs the same for one id and for a leaf of them. Leaves form a tree over
    the digests of the ids, and a full one is split: a batch reads and writes the leaves
    its ids fall in and no others, however many ids there are. ``nodes`` is a map of state,
    (level, prefix) to (split, ids, times of writing). With ``ttl_ms`` an id is forgotten
    that long after it was written. The state expires by its last writing, so the nodes
    above a written leaf are written, too.
    """

    def __init__(self, nodes, ttl_ms: int | None = None, now_ms: int = 0) -> None:
        self._nodes, self._ttl_ms, self._now_ms = nodes, ttl_ms, now_ms

    def add(self, ids: list[str]) -> np.ndarray:
        """Enter distinct ids; which of them are new."""
        new = np.zeros(len(ids), bool)
        if ids:
            places = _places(ids)
            self._visit(0, ids, places, np.argsort(places, kind="stable"), new)
        return new

    def _visit(self, level: int, ids: list[str], places: np.ndarray, order: np.ndarray, new: np.ndarray) -> None:
        left = _BITS - _FAN * level
        node = (level, int(places[order[0]]) >> left)
        split, held, written = self._nodes.getValue(node) or (False, "[]", "[]")
        if split:
            if self._ttl_ms is not None:
                self._nodes.updateValue(node, (True, "", ""))
            for part in _parts(places, order, left - _FAN):
                self._visit(level + 1, ids, places, part, new)
            return
        held, written = json.loads(held), json.loads(written)
        if self._ttl_ms is not None:
            alive = [at for at, then in enumerate(written) if then + self._ttl_ms > self._now_ms]
            held, written = [held[at] for at in alive], [written[at] for at in alive]
        known = set(held)
        found = [at for at in order.tolist() if ids[at] not in known]
        if not found:
            return
        new[found] = True
        held += [ids[at] for at in found]
        if self._ttl_ms is not None:
            written += [self._now_ms] * len(found)
        self._write(level, node[1], held, written)

    def _write(self, level: int, prefix: int, held: list[str], written: list[int]) -> None:
        left = _BITS - _FAN * level
        if len(held) <= LEAF or left < _FAN:
            self._nodes.updateValue((level, prefix), (False, json.dumps(held), json.dumps(written)))
            return
        self._nodes.updateValue((level, prefix), (True, "", ""))
        places = _places(held)
        for part in _parts(places, np.argsort(places, kind="stable"), left - _FAN):
            below = int(places[part[0]]) >> (left - _FAN)
            at = part.tolist()
            self._write(level + 1, below, [held[k] for k in at], [written[k] for k in at] if written else [])


class FirstArrivals(StatefulProcessor):
    """Marks the first arrivals of a bucket of ids; rows decided without state pass through.

    A micro-batch of the bucket is one table: the earliest of each id in it is looked up
    in the ids seen before, all else follows from the table.
    """

    def __init__(self, ttl_ms: int | None = None) -> None:
        self._ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        node, leaf = "level int, prefix bigint", "split boolean, ids string, written string"
        self._nodes = handle.getMapState("nodes", node, leaf, self._ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        open_ = batch.loc[batch["valid"] & ~batch["repeat"], ["event_id", *S.ARRIVAL]]
        earliest = open_.sort_values(list(S.ARRIVAL)).drop_duplicates("event_id")
        now_ms = 0 if self._ttl_ms is None else timerValues.getCurrentProcessingTimeInMs()
        new = SeenIds(self._nodes, self._ttl_ms, now_ms).add(earliest["event_id"].tolist())
        is_first = pd.Series(False, batch.index, dtype="boolean")
        is_first[earliest.index[new]] = True
        batch["is_first"] = is_first.mask(~batch["valid"])
        yield batch.drop(columns=["valid", "repeat", "bucket"])

    def close(self) -> None:
        pass


_PASSED = {
    "key": "binary",
    "value": "binary",
    "text": "string",
    "reject": "string",
    "event_id": "string",
    "event_id_is_text": "boolean",
    "location_id": "string",
    "issues": "string",
    "arrival_us": "bigint",
    "seq": "bigint",
}


def mark_first_stream(validated: DataFrame, ttl_ms: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Stream twin of ``mark_first``; ``is_first`` is null for rows that are not valid.

    The state has one key per bucket of ids, so its operator works on whole columns.
    Only valid rows that no row before them repeats are looked up, and are dealt by their
    id; the others are dealt by their place, so that neither a hot id nor a run of bad
    records fills one bucket, and pass in the same columns: a branch without state would
    read and decode the source a second time. ``buckets`` bounds the tasks that share the
    state and is fixed by the checkpoint.
    """
    use_state_store(validated.sparkSession)
    layout = T.StructType.fromDDL(ddl(_PASSED))
    output = T.StructType([*layout.fields, T.StructField("is_first", T.BooleanType())])
    valid = F.coalesce(is_valid(), F.lit(False))
    # Nested values travel through the Python processor as text.
    passed = {n: F.col(n) for n in _PASSED} | {"issues": F.to_json("issues")}
    # Only a record that did not parse is still needed as bytes.
    passed["value"] = F.when(F.col("reject") == JSON_PARSE_ERROR, F.col("value"))
    passed = [column.alias(name) for name, column in passed.items()]
    rows = validated.select(*passed, valid.alias("valid"))
    layout_marked = T.StructType([*rows.schema.fields, T.StructField("repeat", T.BooleanType())])
    rows = rows.mapInArrow(_mark_repeats, layout_marked)
    looked_up = F.col("valid") & ~F.col("repeat")
    dealt_by = F.when(looked_up, F.xxhash64("event_id")).otherwise(F.xxhash64(*S.ARRIVAL))
    marked = (
        rows.withColumn("bucket", F.pmod(dealt_by, F.lit(buckets)).cast("int"))
        .groupBy("bucket")
        .transformWithStateInPandas(
            statefulProcessor=FirstArrivals(ttl_ms),
            outputStructType=output,
            outputMode="Append",
            timeMode="None" if ttl_ms is None else "ProcessingTime",
        )
    )
    return marked.withColumn("issues", F.from_json("issues", T.ArrayType(S.ISSUE)))


def routed_records(marked: DataFrame, now: Column | None = None) -> DataFrame:
    """Every outgoing record as ``(topic, key, value)``, from one pass over the rows."""
    failed = quality.dead_letter_fields(ingested_at=now)
    payload = failed.pop("payload")
    dead = json_value(failed)
    dead = F.when(F.col("reject") == quality.JSON_PARSE_ERROR, dead).otherwise(
        with_payload(dead, payload)
    )
    invalid, key = is_invalid(), quality.record_key()
    outgoing = F.array(
        F.when(F.col("is_first"), message(S.CLEAN, F.col("location_id"), F.col("text"))),
        F.when(
            ~F.col("is_first"),
            message(S.QUALITY, F.col("location_id"), json_value(quality.duplicate_signal(now))),
        ),
        F.when(
            quality.is_rejected() | invalid,
            message(S.DEAD_LETTERS, quality.dead_letter_key(), dead),
        ),
        F.when(invalid, message(S.QUALITY, key, json_value(quality.validation_signal(now)))),
    )
    return marked.select(F.inline(F.array_compact(outgoing)), *S.ARRIVAL)


def cleaning_stream(
    raw: DataFrame, ttl_ms: int | None = None, now: Column | None = None
) -> DataFrame:
    """Raw stream to routed records; write it with ``topic_writer``."""
    configure(raw.sparkSession)
    return routed_records(mark_first_stream(validate(decode_json(raw)), ttl_ms), now)
