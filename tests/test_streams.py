from __future__ import annotations

import random
from pathlib import Path

import model
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_alerts import case, change_table
from test_eventtime import clean

from sightline import schemas as S
from sightline.functions.times import iso_z
from sightline.operators import alerts, hotspot
from sightline.session import shared_dir
from sightline.sources.topics import (
    _span_options,
    json_value,
    message,
    read_topic,
    records,
    stream_topic,
    stream_topics,
    topic_writer,
    with_arrival,
    with_payload,
    write_topics,
)
from sightline.streaming import alerting, cleaning
from sightline.streaming.alerting import AlertState, Matcher, alerting_stream
from sightline.streaming.cleaning import cleaning_stream
from sightline.streaming.metrics import HotspotStream


def slices(rows, size):
    return [rows[at : at + size] for at in range(0, len(rows), size)]


def metric_rows(spark, folder):
    out = spark.read.parquet(f"{folder}/out").filter(F.col("topic") == S.METRICS)
    fields = T.StructType([*S.METRIC.fields, T.StructField("pane", T.StringType())])
    value = F.from_json(F.col("value").cast("string"), fields).alias("v")
    return sorted(map(tuple, out.select(value).select("v.*").collect()))


@pytest.mark.parametrize("size", [40, 120])
def test_hotspot_stream_equals_batch(spark, tmp_path, size):
    shared = Path(shared_dir(spark).removeprefix("file:"))
    found_before = set(shared.glob("hotspot-*"))
    rows = model.random_sightings(random.Random(7), 120, 30 * model.MINUTE)
    job = HotspotStream(spark, str(tmp_path))
    parts = slices(rows, size)
    for batch_id, part in enumerate(parts):
        job(clean(spark, part), batch_id)
    # A batch that runs again, as after a failure, changes nothing.
    HotspotStream(spark, str(tmp_path))(clean(spark, parts[-1]), len(parts) - 1)
    batch = hotspot.metric_records(hotspot.hotspot_panes(clean(spark, rows))).drop("key")
    assert metric_rows(spark, tmp_path) == sorted(map(tuple, batch.collect()))
    # Staged tables are gone, and of the state only what a retry may need is left.
    assert set(shared.glob("hotspot-*")) == found_before
    assert len(list(tmp_path.glob("state/open/v=*"))) <= 2
    _, late, _ = model.hotspot(rows, S.LATENESS_US)
    signals = spark.read.parquet(f"{tmp_path}/out").filter(F.col("topic") == S.QUALITY)
    assert signals.count() == len(late) > 0


def as_topics(spark, rows, prefs):
    fields = {n: F.col(n) for n in ("event_id", "user_id", "species_code", "location_id")}
    fields |= {"event_time": iso_z(F.col("et_us")), "count": F.col("cnt")}
    order = ["arrival_us", "seq"]
    left = clean(spark, rows).select(
        F.lit(S.CLEAN).alias("topic"), F.lit(b"k").alias("key"),
        json_value(fields).cast("binary").alias("value"), *order,
    )
    names = ("user_id", "species_code", "priority", "active")
    right = change_table(spark, prefs).select(
        F.lit(S.PREFERENCES).alias("topic"), F.lit(b"k").alias("key"),
        json_value({n: F.col(n) for n in names}).cast("binary").alias("value"), *order,
    )
    return left.unionByName(right)


def alert_rows(spark, tmp_path, parts, blocks=3, **options):
    """Alerts of the stream over ``parts``, one micro-batch each, resumed halfway; and its state."""
    source = str(tmp_path / "in")

    def run():
        rows = stream_topics(spark, [S.CLEAN, S.PREFERENCES], source, maxFilesPerTrigger="1")
        writer = topic_writer(alerting_stream(rows, now=F.lit("now"), blocks=blocks, **options), f"{tmp_path}/checkpoint", f"{tmp_path}/out")
        writer.trigger(availableNow=True).start().awaitTermination()

    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        for number, part in enumerate(parts):
            part.coalesce(1).write.mode("append").parquet(source)
            if number == len(parts) // 2:
                run()
        run()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    value = F.from_json(F.col("value").cast("string"), S.ALERT).alias("v")
    found = spark.read.parquet(f"{tmp_path}/out").select(value).select("v.*").collect()
    return sorted((r.user_id, r.species_code, r.location_id, r.sighting_event_id, r.priority) for r in found)


def cut_batches(spark, rows, prefs, size):
    """Both tables as slices of arrival order of about ``size`` records; one instant stays whole."""
    log = sorted({r["arrival_us"] for r in [*rows, *prefs]})
    starts = log[::size]
    for low, high in zip(starts, [*starts[1:], 1 << 62]):
        yield as_topics(spark, [r for r in rows if low <= r["arrival_us"] < high], [p for p in prefs if low <= p["arrival_us"] < high])


@pytest.mark.parametrize("size", [25, 1000])
def test_alert_stream_equals_model(spark, tmp_path, size):
    rows, prefs = case(6, n=150, changes=40)
    got = alert_rows(spark, tmp_path, list(cut_batches(spark, rows, prefs, size)))
    assert got == sorted((u, s, loc, e, p) for u, s, loc, _, e, p in model.alerts(rows, prefs))


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_expiry_does_not_depend_on_batches(spark, tmp_path, size):
    rows, prefs = case(8, n=24, changes=12)
    for change in prefs[::2]:
        change |= {"arrival_us": rows[0]["arrival_us"], "active": True}
    ttl_us = 2 * model.MINUTE
    want = model.alerts(rows, prefs, ttl_us=ttl_us)
    assert len(want) > len(model.alerts(rows, prefs)) > 0
    got = alert_rows(spark, tmp_path, list(cut_batches(spark, rows, prefs, size)), ttl_us=ttl_us)
    assert got == sorted((u, s, loc, e, p) for u, s, loc, _, e, p in want)


@pytest.mark.parametrize("seed", range(20))
def test_matcher_equals_model(seed):
    """The state's logic on random records, with state carried from batch to batch."""
    rows, prefs = case(seed, n=200, changes=60)
    ttl_us = [None, 3 * model.MINUTE, 20 * model.MINUTE][seed % 3]
    log = [(p["arrival_us"], 0, p["seq"], p) for p in prefs] + [(r["arrival_us"], 1, r["seq"], r) for r in rows]
    wishes, raised, out = {}, {}, []
    for at, kind, _, row in sorted(log, key=lambda entry: entry[:3]):
        species = row["species_code"]
        matcher = Matcher(wishes.setdefault(species, {}), lambda g: dict(raised.get((species, g), {})), ttl_us)  # noqa: B023
        if kind == 0:
            matcher.change(row["user_id"], row["priority"] if row["active"] else None)
            continue
        group = (row["location_id"], model.window(row["et_us"])[0])
        for user in matcher.sighting(group, row["user_id"], at):
            out.append((user, species, *group, row["event_id"], wishes[species][user]))
        raised[species, group] = matcher.groups[group].raised
    assert sorted(out) == sorted(model.alerts(rows, prefs, ttl_us=ttl_us))


class FakeMap:
    """A map of Spark's state in memory."""

    def __init__(self):
        self.held = {}

    def getValue(self, key):
        return self.held.get(key)

    def updateValue(self, key, value):
        self.held[key] = value

    def removeKey(self, key):
        self.held.pop(key, None)

    def keys(self):
        return list(self.held)

    def iterator(self):
        return list(self.held.items())


def test_state_stays_as_small_as_a_span_of_the_ttl():
    state, maps = AlertState(3 * model.MINUTE), {}

    class Handle:
        def getMapState(self, name, key, value):
            return maps.setdefault(name, FakeMap())

    state.init(Handle())
    columns = ["arrival_us", "kind", "seq", "user_id", "priority", "event_id", "location_id", "window_start_us"]
    raised, sizes = [], []
    for batch in range(40):
        at = batch * model.MINUTE
        rows = [(at + 1, 1, batch, "x", None, f"e{batch}", f"l{batch % 20}", 0)]
        rows += [(0, 0, 99, "u", "low", None, None, 0)] * (batch == 0)
        found = list(state.handleInputRows(("s", 0), iter([pd.DataFrame(rows, columns=columns)]), None))
        raised.append(sum(len(f) for f in found))
        sizes.append(len(maps["raised"].held))
    assert raised == [1] * 40 and max(sizes) <= 9 and max(sizes[20:]) <= max(sizes[:20])
    assert maps["wishes"].held == {("u",): ("low",)} and len(maps["due"].held) <= 3
    # A wish that ends leaves the state.
    off = pd.DataFrame([(10**12, 0, 100, "u", None, None, None, 0)], columns=columns)
    assert list(state.handleInputRows(("s", 0), iter([off]), None)) == [] and not maps["wishes"].held


class CountedMap(FakeMap):
    """Counts its calls, and forgets entries a time after they were written."""

    def __init__(self, ttl_ms=None):
        super().__init__()
        self.ttl_ms, self.now_ms, self.calls, self.times = ttl_ms, 0, 0, {}

    def getValue(self, key):
        self.calls += 1
        if self.ttl_ms is not None and key in self.times and self.times[key] + self.ttl_ms <= self.now_ms:
            return None
        return super().getValue(key)

    def updateValue(self, key, value):
        self.calls += 1
        self.times[key] = self.now_ms
        super().updateValue(key, value)


def test_ids_share_entries_of_the_state():
    nodes, seen, rng = CountedMap(), set(), random.Random(3)
    for size in (20_000, 1, 20_000, 0, 500):
        ids = sorted({f"e\u00e9\x00\"{rng.randrange(40_000)}" for _ in range(size)}) + [""] * (size > 0)
        nodes.calls = 0
        assert cleaning.SeenIds(nodes).add(ids).tolist() == [i not in seen for i in ids]
        # One lookup an id, and one entry for a new one, would be more than a call an id.
        assert size < 1_000 or nodes.calls < len(ids) / 10
        seen |= set(ids)
    assert all(split or len(held) < 30_000 for split, held, _ in nodes.held.values())


def test_ids_are_forgotten_after_their_time(monkeypatch):
    monkeypatch.setattr(cleaning, "LEAF", 4)
    nodes, written, rng = CountedMap(100), {}, random.Random(4)
    for now in range(0, 2_000, 7):
        nodes.now_ms = now
        ids = sorted({str(rng.randrange(300 if now % 3 else 40)) for _ in range(rng.randrange(12))})
        want = [i not in written or written[i] + 100 <= now for i in ids]
        assert cleaning.SeenIds(nodes, 100, now).add(ids).tolist() == want
        written |= {i: now for i, new in zip(ids, want) if new}


@pytest.mark.parametrize("seed", range(12))
def test_sightings_that_raise_nothing_are_passed_over(seed, monkeypatch):
    rows, prefs = case(seed, n=900, changes=60)
    for row in rows:
        row["et_us"] = rows[0]["et_us"] + row["et_us"] % (25 * model.MINUTE)
    for change in prefs[::3]:
        change |= {"arrival_us": rows[0]["arrival_us"], "active": True}
    ttl_us = [None, 40 * model.MINUTE, 200 * model.MINUTE][seed % 3]
    asked, plain = [], Matcher.sighting
    monkeypatch.setattr(Matcher, "sighting", lambda self, *of: asked.append(of) or plain(self, *of))
    monkeypatch.setattr(alerting, "LOOKED_AT", 0 if seed % 4 == 3 else 64)
    entered = [(r["arrival_us"], 1, r["seq"], r["user_id"], None, r["event_id"], r["location_id"], model.window(r["et_us"])[0], r["species_code"]) for r in rows]
    entered += [(c["arrival_us"], 0, c["seq"], c["user_id"], c["priority"] if c["active"] else None, None, None, 0, c["species_code"]) for c in prefs]
    columns = ["arrival_us", "kind", "seq", "user_id", "priority", "event_id", "location_id", "window_start_us", "species_code"]
    states, got = {}, []
    middle = rows[400]["arrival_us"]
    for part in ([e for e in entered if e[0] < middle], [e for e in entered if e[0] >= middle]):
        random.Random(seed).shuffle(part)
        for species in sorted({e[-1] for e in part}):
            if species not in states:
                maps = {}
                states[species] = AlertState(ttl_us)
                states[species].init(type("Handle", (), {"getMapState": lambda _, name, *of: maps.setdefault(name, FakeMap())})())  # noqa: B023
            batch = pd.DataFrame([e for e in part if e[-1] == species], columns=columns)
            for found in states[species].handleInputRows((species, 0), iter([batch[:50], batch[50:]]), None):
                got += [(r.user_id, species, r.location_id, r.window_start_us, r.event_id, r.priority) for r in found.itertuples()]
    assert sorted(got) == sorted(model.alerts(rows, prefs, ttl_us=ttl_us))
    assert len(asked) < (0.5 if seed % 4 < 3 else 0.8) * len(rows)


def raw_rows(spark, texts, start):
    rows = [(S.RAW, b"k", t.encode(), 1000 + start + i, start + i) for i, t in enumerate(texts)]
    return spark.createDataFrame(
        rows, "topic string, key binary, value binary, arrival_us bigint, seq bigint"
    )


@pytest.mark.parametrize("ttl_ms", [None, 3_600_000])
def test_cleaning_stream_across_a_restart(spark, tmp_path, ttl_ms):
    if ttl_ms is not None:
        # With a time-to-live the query would otherwise run empty batches forever.
        spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")

    def sighting(event_id, user="u"):
        return (
            f'{{"event_id":"{event_id}","user_id":"{user}","species_code":"s","location_id":"l",'
            '"event_time":"2026-05-16T15:10:00Z","count":2.50e0,"extra":3.0}'
        ).replace("2.50e0", "2")

    first = [sighting("a"), sighting("a"), sighting("b", user=""), "{broken", "[1]"]
    second = [sighting("a"), sighting("b"), sighting("c"), sighting("c")]
    for start, texts in ((0, first), (100, second)):
        write_topics(raw_rows(spark, texts, start), f"{tmp_path}/in")
        routed = cleaning_stream(stream_topic(spark, S.RAW, f"{tmp_path}/in"), ttl_ms, F.lit("now"))
        writer = topic_writer(routed, f"{tmp_path}/checkpoint", f"{tmp_path}/out")
        writer.trigger(availableNow=True).start().awaitTermination()

    def values(topic):
        rows = read_topic(spark, topic, f"{tmp_path}/out").orderBy("seq").collect()
        return [(r.seq, bytes(r.value).decode()) for r in rows]

    assert values(S.CLEAN) == [(0, first[0]), (101, second[1]), (102, second[2])]
    quality = values(S.QUALITY)
    assert [seq for seq, _ in quality] == [1, 2, 100, 103]
    assert "missing_user_id" in quality[1][1] and "duplicate_event_id" in quality[2][1]
    dead = dict(values(S.DEAD_LETTERS))
    assert sorted(dead) == [2, 3, 4]
    assert dead[2].endswith(f',"payload":{first[2]}}}') and dead[4].endswith(',"payload":[1]}')
    assert '"raw_preview":"{broken"' in dead[3] and "payload" not in dead[3]


def test_topic_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("k", "v", None, 5, 1)], "key string, a string, b int, arrival_us bigint, seq bigint")
    write_topics(records(df, "some_topic"), f"{tmp_path}/t")
    row = read_topic(spark, "some_topic", f"{tmp_path}/t").first()
    assert (bytes(row.key), bytes(row.value), row.arrival_us, row.seq) == (b"k", b'{"a":"v"}', 5, 1)
    assert read_topic(spark, "other", f"{tmp_path}/t").count() == 0


def test_a_replay_of_a_span_reads_its_days(spark, tmp_path):
    day = 86_400_000_000
    rows = spark.range(40).selectExpr("'t' AS topic", "CAST('k' AS BINARY) AS key", "CAST(CAST(id AS STRING) AS BINARY) AS value", f"id * {day // 4} AS arrival_us", "id AS seq")
    write_topics(rows, f"{tmp_path}/t")
    assert len(list(tmp_path.glob("t/topic=t/arrival_day=*"))) == 10
    span = read_topic(spark, "t", f"{tmp_path}/t", since_us=2 * day + 1, until_us=4 * day)
    assert sorted(r.seq for r in span.collect()) == list(range(9, 16))
    plan = span._jdf.queryExecution().executedPlan().toString()
    assert "arrival_day" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    # Only the files of those days are there for the tasks to read.
    for k in (0, 1, 5, 9):
        for file in tmp_path.glob(f"t/topic=t/arrival_day=1970-01-{k + 1:02}/*.parquet"):
            file.write_bytes(b"unreadable")
    assert read_topic(spark, "t", f"{tmp_path}/t", since_us=2 * day + 1, until_us=4 * day).count() == 7
    assert read_topic(spark, "t", f"{tmp_path}/t", since_us=3 * day, until_us=3 * day + 1).count() == 1
    # Files that have no day are read, too.
    rows.filter("id = 12").write.mode("append").parquet(f"{tmp_path}/u")
    assert read_topic(spark, "t", f"{tmp_path}/u", since_us=3 * day).count() == 1


def test_kafka_spans(monkeypatch):
    assert _span_options(1_500, 2_500) == {"startingTimestamp": "1", "endingTimestamp": "3"}
    assert _span_options(None, None) == {}


def test_kafka_layout_and_payload(spark):
    kafka = spark.sql("SELECT X'6B' key, X'76' value, 3 partition, 7L offset, TIMESTAMP '2026-05-16 15:10:00Z' timestamp, 1 timestampType")
    row = with_arrival(kafka).first()
    assert (row.arrival_us, row.seq) == (1778944200000000, (3 << 48) + 7)
    with pytest.raises(Exception, match="LogAppendTime"):
        with_arrival(kafka.withColumn("timestampType", F.lit(0))).collect()
    text = spark.range(1).select(with_payload(F.lit('{"a":1}'), F.lit('{"z":3.0,"b":1}'))).first()[0]
    assert text == '{"a":1,"payload":{"z":3.0,"b":1}}'


def test_broker_comes_from_the_environment(monkeypatch):
    from sightline.sources.topics import bootstrap_servers, kafka_options

    monkeypatch.delenv("KAFKA_BOOTSTRAP_SERVERS", raising=False)
    assert bootstrap_servers() == "localhost:19092"
    monkeypatch.setenv("KAFKA_BOOTSTRAP_SERVERS", "a:1,b:2")
    options = kafka_options(["x", "y"])
    assert options["kafka.bootstrap.servers"] == "a:1,b:2"
    assert (options["subscribe"], options["startingOffsets"]) == ("x,y", "earliest")


def test_key_may_be_null(spark):
    out = spark.range(1).select(message("t", F.lit(None).cast("string"), F.lit("{}")).alias("m")).select("m.*")
    assert out.first().key is None and "alert_id" in S.ALERT.fieldNames() and alerts.SUPPRESSION


def test_the_metric_stream_stages_what_its_outputs_read(spark, tmp_path, monkeypatch):
    from sightline.streaming import metrics

    staged, plain = {}, metrics.stage
    monkeypatch.setattr(metrics, "stage", lambda df, label: staged.setdefault(label, df.columns) and plain(df, label))
    rows = clean(spark, model.random_sightings(random.Random(7), 60, 30 * model.MINUTE))
    HotspotStream(spark, str(tmp_path))(rows.withColumn("text", F.repeat(F.lit("x"), 1000)), 0)
    assert not any("text" in columns for columns in staged.values()) and "cnt" in staged["hotspot-batch"]
