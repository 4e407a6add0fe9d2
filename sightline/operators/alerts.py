"""Alerts: sightings of a species matched to the users who look for it.

A sighting sees the preferences as of its own arrival. Pairing every sighting with
every interested user would be quadratic within a species, and nearly all pairs
would be suppressed: a user gets one alert per species, location and window. So
the join pairs preference versions with *groups* of sightings (species, location,
window, arrival cell), about as many pairs as there are alerts, and each pair
looks up the one sighting that counts: the first the version sees that is not the
user's own.

For most pairs that is the group's first sighting, a plain aggregate. The rest
(versions that start inside a group's arrival span, or belong to the user of the
group's first sighting) are merged with the group's sightings by one sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sightline.functions.ids import stable_id
from sightline.functions.times import iso_z, now_z
from sightline.operators.eventtime import with_window
from sightline.schemas import ARRIVAL, WINDOW_US
from sightline.session import stage

GROUP = ["species_code", "location_id", "window_start_us", "cell"]
SUPPRESSION = ["user_id", "species_code", "location_id", "window_start_us"]

# Arrival cells keep a straggler from stretching its group over every preference
# change between the window and its own arrival.
CELL_US = 3_600_000_000
# A group with more sightings than this is split into several.
GROUP_ROWS = 1_000_000
# Preference versions of one species in a block of the join.
BLOCK_VERSIONS = 50_000

_FIRST_US = -(1 << 63)


def alertable(clean: DataFrame, width_us: int = WINDOW_US, *more: str) -> DataFrame:
    """Sightings that can raise an alert: a time, a species and a location.

    A sighting without a user is nobody's own.
    """
    rows = with_window(clean, width_us)
    rows = rows.filter((F.col("species_code") != "") & (F.col("location_id") != ""))
    return rows.select(
        *ARRIVAL,
        "event_id",
        F.coalesce("user_id", F.lit("")).alias("birder_id"),
        *GROUP[:3],
        F.floor(F.col("arrival_us") / F.lit(CELL_US)).alias("cell"),
        *more,
    )


def current_versions(snapshot: DataFrame) -> DataFrame:
    """Snapshot rows as versions that hold for every arrival."""
    return snapshot.withColumns(
        {
            "valid_from_us": F.lit(_FIRST_US),
            "valid_to_us": F.lit(None).cast("bigint"),
        }
    )


def _groups(sightings: DataFrame) -> DataFrame:
    head = F.min(F.struct(*ARRIVAL, "event_id", "birder_id")).alias("head")
    return sightings.groupBy(*GROUP).agg(
        head, F.max("arrival_us").alias("last_us"), F.count("*").alias("rows")
    )


def _cover(first: Column, last: Column, levels: int) -> Column:
    """The cells ``first`` to ``last`` as at most two dyadic intervals a level.

    An interval is (level, node): the cells whose number, shifted right by the level,
    is the node.
    """
    kind = "array<struct<level:int,node:bigint>>"
    start = F.struct(first.alias("low"), (last + 1).alias("high"), F.array().cast(kind).alias("nodes"))

    def climb(state: Column, level: Column) -> Column:
        low, high = state["low"], state["high"]
        node = lambda n: F.struct(level.alias("level"), n.alias("node"))
        odd_low = (low < high) & (F.pmod(low, F.lit(2)) == 1)
        low_up = F.when(odd_low, low + 1).otherwise(low)
        odd_high = (low_up < high) & (F.pmod(high, F.lit(2)) == 1)
        found = F.array_compact(F.array(F.when(odd_low, node(low)), F.when(odd_high, node(high - 1))))
        return F.struct(
            F.shiftright(low_up, 1).alias("low"),
            F.shiftright(F.when(odd_high, high - 1).otherwise(high), 1).alias("high"),
            F.concat(state["nodes"], found).alias("nodes"),
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(levels)), start, climb, lambda state: state["nodes"])


def _pairs(groups: DataFrame, versions: DataFrame) -> DataFrame:
    """Versions and groups of one species whose arrival spans overlap.

    A group lies in one arrival cell. A version's interval is covered by few dyadic
    intervals of cells, and a group looks each level up, so they meet by equality and
    a pair that meets overlaps but for the cells at the interval's ends. The versions
    of a popular species are cut into blocks by user; only its own groups are copied.
    """
    span = groups.agg(F.min("cell"), F.max("cell")).first()
    if span[0] is None:
        span = (0, 0)
    levels = (span[1] - span[0] + 1).bit_length()
    least, most = F.lit(span[0]).cast("bigint"), F.lit(span[1]).cast("bigint")
    cell = lambda at: F.floor(at / F.lit(CELL_US)).cast("bigint")
    first = F.greatest(cell(F.col("valid_from_us")), least) - least
    last = F.least(F.coalesce(cell(F.col("valid_to_us")), most), most) - least
    sizes = versions.groupBy("species_code").agg(F.ceil(F.count("*") / BLOCK_VERSIONS).cast("int").alias("_blocks"))
    sizes = stage(sizes, "species-blocks")
    covered = versions.withColumn("_cover", F.when(first <= last, _cover(first, last, levels)))
    covered = covered.join(sizes, "species_code").select(
        *versions.columns,
        F.pmod(F.xxhash64("user_id", "valid_from_us"), F.col("_blocks")).cast("int").alias("_block"),
        F.inline("_cover").alias("_level", "_node"),
    )
    looked = groups.join(sizes, "species_code").withColumn(
        "_block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    )
    looked = looked.withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(levels))))
    node = F.expr("shiftright(cell - {}, _level)".format(span[0]))
    looked = looked.withColumn("_node", node).drop("_blocks")
    overlap = (F.col("valid_from_us") <= F.col("last_us")) & (
        F.col("valid_to_us").isNull() | (F.col("valid_to_us") > F.col("head.arrival_us"))
    )
    joined = looked.join(covered, ["species_code", "_block", "_level", "_node"]).filter(overlap)
    return joined.drop("_block", "_level", "_node")


def _split(sightings: DataFrame, probes: DataFrame, groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Add ``salt``: the part of an oversized group a sighting belongs to.

    A probe asks every part; the caller takes the earliest answer, so the split
    changes no result. At most rows/GROUP_ROWS groups are oversized.
    """
    large = groups.filter(F.col("rows") > GROUP_ROWS).select(
        *GROUP, F.ceil(F.col("rows") / GROUP_ROWS).cast("int").alias("parts")
    )
    if large.isEmpty():
        return sightings.withColumn("salt", F.lit(0)), probes.withColumn("salt", F.lit(0))
    parts = F.coalesce("parts", F.lit(1))
    salt = F.pmod(F.xxhash64("seq"), parts).cast("int")
    sightings = sightings.join(large, GROUP, "left").withColumn("salt", salt).drop("parts")
    asked = F.explode(F.sequence(F.lit(0), parts - 1))
    probes = probes.join(large, GROUP, "left").withColumn("salt", asked).drop("parts")
    return sightings, probes


def _lookup(sightings: DataFrame, probes: DataFrame, groups: DataFrame) -> DataFrame:
    """First sighting of the group that each probe sees and that is not its own.

    Sightings and probes are sorted together, latest first. The row before a probe
    is then the next sighting; ``other`` is the first one after it by a different
    birder, which answers when the next sighting is the probing user's own.
    """
    asked = probes.select(*GROUP).distinct()
    sightings, probes = _split(sightings.join(asked, GROUP, "left_semi"), probes, groups)
    sighting = F.struct(*ARRIVAL, "event_id", "birder_id")
    rows = sightings.select(*GROUP, "salt", *ARRIVAL, sighting.alias("sighting")).unionByName(
        probes.select(
            *GROUP,
            "salt",
            F.col("valid_from_us").alias("arrival_us"),
            F.lit(_FIRST_US).alias("seq"),
            F.struct("user_id", "priority", "valid_from_us", "valid_to_us").alias("probe"),
        ),
        allowMissingColumns=True,
    )
    latest_first = [F.desc("arrival_us"), F.desc(F.col("sighting").isNotNull()), F.desc("seq")]
    order = W.partitionBy(*GROUP, "salt").orderBy(*latest_first)
    after = order.rowsBetween(W.unboundedPreceding, -1)
    from_here = order.rowsBetween(W.unboundedPreceding, 0)
    following = F.last("sighting", ignorenulls=True).over(after)
    change = F.when(F.col("following.birder_id") != F.col("sighting.birder_id"), F.col("following"))
    own = F.col("following.birder_id") == F.col("probe.user_id")
    seen = F.when(own, F.col("other")).otherwise(F.col("following"))
    return (
        rows.withColumn("following", following)
        .withColumn("change", change)
        .withColumn("other", F.last("change", ignorenulls=True).over(from_here))
        .filter(F.col("probe").isNotNull())
        .select(*GROUP, "probe.*", seen.alias("seen"))
    )


def match_versions(clean: DataFrame, versions: DataFrame, width_us: int = WINDOW_US) -> DataFrame:
    """First sighting each preference version sees per location and window.

    Rows of a version may repeat per arrival cell; ``alert_matches`` and
    ``first_alerts`` keep the earliest.
    """
    sightings = alertable(clean, width_us)
    groups = stage(_groups(sightings), "sighting-groups")
    versions = versions.filter("active").select(
        "user_id", "species_code", "priority", "valid_from_us", "valid_to_us"
    )
    versions = versions.filter(
        F.col("valid_to_us").isNull() | (F.col("valid_from_us") < F.col("valid_to_us"))
    )
    pairs = _pairs(groups, stage(versions, "preference-versions"))
    by_head = (F.col("valid_from_us") <= F.col("head.arrival_us")) & (
        F.col("user_id") != F.col("head.birder_id")
    )
    columns = [*GROUP, "user_id", "priority", "valid_from_us", "valid_to_us"]
    direct = pairs.filter(by_head).select(*columns, F.col("head").alias("seen"))
    probes = stage(pairs.filter(~by_head).select(*columns), "alert-probes")
    found = direct.unionByName(_lookup(sightings, probes, groups))
    in_span = F.col("valid_to_us").isNull() | (F.col("seen.arrival_us") < F.col("valid_to_us"))
    return found.filter(F.col("seen").isNotNull() & in_span).drop("cell")


def alert_matches(matches: DataFrame) -> DataFrame:
    """One row per preference version, location and window, before suppression."""
    first = F.min(F.struct("seen.arrival_us", "seen.seq", "seen.event_id", "priority"))
    keyed = matches.groupBy(*SUPPRESSION, "valid_from_us", "valid_to_us").agg(first.alias("first"))
    return keyed.select(*SUPPRESSION, "valid_from_us", "first.*")


def first_alerts(matches: DataFrame, width_us: int = WINDOW_US) -> DataFrame:
    """First match per user, species, location and window.

    The minimum combines on the map side: at most one row per key and task is
    shuffled. The priority is the one in force at the match.
    """
    first = F.min(F.struct("seen.arrival_us", "seen.seq", "seen.event_id", "priority"))
    return (
        matches.groupBy(*SUPPRESSION)
        .agg(first.alias("first"))
        .select(*SUPPRESSION, (F.col("window_start_us") + width_us).alias("window_end_us"), "first.*")
    )


def alerts_asof(clean: DataFrame, history: DataFrame, width_us: int = WINDOW_US) -> DataFrame:
    """Alerts under the preferences in force when each sighting arrived."""
    return first_alerts(match_versions(clean, history, width_us), width_us)


def alerts_snapshot(clean: DataFrame, snapshot: DataFrame, width_us: int = WINDOW_US) -> DataFrame:
    """Alerts when all preference changes were read before the first sighting."""
    return first_alerts(match_versions(clean, current_versions(snapshot), width_us), width_us)


def alert_records(alerts: DataFrame, detected_at=None) -> DataFrame:
    """Output records with replay-stable ids."""
    return alerts.select(
        F.col("user_id").alias("key"),
        stable_id("al_", *[F.col(k) for k in SUPPRESSION]).alias("alert_id"),
        "user_id",
        "species_code",
        "location_id",
        iso_z(F.col("window_start_us")).alias("window_start"),
        iso_z(F.col("window_end_us")).alias("window_end"),
        F.col("event_id").alias("sighting_event_id"),
        (now_z() if detected_at is None else detected_at).alias("detected_at"),
        "priority",
    )
