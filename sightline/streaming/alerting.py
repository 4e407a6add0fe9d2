"""Alert job as one stream: preferences as of arrival, suppression with expiry.

Sightings and preference changes meet in one stateful operator, keyed by species and a
block of its users. Its state is what users look for, one entry per user, and the alerts
raised per location and window; a change writes the entry of its user and a window with
new alerts its own, so what a micro-batch writes follows what it changes. Inside a
micro-batch the records of a key are taken in order of arrival, one by one, expiry
included: the alerts do not depend on how the arrivals were cut into batches.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left, bisect_right
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sightline import schemas as S
from sightline.operators import alerts, preferences
from sightline.operators.decode import PREFERENCE_FIELDS, decodable
from sightline.operators.validate import clean_fields
from sightline.session import configure
from sightline.sources.topics import records
from sightline.streaming.state import ddl, use_state_store

#: Blocks a species' users are dealt into; each sighting goes to all of them.
BLOCKS = 4
#: Users with changes in a micro-batch that are looked at one by one; beyond, every change counts.
LOOKED_AT = 64

Group = tuple[str, int]

_ENTERED = {
    "species_code": "string",
    "block": "int",
    "arrival_us": "bigint",
    "kind": "int",
    "seq": "bigint",
    "user_id": "string",
    "priority": "string",
    "event_id": "string",
    "location_id": "string",
    "window_start_us": "bigint",
}
_RAISED = {
    "user_id": "string",
    "species_code": "string",
    "location_id": "string",
    "window_start_us": "bigint",
    "arrival_us": "bigint",
    "seq": "bigint",
    "event_id": "string",
    "priority": "string",
}
# At one instant changes come before the sightings that see them.
_CHANGE, _SIGHTING = 0, 1


class _Raised:
    """Alerts of one location and window: who has one, and who is still to get one."""

    def __init__(self, raised: dict[str, int], wishes: dict[str, str], changes: int) -> None:
        self.raised = raised
        self.waiting = wishes.keys() - raised.keys()
        self.expiring = deque(sorted((at, user) for user, at in raised.items()))
        self.changes = changes
        self.changed = False


class Matcher:
    """Matches the records of one key, given in order of arrival.

    ``wishes`` has the users that look for the species and their priority; ``load`` gives
    the alerts of a location and window, user to arrival. A window is compared with all
    users once; after that a sighting costs the alerts it raises and the changes and
    expiries since the last one there.
    """

    def __init__(self, wishes: dict[str, str], load: Callable[[Group], dict[str, int]], ttl_us: int | None) -> None:
        self.wishes, self._load, self._ttl_us = wishes, load, ttl_us
        self.groups: dict[Group, _Raised] = {}
        self.changed: list[str] = []

    def change(self, user: str, priority: str | None) -> None:
        """``user`` looks for the species from now on, or with no priority no longer."""
        self.wishes.pop(user, None)
        if priority is not None:
            self.wishes[user] = priority
        self.changed.append(user)

    def sighting(self, group: Group, birder: str, at: int) -> list[str]:
        """Users who get an alert for a sighting by ``birder``."""
        state = self.groups.get(group)
        if state is None:
            state = self.groups[group] = _Raised(self._load(group), self.wishes, len(self.changed))
        for user in self.changed[state.changes :]:
            state.waiting.discard(user)
            if user in self.wishes and user not in state.raised:
                state.waiting.add(user)
        state.changes = len(self.changed)
        if self._ttl_us is not None:
            while state.expiring and state.expiring[0][0] + self._ttl_us <= at:
                _, user = state.expiring.popleft()
                del state.raised[user]
                state.changed = True
                if user in self.wishes:
                    state.waiting.add(user)
        users = sorted(state.waiting - {birder})
        if users:
            state.changed = True
            state.waiting &= {birder}
            state.raised.update(dict.fromkeys(users, at))
            state.expiring.extend((at, user) for user in users)
        return users


class _Sightings:
    """The sightings of one location and window in a micro-batch, in order of arrival."""

    def __init__(self, group: Group, places: np.ndarray, arrivals: np.ndarray, birders: np.ndarray) -> None:
        self.group, self.places, self._arrivals = group, places, arrivals
        # Where a run of sightings by one birder ends.
        self._turns = np.flatnonzero(birders[1:] != birders[:-1]) + 1
        self.at = 0

    def skip(self, state: _Raised, ttl_us: int | None, next_change: int | None) -> bool:
        """Go on to the next sighting that may raise an alert; whether there is one."""
        ends = [len(self.places)]
        if state.waiting:
            # They wait for a sighting by someone else.
            turn = np.searchsorted(self._turns, self.at, "right")
            ends.append(int(self._turns[turn]) if turn < len(self._turns) else ends[0])
        if ttl_us is not None and state.expiring:
            ends.append(int(np.searchsorted(self._arrivals, state.expiring[0][0] + ttl_us)))
        if next_change is not None:
            ends.append(int(np.searchsorted(self.places, next_change)))
        self.at = max(self.at + 1, min(ends))
        return self.at < len(self.places)


def matched(matcher: Matcher, batch: pd.DataFrame, ttl_us: int | None) -> Iterator[tuple[int, str, str]]:
    """(row, user, priority) of the alerts that a micro-batch of one key raises.

    After a sighting nobody waits there but its own birder. So the next one that matters
    follows an expiry, a wish of a user without an alert, or is another birder's; the
    sightings before it are passed over.
    """
    kinds, arrivals = batch["kind"].to_numpy(), batch["arrival_us"].to_numpy()
    order = np.lexsort((batch["seq"].to_numpy(), kinds, arrivals))
    is_change = kinds[order] == _CHANGE
    changes = np.flatnonzero(is_change).tolist()
    changed = batch.loc[order[changes], ["user_id", "priority"]]
    # A priority that is missing may come as another null.
    wishes = list(zip(changed["user_id"].tolist(), changed["priority"].astype(object).where(changed["priority"].notna(), None).tolist()))
    wished: dict[str, list[int]] = {}
    starts = [place for place, (_, priority) in zip(changes, wishes) if priority is not None]
    for place, (user, priority) in zip(changes, wishes):
        if priority is not None:
            wished.setdefault(user, []).append(place)

    def next_wish(after: int, raised: dict[str, int]) -> int | None:
        found = [starts] if len(wished) > LOOKED_AT else [wished[user] for user in wished.keys() - raised.keys()]
        ahead = [at[k] for at in found if (k := bisect_right(at, after)) < len(at)]
        return min(ahead, default=None)

    places = np.flatnonzero(~is_change)
    rows = order[places]
    users = batch["user_id"].to_numpy()
    where, locations = pd.factorize(batch["location_id"].to_numpy()[rows])
    when, windows = pd.factorize(batch["window_start_us"].to_numpy()[rows])
    who = pd.factorize(users[rows])[0]
    code = where * max(1, len(windows)) + when
    by_group = np.argsort(code, kind="stable")
    cuts = np.flatnonzero(np.diff(code[by_group])) + 1
    heap: list[tuple[int, int]] = []
    groups: list[_Sightings] = []
    for part in np.split(by_group, cuts) if len(by_group) else []:
        group = (locations[where[part[0]]], int(windows[when[part[0]]]))
        heap.append((int(places[part[0]]), len(groups)))
        groups.append(_Sightings(group, places[part], arrivals[rows[part]], who[part]))
    heapq.heapify(heap)
    applied = 0
    while heap:
        place, number = heap[0]
        until = bisect_left(changes, place)
        for user, priority in wishes[applied:until]:
            matcher.change(user, priority)
        applied = until
        row, seen = int(order[place]), groups[number]
        for user in matcher.sighting(seen.group, users[row], int(arrivals[row])):
            yield row, user, matcher.wishes[user]
        state = matcher.groups[seen.group]
        if seen.skip(state, ttl_us, next_wish(place, state.raised)):
            heapq.heapreplace(heap, (int(seen.places[seen.at]), number))
        else:
            heapq.heappop(heap)
    for user, priority in wishes[applied:]:
        matcher.change(user, priority)


class AlertState(StatefulProcessor):
    """Keeps a key's wishes and alerts in Spark's state.

    With a time to live, ``due`` lists the windows by the span of arrivals that raised
    their last alerts, so those that are over are removed when the key is next seen.
    """

    def __init__(self, ttl_us: int | None) -> None:
        self._ttl_us = ttl_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        group = "location_id string, window_start_us bigint"
        self._wishes = handle.getMapState("wishes", "user_id string", "priority string")
        self._raised = handle.getMapState("raised", group, "users array<string>, arrivals array<bigint>")
        self._due = handle.getMapState("due", "span bigint", "locations array<string>, starts array<bigint>")

    def _load(self, group: Group) -> dict[str, int]:
        held = self._raised.getValue(group)
        return dict(zip(held[0], held[1])) if held else {}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        matcher = Matcher({user: wish[0] for (user,), wish in self._wishes.iterator()}, self._load, self._ttl_us)
        alerts_ = list(matched(matcher, batch, self._ttl_us))
        names = ["location_id", "window_start_us", "arrival_us", "seq", "event_id"]
        of = batch.loc[[row for row, _, _ in alerts_], names].reset_index(drop=True)
        found = of.assign(user_id=[a[1] for a in alerts_], species_code=key[0], priority=[a[2] for a in alerts_])
        for user in set(matcher.changed):
            if user in matcher.wishes:
                self._wishes.updateValue((user,), (matcher.wishes[user],))
            else:
                self._wishes.removeKey((user,))
        self._store(matcher, int(batch["arrival_us"].max()))
        if len(found):
            yield found[list(_RAISED)]

    def _store(self, matcher: Matcher, last: int) -> None:
        spans: dict[int, set[Group]] = {}
        for group, state in matcher.groups.items():
            if not state.changed:
                continue
            if state.raised:
                self._raised.updateValue(group, (list(state.raised), list(state.raised.values())))
            else:
                self._raised.removeKey(group)
            if self._ttl_us is not None and state.raised:
                spans.setdefault(max(state.raised.values()) // self._ttl_us, set()).add(group)
        if self._ttl_us is None:
            return
        for span, groups in spans.items():
            held = self._due.getValue((span,))
            groups |= set(zip(held[0], held[1])) if held else set()
            self._due.updateValue((span,), ([g[0] for g in groups], [g[1] for g in groups]))
        over = [span for (span,) in self._due.keys() if (span + 2) * self._ttl_us <= last]
        for span in over:
            for group in zip(*self._due.getValue((span,))):
                held = self._load(group)
                if held and max(held.values()) + self._ttl_us <= last:
                    self._raised.removeKey(group)
            self._due.removeKey((span,))

    def close(self) -> None:
        pass


def _entered(rows: DataFrame, width_us: int, blocks: int) -> DataFrame:
    """Sightings and changes in one layout, dealt to the keys of the state."""
    clean = clean_fields(decodable(rows.filter(F.col("topic") == S.CLEAN)))
    all_blocks = F.explode(F.array(*[F.lit(b) for b in range(blocks)]))
    seen = alerts.alertable(clean, width_us).withColumns({"block": all_blocks, "kind": F.lit(_SIGHTING)})
    seen = seen.withColumnRenamed("birder_id", "user_id")
    changed = preferences.preference_changes(decodable(rows.filter(F.col("topic") == S.PREFERENCES), PREFERENCE_FIELDS))
    changed = changed.withColumns(
        {
            "block": F.pmod(F.xxhash64("user_id"), F.lit(blocks)).cast("int"),
            "kind": F.lit(_CHANGE),
            "priority": F.when(F.col("active"), F.col("priority")),
        }
    )
    both = seen.unionByName(changed, allowMissingColumns=True).fillna(0, ["window_start_us"])
    return both.select(*[F.col(name).cast(kind) for name, kind in _ENTERED.items()])


def raised_alerts(rows: DataFrame, width_us: int = S.WINDOW_US, ttl_us: int | None = None, blocks: int = BLOCKS) -> DataFrame:
    """Alerts raised by a stream of rows ``(topic, key, value, arrival_us, seq)``.

    Every micro-batch must be a slice of the arrival order of both topics. ``ttl_us``
    lets a suppressed alert be raised again once that much arrival time has passed since
    it was; by default suppression never ends. A micro-batch of one key is sorted in
    memory, so bound it by the source's rate; ``blocks`` bounds a key's users.
    """
    configure(rows.sparkSession)
    use_state_store(rows.sparkSession)
    return (
        _entered(rows, width_us, blocks)
        .groupBy("species_code", "block")
        .transformWithStateInPandas(
            statefulProcessor=AlertState(ttl_us),
            outputStructType=T.StructType.fromDDL(ddl(_RAISED)),
            outputMode="Append",
            timeMode="None",
        )
        .withColumn("window_end_us", F.col("window_start_us") + F.lit(width_us))
    )


def alerting_stream(
    rows: DataFrame,
    width_us: int = S.WINDOW_US,
    ttl_us: int | None = None,
    now: Column | None = None,
    blocks: int = BLOCKS,
) -> DataFrame:
    """Stream of both topics to alert records; write it with ``topic_writer``."""
    return records(alerts.alert_records(raised_alerts(rows, width_us, ttl_us, blocks), now), S.ALERTS)
