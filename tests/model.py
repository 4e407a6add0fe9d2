"""What the jobs should yield, one record at a time, for small inputs."""

from __future__ import annotations

import random

WINDOW = 900_000_000
MINUTE = 60_000_000


def window(et: int, width: int = WINDOW) -> tuple[int, int]:
    return et // width * width, et // width * width + width


def hotspot(rows: list[dict], lateness: int, width: int = WINDOW, max_future: int | None = None) -> tuple[list, list, list]:
    """(panes, late events, open windows) for rows in arrival order."""
    largest = None
    accumulators: dict[tuple, list] = {}
    panes, late = [], []
    for row in rows:
        if max_future is None or row["et_us"] <= row["arrival_us"] + max_future:
            largest = row["et_us"] if largest is None else max(largest, row["et_us"])
        mark = -(1 << 62) if largest is None else largest - lateness
        start, end = window(row["et_us"], width)
        status = "on_time"
        if mark >= end:
            status = "within" if mark <= row["et_us"] + lateness else "late"
        if status == "late":
            late.append((row["event_id"], row["et_us"], end, mark))
        else:
            key = (row["location_id"], row["species_code"], start, end)
            entry = accumulators.setdefault(key, [0, set(), status, row["event_id"]])
            entry[0] += row["cnt"]
            if row["user_id"]:
                entry[1].add(row["user_id"])
        for key in [k for k in accumulators if k[3] <= mark]:
            total, users, how, event_id = accumulators.pop(key)
            kind = ("main", None) if how == "on_time" else ("late", event_id)
            panes.append((*key, *kind, total, len(users), mark))
    left = [(*k, v[0], len(v[1])) for k, v in accumulators.items()]
    return panes, late, left


def alerts(sightings: list[dict], changes: list[dict], width: int = WINDOW, ttl_us: int | None = None) -> list[tuple]:
    """First alert per user, species, location and window, by arrival.

    A change applies to sightings that arrive at the same instant. After ``ttl_us`` an
    alert may be raised again.
    """
    log = [(c["arrival_us"], 0, c["seq"], c) for c in changes]
    log += [(s["arrival_us"], 1, s["seq"], s) for s in sightings]
    wanted: dict[tuple, str] = {}
    seen, out = {}, []
    for at, kind, _, row in sorted(log, key=lambda entry: entry[:3]):
        if kind == 0:
            key = (row["species_code"], row["user_id"])
            wanted.pop(key, None)
            if row["active"]:
                wanted[key] = row["priority"]
            continue
        start, _ = window(row["et_us"], width)
        for (species, user), priority in wanted.items():
            key = (user, species, row["location_id"], start)
            held = key in seen and (ttl_us is None or at - seen[key] < ttl_us)
            if species == row["species_code"] and user != row["user_id"] and not held:
                seen[key] = at
                out.append((*key, row["event_id"], priority))
    return out


def random_sightings(rng: random.Random, n: int, disorder: int, ties: bool = False) -> list[dict]:
    """Clean rows in arrival order with event-time disorder up to ``disorder`` micros."""
    rows, clock = [], 1_700_000_000_000_000
    for seq in range(n):
        clock += 0 if ties and rng.random() < 0.5 else rng.randrange(0, 2 * MINUTE)
        back = rng.randrange(0, disorder + 1) if rng.random() < 0.3 else rng.randrange(0, MINUTE)
        rows.append(
            {
                "arrival_us": clock,
                "seq": seq,
                "event_id": f"e{seq}",
                "user_id": rng.choice(["", "u1", "u2", "u3"]),
                "species_code": rng.choice(["a", "b"]),
                "location_id": rng.choice(["x", "y"]),
                "et_us": clock - back,
                "cnt": rng.randrange(0, 5),
            }
        )
    return rows


def random_changes(rng: random.Random, n: int, first: int, last: int) -> list[dict]:
    return [
        {
            "user_id": rng.choice(["u1", "u2", "u3", "u4"]),
            "species_code": rng.choice(["a", "b", "c"]),
            "priority": rng.choice(["low", "medium", "high"]),
            "active": rng.random() < 0.6,
            "radius_km": 5.0,
            "updated_at": "",
            "arrival_us": rng.randrange(first - MINUTE, last),
            "seq": 1_000_000 + i,
        }
        for i in range(n)
    ]
