"""The registered queries as plain SQL over the provided tables."""

from __future__ import annotations

_SIGHTINGS = """
e0 AS (
  SELECT event_id AS n, user_id AS uid, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INT) AS k,
         1704067200000000 + (epoch_us(ts) - 1704067200000000) // 60 AS et_us
  FROM events),
s AS (
  SELECT n, uid, event_type, et_us, k,
    et_us + CASE WHEN n % 17 = 0 THEN 650000000
                 WHEN n % 13 = 0 THEN 172000000 ELSE 0 END AS arrival_us,
    CASE WHEN n % 37 = 0 THEN '' WHEN n % 11 = 3 THEN 'evt_' || (n - 1)
         ELSE 'evt_' || n END AS event_id,
    CASE WHEN n % 29 = 0 THEN '' ELSE 'user_' || (uid % 40) END AS user_id,
    CASE WHEN n % 31 = 0 THEN '' ELSE event_type END AS species_code,
    'loc_' || (k % 3) AS location_id,
    CAST(37 + k % 3 AS DOUBLE) + CAST(uid % 100 AS DOUBLE) / 100 AS lat,
    CAST(-122 - k % 3 AS DOUBLE) - CAST(n % 100 AS DOUBLE) / 100 AS lng,
    CASE WHEN n % 41 = 0 THEN -3
         WHEN n % 997 = 0 THEN CAST(9223372036854775807 AS HUGEINT)
         WHEN n % 1009 = 1 THEN CAST(100000000000000000000000000007 AS HUGEINT)
         ELSE CAST(floor(value) AS BIGINT) % 8 END AS cnt
  FROM e0)"""

_CLEAN = (
    _SIGHTINGS
    + """,
valid AS (
  SELECT * FROM s WHERE user_id <> '' AND species_code <> '' AND event_id <> '' AND cnt >= 0),
clean AS (
  SELECT *, et_us - et_us % 900000000 AS ws, et_us - et_us % 900000000 + 900000000 AS we
  FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY arrival_us, n) AS rk FROM valid)
  WHERE rk = 1)"""
)

_LATENESS = (
    _CLEAN
    + """,
m AS (
  SELECT *, max(et_us) OVER (ORDER BY arrival_us, n ROWS UNBOUNDED PRECEDING) AS mx FROM clean),
l AS (
  SELECT *, mx - 120000000 AS wm,
    CASE WHEN mx - 120000000 < we OR et_us >= we THEN 'on_time'
         WHEN mx - 120000000 <= et_us + 120000000 THEN 'within_lateness'
         ELSE 'late' END AS st
  FROM m)"""
)

_PANES = (
    _LATENESS
    + """,
ends AS (SELECT DISTINCT we FROM clean),
closing AS (
  SELECT we, min(wm) AS cwm FROM (SELECT ends.we, l.wm FROM ends JOIN l ON l.wm >= ends.we) GROUP BY we),
main_p AS (
  SELECT location_id, species_code, ws, we, 'main' AS pane, NULL::VARCHAR AS event_id,
         CAST(sum(cnt) AS VARCHAR) AS sighting_count, count(DISTINCT user_id) AS unique_birders
  FROM l WHERE st = 'on_time' GROUP BY ALL),
panes AS (
  SELECT main_p.*, cwm AS wm FROM main_p JOIN closing USING (we)
  UNION ALL
  SELECT location_id, species_code, ws, we, 'late', event_id, CAST(cnt AS VARCHAR), 1, wm
  FROM l WHERE st = 'within_lateness')"""
)

_HISTORY = (
    _SIGHTINGS
    + """,
pref AS (
  SELECT 'user_' || (c_custkey % 40) AS user_id,
         ['click', 'error', 'purchase', 'signup', 'view'][1 + c_nationkey % 5] AS species_code,
         ['low', 'medium', 'high'][1 + length(c_mktsegment) % 3] AS priority,
         c_acctbal >= 0 AS active,
         CAST(CASE WHEN c_custkey % 89 = 0 THEN 40030 WHEN c_custkey % 83 = 0 THEN 25000
              ELSE 5 + 2 * c_nationkey END AS DOUBLE) AS radius_km,
         1704067200000000 + (c_custkey % 1000000) * 26843545601 % 43200000000 AS arrival_us,
         c_custkey AS n
  FROM customer),
hist AS (
  SELECT *, arrival_us AS vf,
    lead(arrival_us) OVER (PARTITION BY user_id, species_code ORDER BY arrival_us, n) AS vt
  FROM pref)"""
)

_MATCHES = (
    _HISTORY
    + _CLEAN[len(_SIGHTINGS) :]
    + """,
matches AS (
  SELECT h.user_id, c.species_code, c.location_id, c.ws, h.vf, c.arrival_us, c.n, c.event_id, h.priority
  FROM clean c JOIN hist h ON c.species_code = h.species_code
   AND h.vf <= c.arrival_us AND (h.vt IS NULL OR c.arrival_us < h.vt)
  WHERE h.active AND h.user_id <> c.user_id)"""
)

# The JSON form of the sightings: the same rows with text-level corruption.
_JSON = (
    _SIGHTINGS
    + """,
j0 AS (
  SELECT *,
    '{"event_id":' || CASE WHEN n % 79 = 0 THEN CAST(n + 1 AS VARCHAR) ELSE '"' || event_id || '"' END
    || ',"user_id":' || CASE WHEN n % 83 = 0 THEN CAST(uid % 40 + 1 AS VARCHAR) ELSE '"' || user_id || '"' END
    || ',"species_code":"' || species_code
    || '","common_name":"' || event_type
    || '","location_id":"' || CASE WHEN n % 73 = 0 THEN '' ELSE location_id END
    || '","lat":' || (37 + k % 3) || '.' || lpad(CAST(uid % 100 AS VARCHAR), 2, '0')
    || ',"lng":' || (-122 - k % 3) || '.' || lpad(CAST(n % 100 AS VARCHAR), 2, '0')
    || CASE WHEN n % 71 = 0 THEN ''
       ELSE ',"event_time":"' || CASE WHEN n % 61 = 0 THEN 'not-a-timestamp' ELSE {et} END || '"' END
    || CASE WHEN n % 59 = 0 THEN '' WHEN n % 67 = 0 THEN ',"count":2.0' ELSE ',"count":' || cnt END
    || CASE WHEN n % 53 = 0 THEN ',"confidence":1.5' ELSE ',"confidence":0.92' END
    || ',"source":"manual_log"' || CASE WHEN n % 43 = 0 THEN '' ELSE '}}' END AS body
  FROM s),
j AS (
  SELECT *, CASE WHEN n % 47 = 0 THEN '[' || body || ']' ELSE body END AS txt FROM j0),
r AS (
  SELECT * REPLACE (
      CASE WHEN n % 79 = 0 THEN CAST(n + 1 AS VARCHAR) ELSE event_id END AS event_id,
      CASE WHEN n % 83 = 0 THEN CAST(uid % 40 + 1 AS VARCHAR) ELSE user_id END AS user_id),
    CASE WHEN NOT json_valid(txt) THEN 'json_parse_error'
                 WHEN json_type(txt) <> 'OBJECT' THEN 'invalid_record_type' END AS reject
  FROM j),
v AS (
  SELECT *,
    [x FOR x IN [
      CASE WHEN user_id = '' THEN 'missing_user_id' END,
      CASE WHEN species_code = '' THEN 'missing_species_code' END,
      CASE WHEN n % 59 <> 0 AND n % 67 = 0 THEN 'invalid_count_type' END,
      CASE WHEN n % 59 <> 0 AND n % 67 <> 0 AND cnt < 0 THEN 'negative_count' END,
      CASE WHEN n % 71 = 0 THEN 'missing_event_time' WHEN n % 61 = 0 THEN 'invalid_event_time' END,
      CASE WHEN event_id = '' THEN 'missing_event_id' END,
      CASE WHEN n % 73 = 0 THEN 'missing_location_id' END,
      CASE WHEN n % 79 = 0 THEN 'invalid_event_id_type' END] IF x IS NOT NULL] AS codes
  FROM r),
jvalid AS (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY arrival_us, n) AS rk,
    CASE WHEN n % 59 = 0 THEN 1 ELSE cnt END AS delta
  FROM v WHERE reject IS NULL AND len(codes) = 0)"""
)


def _iso(us: str) -> str:
    us = f"({us})"
    return (
        f"CASE WHEN {us} % 1000000 = 0 THEN strftime(make_timestamp({us}), '%Y-%m-%dT%H:%M:%SZ') "
        f"ELSE strftime(make_timestamp({us}), '%Y-%m-%dT%H:%M:%S.%fZ') END"
    )


_JSON = _JSON.replace("{et}", _iso("et_us")).replace("}}", "}")
_NOW = "2024-01-01T00:00:00Z"
_CODES = "array_to_string(codes, ',')"


def _sql(base: str, query: str) -> str:
    return f"WITH {base.strip()}\n{query.strip()}"


def _id(prefix: str, *parts: str) -> str:
    pieces = []
    for part in parts:
        text = f"coalesce(CAST({part} AS VARCHAR), '')"
        pieces.append(f"length({text}) || ':' || {text}")
    return f"'{prefix}' || md5({' || '.join(pieces)})"


_TOTALS = """SELECT location_id, species_code, ws AS window_start_us, we AS window_end_us,
       CAST(sum(cnt) AS VARCHAR) AS sighting_count, count(DISTINCT user_id) AS unique_birders
FROM clean GROUP BY ALL"""

_FIRST_ALERT = """SELECT user_id, species_code, location_id, ws AS window_start_us,
       ws + 900000000 AS window_end_us, arrival_us, n AS seq, event_id, priority
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, species_code, location_id, ws
                                   ORDER BY arrival_us, n) AS rk FROM {matches})
WHERE rk = 1"""

_SNAPSHOT = """,
snap AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, species_code
                                              ORDER BY arrival_us DESC, n DESC) AS rk FROM pref)
  WHERE rk = 1 AND active)"""

_ANCHORS = """,
anchors AS (
  SELECT user_id, lat, lng FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY arrival_us DESC, n DESC) AS last FROM clean)
  WHERE last = 1),
near AS (
  SELECT p.user_id, c.species_code, c.location_id, c.ws, c.arrival_us, c.n, c.event_id, p.priority
  FROM clean c JOIN snap p USING (species_code) JOIN anchors a ON a.user_id = p.user_id
  WHERE p.user_id <> c.user_id AND 2 * 6371.0 * asin(least(1.0, sqrt(
    pow(sin(radians(c.lat - a.lat) / 2), 2)
    + cos(radians(a.lat)) * cos(radians(c.lat)) * pow(sin(radians(c.lng - a.lng) / 2), 2)))) <= CASE WHEN p.n % 71 = 0 THEN CAST('Infinity' AS DOUBLE) ELSE p.radius_km END)"""

_JCLEAN = """SELECT location_id AS key, event_id, user_id, species_code, location_id,
       et_us, CAST(delta AS VARCHAR) AS cnt, txt AS text, arrival_us, n AS seq FROM jvalid WHERE rk = 1"""

_LATE_SIGNALS = """SELECT location_id AS key, 'late_event_dropped' AS signal_type, event_id,
       {et} AS event_time, {we} AS window_end, {wm} AS watermark FROM l WHERE st = 'late'""".format(
    et=_iso("et_us"), we=_iso("we"), wm=_iso("wm")
)


def oracle_sql() -> dict[str, str]:
    """SQL per registered query."""
    queries = {
        "event_time_parse": _sql(
            _JSON,
            f"""SELECT n AS seq, CASE WHEN n % 61 <> 0 AND n % 71 <> 0 THEN et_us END AS et_us,
                CASE WHEN n % 61 <> 0 AND n % 71 <> 0 THEN {_iso("et_us")} END AS event_time
                FROM v WHERE reject IS NULL""",
        ),
        "window_bounds": _sql(
            _SIGHTINGS,
            f"""SELECT n AS seq, {_iso("et_us - et_us % 900000000")} AS window_start,
                {_iso("et_us - et_us % 900000000 + 900000000")} AS window_end FROM s""",
        ),
        "window_identity": _sql(
            _SIGHTINGS,
            f"""SELECT location_id, species_code, {_iso("et_us - et_us % 900000000")} AS window_start,
                count(*) AS n FROM s GROUP BY ALL""",
        ),
        "decode_route": _sql(
            _JSON,
            """SELECT n AS seq, coalesce(reject, 'object') AS route, location_id AS key,
               CASE WHEN reject = 'json_parse_error' THEN substr(txt, 1, 512) END AS raw_preview
               FROM r""",
        ),
        "validate_issues": _sql(
            _JSON, f"SELECT n AS seq, {_CODES} AS codes FROM v WHERE reject IS NULL"
        ),
        "issue_histogram": _sql(
            _JSON,
            """SELECT code, count(*) AS n
               FROM (SELECT unnest(codes) AS code FROM v WHERE reject IS NULL) GROUP BY code""",
        ),
        "dead_letters": _sql(
            _JSON,
            f"""SELECT location_id AS key, {_id("dl_", "'bird_sightings_raw'", "n")} AS dead_letter_id,
                'bird_sightings_raw' AS original_topic, coalesce(reject, 'validation_failed') AS reason_code,
                CASE WHEN reject = 'json_parse_error' THEN substr(txt, 1, 512) END AS raw_preview,
                CASE WHEN reject IS DISTINCT FROM 'json_parse_error' THEN txt END AS payload,
                CASE WHEN reject IS NULL THEN {_CODES} END AS codes
                FROM v WHERE reject IS NOT NULL OR len(codes) > 0""",
        ),
        "dq_validation_failed": _sql(
            _JSON,
            f"""SELECT location_id AS key, 'validation_failed' AS signal_type,
                CASE WHEN n % 79 <> 0 THEN event_id END AS event_id, {_CODES} AS codes FROM v WHERE reject IS NULL AND len(codes) > 0""",
        ),
        "clean_sightings": _sql(_JSON, _JCLEAN),
        "dq_duplicates": _sql(
            _JSON,
            """SELECT location_id AS key, 'duplicate_event_id' AS signal_type, event_id,
               n AS seq FROM jvalid WHERE rk > 1""",
        ),
        "dq_all": _sql(
            _JSON,
            """, jc AS (SELECT *, et_us - et_us % 900000000 + 900000000 AS we,
                 max(et_us) OVER (ORDER BY arrival_us, n ROWS UNBOUNDED PRECEDING) - 120000000 AS wm
                 FROM jvalid WHERE rk = 1)
               SELECT 'validation_failed' AS signal_type, location_id AS key,
                 CASE WHEN n % 79 <> 0 THEN event_id END AS event_id, n AS seq
               FROM v WHERE reject IS NULL AND len(codes) > 0
               UNION ALL SELECT 'duplicate_event_id', location_id, event_id, n FROM jvalid WHERE rk > 1
               UNION ALL SELECT 'late_event_dropped', location_id, event_id, n
               FROM jc WHERE wm >= we AND wm > et_us + 120000000""",
        ).replace(")\n, jc", "), jc"),
        "running_watermark": _sql(
            _LATENESS, "SELECT n AS seq, mx AS max_et_us, wm AS watermark_us FROM l"
        ),
        "lateness_class": _sql(_LATENESS, "SELECT n AS seq, st AS lateness FROM l"),
        "window_closed": _sql(
            _LATENESS, "SELECT n AS seq, (et_us < we AND we <= wm) AS closed FROM l"
        ),
        "dq_late_events": _sql(_LATENESS, _LATE_SIGNALS),
        "hotspot_totals": _sql(_CLEAN, _TOTALS),
        "hotspot_salted": _sql(_CLEAN, _TOTALS),
        "hotspot_panes": _sql(
            _PANES,
            f"""SELECT location_id AS key, {_id("hm_", "location_id", "species_code", "ws", "pane", "event_id")}
                AS metric_id, location_id, species_code, {_iso("ws")} AS window_start,
                {_iso("we")} AS window_end, sighting_count, unique_birders,
                {_iso("wm")} AS watermark_at_emit, pane FROM panes""",
        ),
        "hotspot_open": _sql(
            _LATENESS, _TOTALS.replace("FROM clean", "FROM l WHERE we > (SELECT max(wm) FROM l)")
        ),
        "late_refresh_diff": _sql(
            _PANES,
            """, f AS (SELECT location_id, species_code, ws, we, sum(cnt) AS c FROM clean GROUP BY ALL),
               e AS (SELECT location_id, species_code, ws, we, sum(CAST(sighting_count AS HUGEINT)) AS c FROM panes GROUP BY ALL)
               SELECT location_id, species_code, ws AS window_start_us, we AS window_end_us,
                 CAST(f.c AS VARCHAR) AS full_count, CAST(e.c AS VARCHAR) AS emitted_count,
                 CAST(coalesce(f.c, 0) - coalesce(e.c, 0) AS VARCHAR) AS missing
               FROM f FULL JOIN e USING (location_id, species_code, ws, we)""",
        ).replace("\n, f AS", ", f AS"),
        "hot_key_share": _sql(
            _CLEAN,
            """SELECT location_id, count(*) AS n,
               count(*) * 1000000 // (SELECT count(*) FROM clean) AS share_ppm
               FROM clean GROUP BY location_id""",
        ),
        "quality_rates": _sql(
            _JSON,
            """SELECT arrival_us - arrival_us % 900000000 AS window_start_us,
               coalesce(reject, 'validation_failed') AS reason_code, count(*) AS n
               FROM v WHERE reject IS NOT NULL OR len(codes) > 0 GROUP BY ALL""",
        ),
        "pref_history": _sql(
            _HISTORY,
            """SELECT user_id, species_code, priority, active, n AS seq, vf AS valid_from_us,
               vt AS valid_to_us FROM hist""",
        ),
        "pref_snapshot": _sql(
            _HISTORY + _SNAPSHOT, "SELECT user_id, species_code, priority, n AS seq FROM snap"
        ),
        "alert_matches": _sql(
            _MATCHES,
            """SELECT user_id, species_code, location_id, ws AS window_start_us, vf AS valid_from_us,
               arrival_us, n AS seq, event_id, priority
               FROM (SELECT *, row_number() OVER (PARTITION BY user_id, species_code, location_id, ws, vf
                                                  ORDER BY arrival_us, n) AS rk FROM matches)
               WHERE rk = 1""",
        ),
        "alerts_asof": _sql(_MATCHES, _FIRST_ALERT.format(matches="matches")),
        "alerts_snapshot": _sql(
            _HISTORY + _SNAPSHOT + _CLEAN[len(_SIGHTINGS) :],
            _FIRST_ALERT.format(
                matches="""(SELECT p.user_id, c.species_code, c.location_id, c.ws, c.arrival_us,
                c.n, c.event_id, p.priority FROM clean c JOIN snap p USING (species_code)
                WHERE p.user_id <> c.user_id)"""
            ),
        ),
        "alert_records": _sql(
            _MATCHES,
            f"""SELECT user_id AS key, {_id("al_", "user_id", "species_code", "location_id", "ws")} AS alert_id,
                user_id, species_code, location_id, {_iso("ws")} AS window_start,
                {_iso("ws + 900000000")} AS window_end, event_id AS sighting_event_id, priority
                FROM (SELECT *, row_number() OVER (PARTITION BY user_id, species_code, location_id, ws
                                                   ORDER BY arrival_us, n) AS rk FROM matches)
                WHERE rk = 1""",
        ),
        "contract_sighting": _sql(
            _JSON,
            """SELECT n AS seq, array_to_string([x FOR x IN [
                 CASE WHEN n % 79 = 0 THEN 'event_id: type' WHEN event_id = '' THEN 'event_id: minLength' END,
                 CASE WHEN n % 83 = 0 THEN 'user_id: type' WHEN user_id = '' THEN 'user_id: minLength' END,
                 CASE WHEN species_code = '' THEN 'species_code: minLength' END,
                 CASE WHEN n % 73 = 0 THEN 'location_id: minLength' END,
                 CASE WHEN n % 71 = 0 THEN 'event_time: required' WHEN n % 61 = 0 THEN 'event_time: format' END,
                 CASE WHEN n % 59 = 0 THEN 'count: required'
                      WHEN n % 67 <> 0 AND cnt < 0 THEN 'count: minimum' END,
                 CASE WHEN n % 53 = 0 THEN 'confidence: maximum' END] IF x IS NOT NULL], ',')
               AS violations FROM v WHERE reject IS NULL""",
        ),
        "contract_preference": _sql(
            _HISTORY,
            """SELECT n AS seq, array_to_string([x FOR x IN [
                 CASE WHEN n % 7 = 3 THEN 'user_id: required' END,
                 CASE WHEN n % 11 = 1 THEN 'priority: enum' END,
                 CASE WHEN n % 13 = 1 THEN 'radius_km: minimum' END] IF x IS NOT NULL], ',')
               AS violations FROM pref""",
        ),
        "contract_alert": _sql(
            _MATCHES,
            f"""SELECT {_id("al_", "user_id", "species_code", "location_id", "window_start_us")} AS alert_id,
                array_to_string([x FOR x IN [
                  CASE WHEN event_id LIKE '%1' THEN 'window_start: format' END,
                  CASE WHEN event_id LIKE '%4' THEN 'detected_at: format' END,
                  CASE WHEN event_id LIKE '%2' THEN 'priority: required' END] IF x IS NOT NULL], ',') AS violations
                FROM ({_FIRST_ALERT.format(matches="matches")})""",
        ),
        "preference_changes": _sql(
            _HISTORY,
            """SELECT user_id, species_code,
               CASE WHEN n % 11 = 1 THEN 'urgent' ELSE priority END AS priority, active,
               CAST(CASE WHEN n % 13 = 1 THEN -radius_km ELSE radius_km END AS DOUBLE) AS radius_km, n AS seq
               FROM pref WHERE n % 7 <> 3""",
        ),
    }
    queries["backfill"] = _sql(
        _SIGHTINGS,
        f"""SELECT {_id("evt_", "'archive'", "n")} AS event_id, 'archive' AS source,
            CAST(n AS VARCHAR) AS provider_record_id, arrival_us, n AS seq FROM s""",
    )
    queries["alerts_radius"] = _sql(
        _HISTORY + _SNAPSHOT + _CLEAN[len(_SIGHTINGS) :] + _ANCHORS,
        """SELECT user_id, species_code, location_id, ws AS window_start_us, arrival_us, n AS seq,
           event_id, priority
           FROM (SELECT *, row_number() OVER (PARTITION BY user_id, species_code, location_id, ws
                                              ORDER BY arrival_us, n) AS rk FROM near)
           WHERE rk = 1""",
    )
    empty = "NULL::VARCHAR"
    now = f"'{_NOW}'"
    queries["stream_clean"] = _sql(
        _JSON,
        f"""SELECT 'bird_sightings_clean' AS topic, location_id AS key, txt AS text, {empty} AS dead_letter_id,
             {empty} AS original_topic, {empty} AS reason_code, {empty} AS raw_preview, {empty} AS ingested_at,
             {empty} AS signal_type, {empty} AS event_id, {empty} AS detail, {empty} AS event_time, {empty} AS window_end,
             {empty} AS watermark, {empty} AS observed_at, {empty} AS codes, arrival_us, n AS seq
           FROM jvalid WHERE rk = 1
           UNION ALL SELECT 'data_quality_events', location_id, NULL, NULL, NULL, NULL, NULL, NULL, 'duplicate_event_id', event_id,
             'Duplicate event_id after retry or at-least-once replay', NULL, NULL, NULL, {now}, NULL, arrival_us, n
           FROM jvalid WHERE rk > 1
           UNION ALL SELECT 'data_quality_events', location_id, NULL, NULL, NULL, NULL, NULL, NULL, 'validation_failed',
             CASE WHEN n % 79 <> 0 THEN event_id END, NULL, NULL, NULL, NULL, {now}, {_CODES}, arrival_us, n
           FROM v WHERE reject IS NULL AND len(codes) > 0
           UNION ALL SELECT 'dead_letter_events', location_id,
             CASE WHEN reject IS DISTINCT FROM 'json_parse_error' THEN txt END, {_id("dl_", "'bird_sightings_raw'", "n")},
             'bird_sightings_raw', coalesce(reject, 'validation_failed'),
             CASE WHEN reject = 'json_parse_error' THEN substr(txt, 1, 512) END, {now}, NULL, NULL,
             CASE reject WHEN 'json_parse_error' THEN 'Record is not one complete JSON value'
                         WHEN 'invalid_record_type' THEN 'Record JSON must be an object' END,
             NULL, NULL, NULL, NULL, CASE WHEN reject IS NULL THEN {_CODES} END, arrival_us, n
           FROM v WHERE reject IS NOT NULL OR len(codes) > 0""",
    )
    odd = """),
odd AS (
  SELECT * REPLACE (
      CASE WHEN n % 23 = 5 THEN NULL ELSE et_us END AS et_us, CASE WHEN n % 23 = 6 THEN '' ELSE user_id END AS user_id,
      CASE WHEN n % 23 = 7 THEN '' ELSE species_code END AS species_code,
      CASE WHEN n % 23 = 8 THEN '' ELSE location_id END AS location_id)
  FROM whole),
clean AS (
  SELECT * REPLACE (et_us - et_us % 900000000 AS ws, et_us - et_us % 900000000 + 900000000 AS we)
  FROM odd WHERE et_us IS NOT NULL)"""

    def with_odd(base: str) -> str:
        head, tail = base.split("clean AS (", 1)
        inner, rest = tail.split("WHERE rk = 1)", 1)
        return f"{head}whole AS ({inner}WHERE rk = 1{odd}{rest}"

    queries["hotspot_odd_rows"] = _sql(
        with_odd(_PANES).replace("count(DISTINCT user_id)", "count(DISTINCT nullif(user_id, ''))").replace(
            "CAST(cnt AS VARCHAR), 1, wm", "CAST(cnt AS VARCHAR), CASE WHEN user_id = '' THEN 0 ELSE 1 END, wm"
        ),
        """SELECT location_id, species_code, ws AS window_start_us, we AS window_end_us, pane, event_id,
           sighting_count, unique_birders, wm AS watermark_us FROM panes""",
    )
    queries["alerts_odd_rows"] = _sql(
        with_odd(_MATCHES), _FIRST_ALERT.format(matches="(SELECT * FROM matches WHERE species_code <> '' AND location_id <> '')")
    )
    queries["lateness_guarded"] = _sql(
        _CLEAN,
        """, g AS (SELECT n, arrival_us, et_us + CASE WHEN n % 499 = 7 THEN 864000000000 ELSE 0 END AS et_us FROM clean),
           w AS (SELECT *, et_us - et_us % 900000000 + 900000000 AS we,
             max(CASE WHEN et_us <= arrival_us + 3600000000 THEN et_us END)
               OVER (ORDER BY arrival_us, n ROWS UNBOUNDED PRECEDING) - 120000000 AS wm FROM g)
           SELECT n AS seq, wm AS watermark_us,
             CASE WHEN wm IS NULL OR wm < we OR et_us >= we THEN 'on_time'
                  WHEN wm <= et_us + 120000000 THEN 'within_lateness' ELSE 'late' END AS lateness FROM w""",
    ).replace(")\n, g AS", "), g AS")
    queries["late_refresh_totals"] = queries["hotspot_totals"]
    queries["hotspot_salted_hot"] = queries["hotspot_totals"]
    queries["hot_keys"] = _sql(
        _CLEAN,
        """SELECT location_id, species_code, count(*) AS n,
           count(*) * 1000000 // (SELECT count(*) FROM clean) AS share_ppm
           FROM clean GROUP BY location_id, species_code
           HAVING count(*) * 1000000 >= 66700 * (SELECT count(*) FROM clean)""",
    )
    queries["hotspot_birders_sketch"] = _sql(
        _PANES,
        """SELECT l.location_id, l.species_code, l.ws AS window_start_us, l.we AS window_end_us,
           CAST(sum(l.cnt) AS VARCHAR) AS sighting_count, count(DISTINCT l.user_id) AS unique_birders, true AS within_bound
           FROM l JOIN closing USING (we) WHERE l.st <> 'late' GROUP BY ALL""",
    )
    queries["topic_replay"] = _sql(_JSON, "SELECT n AS seq, location_id AS key, txt AS value, arrival_us FROM j")
    queries["topic_replay_span"] = _sql(
        _JSON,
        """SELECT * FROM (
             SELECT n AS seq, location_id AS key, txt AS value, arrival_us * 4 - 3 * 1704067200000000 AS arrival_us FROM j)
           WHERE arrival_us >= 1704067200000000 + 60000000000 AND arrival_us < 1704067200000000 + 100000000000""",
    )
    queries["stream_hotspot_exact"] = _sql(
        _PANES,
        f"""SELECT 'hotspot_activity_metrics' AS topic, location_id AS key,
              {_id("hm_", "location_id", "species_code", "ws", "pane", "event_id")} AS metric_id, location_id, species_code,
              {_iso("ws")} AS window_start, {_iso("we")} AS window_end, sighting_count, unique_birders,
              {_iso("wm")} AS watermark_at_emit, pane, {empty} AS signal_type, {empty} AS event_id, {empty} AS detail,
              {empty} AS event_time, {empty} AS watermark, {empty} AS observed_at
            FROM panes
            UNION ALL SELECT 'data_quality_events', location_id, NULL, NULL, NULL, NULL, {_iso("we")}, NULL, NULL, NULL, NULL,
              'late_event_dropped', event_id, 'Event arrived beyond allowed lateness after watermark',
              {_iso("et_us")}, {_iso("wm")}, {now}
            FROM l WHERE st = 'late'""",
    )
    queries["stream_hotspot_native"] = _sql(
        _CLEAN,
        _TOTALS.replace("FROM clean", "FROM clean WHERE we <= (SELECT max(et_us) - 1800000000 FROM clean)"),
    )
    queries["stream_alerts"] = queries["alert_records"]
    queries["stream_alerts_ttl"] = _sql(
        _MATCHES,
        f""",
        keyed AS MATERIALIZED (
          SELECT user_id, species_code, location_id, ws, arrival_us, n, event_id, priority FROM matches),
        raised AS (
          SELECT * FROM keyed
          QUALIFY row_number() OVER (PARTITION BY user_id, species_code, location_id, ws ORDER BY arrival_us, n) = 1
          UNION ALL
          SELECT k.* FROM raised r JOIN keyed k USING (user_id, species_code, location_id, ws)
          WHERE k.arrival_us >= r.arrival_us + 300000000
          QUALIFY row_number() OVER (PARTITION BY user_id, species_code, location_id, ws ORDER BY k.arrival_us, k.n) = 1)
        SELECT user_id AS key, {_id("al_", "user_id", "species_code", "location_id", "ws")} AS alert_id,
          user_id, species_code, location_id, {_iso("ws")} AS window_start,
          {_iso("ws + 900000000")} AS window_end, event_id AS sighting_event_id, priority
        FROM raised""",
    ).replace("WITH ", "WITH RECURSIVE ", 1).replace(")\n,", "),", 1)
    return queries
