"""The results of the operators that SQL can express, as SQL over the tables."""

from __future__ import annotations

from sightline.llm import mixing, rules

_WORD = r"[^\x20\x09-\x0D]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (
  SELECT page_id, strlen(html) AS payload_bytes, upper(sha1(html)) AS h,
         max(page_id) OVER (PARTITION BY html) AS newest
  FROM p),
e AS (
  SELECT page_id, payload_bytes, newest,
    (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + CAST((CAST('0x' || substr(h, 1 + 5 * (i // 4), 5) AS INT) >> (15 - 5 * (i % 4))) & 31 AS INT), 1), ''
        ORDER BY i)
     FROM range(32) t(i)) AS payload_digest
  FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = newest OR newest IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = newest OR newest IS NULL THEN NULL ELSE newest END AS refers_to
FROM e"""

_URLS = f"""
WITH rules(verdict, host, path) AS (VALUES
  ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
r AS (
  SELECT row_number() OVER () AS n, page_id,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
u AS (
  SELECT n, page_id, {_LOWER.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM r),
m AS (
  SELECT n, arg_max(rules.host || rules.path, length(rules.host || rules.path)) AS rule,
    arg_max(verdict, length(rules.host || rules.path)) AS verdict
  FROM u JOIN rules ON (u.host = rules.host OR ends_with(u.host, '.' || rules.host))
    AND starts_with(u.path, rules.path)
  GROUP BY n)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM u LEFT JOIN m USING (n)"""

_NOT_PLAIN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_DECONTAM = f"""
WITH dw AS (
  SELECT row_number() OVER () AS n, doc_id,
    regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_NOT_PLAIN}') AS w
  FROM documents),
bw AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
    regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_NOT_PLAIN}') AS w
  FROM benchmark),
bp AS (
  SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM bw WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS run FROM bp),
dp AS (
  SELECT n, size, w, unnest(range(1, len(w) - size + 2)) AS i
  FROM dw, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size),
hits AS (
  SELECT n, i, size, item
  FROM (SELECT n, size, i, array_to_string(w[i:i + size - 1], ' ') AS run FROM dp) JOIN windows USING (size, run)),
hit_words AS (
  SELECT n, count(DISTINCT p) AS n_hit FROM (SELECT n, unnest(range(i, i + size)) AS p FROM hits) GROUP BY n),
hit_items AS (
  SELECT n, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT n, item FROM hits) GROUP BY n)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit_words USING (n) LEFT JOIN hit_items USING (n)"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LEXICAL = f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS n, doc_id,
    regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_TERM}') AS w
  FROM documents),
size AS (
  SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS total FROM d WHERE len(w) > 0),
tf AS (
  SELECT n, term, count(*) AS tf FROM (SELECT n, unnest(w) AS term FROM d) GROUP BY n, term),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_TERM}')) AS term
  FROM benchmark),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * (SELECT docs FROM size) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf GROUP BY term),
scored AS (
  SELECT item_id, n, CAST(sum(weights.w * ((1000000000 * tf) // (1000 * tf + 8 *
      (10 + (90 * len(d.w) * (SELECT docs FROM size)) // (SELECT total FROM size))))) AS BIGINT) AS score
  FROM asked JOIN tf USING (term) JOIN weights USING (term) JOIN d USING (n)
  GROUP BY item_id, n)
SELECT item_id, CAST(row_number() OVER best AS INT) AS rank, doc_id, score
FROM scored JOIN d USING (n) WHERE score > 0
WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id)
QUALIFY row_number() OVER best <= 10"""

_MINHASH = f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT row_number() OVER () AS n, doc_id,
    regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS w
  FROM documents),
runs AS MATERIALIZED (
  SELECT DISTINCT n, array_to_string(w[i:i + 2], ' ') AS run
  FROM (SELECT n, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
sizes AS MATERIALIZED (SELECT n, count(*) AS size FROM runs GROUP BY n),
links AS MATERIALIZED (
  SELECT x, y FROM (
    SELECT a.n AS x, b.n AS y, count(*) AS common FROM runs a JOIN runs b USING (run) WHERE a.n <> b.n GROUP BY a.n, b.n)
  JOIN sizes p ON p.n = x JOIN sizes q ON q.n = y
  WHERE 100 * common >= 85 * (p.size + q.size - common)),
reached AS (
  SELECT n AS x, n AS y FROM d
  UNION
  SELECT reached.x, links.y FROM reached JOIN links ON reached.y = links.x),
lows AS (SELECT x AS n, min(e.doc_id) AS component_id FROM reached JOIN d e ON e.n = y GROUP BY x)
SELECT doc_id, coalesce(size, 0) AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM d JOIN lows USING (n) LEFT JOIN sizes USING (n)"""


def _time_of(course) -> str:
    cases = []
    pieces = mixing.segments(course)
    for k, (t, _, factor, slope, before) in enumerate(pieces):
        rest = f"(at - CAST({before!r} AS DOUBLE))"
        if slope:
            root = f"sqrt(CAST({factor * factor!r} AS DOUBLE) + CAST({2 * slope!r} AS DOUBLE) * {rest})"
            value = f"CAST({t!r} AS DOUBLE) + ({root} - CAST({factor!r} AS DOUBLE)) / CAST({slope!r} AS DOUBLE)"
        else:
            value = f"CAST({t!r} AS DOUBLE) + {rest} / CAST({factor!r} AS DOUBLE)"
        if k + 1 < len(pieces):
            cases.append(f"WHEN at < CAST({pieces[k + 1][4]!r} AS DOUBLE) THEN {value}")
        else:
            cases.append(f"ELSE {value}")
    return f"CASE {' '.join(cases)} END" if len(cases) > 1 else f"({value})"


def _position(number: str) -> str:
    kinds = len(mixing.COURSES)
    cases = " ".join(f"WHEN (rank - 1) % {kinds} = {k} THEN {_time_of(c)}" for k, c in enumerate(mixing.COURSES))
    at = f"(before + {number} * source_size) / target"
    cases = cases.replace("at - ", f"{at} - ").replace("WHEN at <", f"WHEN {at} <")
    return f"CASE WHEN taken > 0 THEN (CASE {cases} END) * CAST({mixing.SHARE!r} AS DOUBLE) * total END"


def _mixing() -> str:
    weights = ", ".join(map(str, mixing.WEIGHTS))
    return f"""
WITH r AS (
  SELECT doc_id, source, coalesce(md5(CAST(doc_id AS VARCHAR)), '') AS key,
    len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM r GROUP BY source),
k AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM s),
w AS (
  SELECT *, [{weights}][1 + (rank - 1) % {len(mixing.WEIGHTS)}] AS weight,
    CAST(sum(source_size) OVER () AS BIGINT) AS total FROM k),
l AS (
  SELECT *, (CAST({mixing.SHARE} AS DOUBLE) * total - {mixing.MOST} * coalesce(CAST(sum(source_size) OVER before AS BIGINT), 0))
    / CAST(sum(weight) OVER after AS BIGINT) AS level
  FROM w
  WINDOW before AS (ORDER BY source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    after AS (ORDER BY source_size / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
t AS (
  SELECT *, least(CAST({mixing.MOST} * source_size AS DOUBLE), weight * max(level) OVER ()) AS target FROM l),
o AS (
  SELECT r.*, source_size, rank, total, target,
    CAST(coalesce(sum(size) OVER (PARTITION BY r.source ORDER BY key, doc_id NULLS FIRST, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source),
p AS (
  SELECT *, CAST(floor(target) AS BIGINT) // greatest(source_size, 1) AS passes,
    greatest(0, least(size, CAST(floor(target) AS BIGINT) % greatest(source_size, 1) - before)) AS rest FROM o),
q AS (
  SELECT *, size * passes + rest AS taken, CASE WHEN rest > 0 THEN passes ELSE passes - 1 END AS last FROM p)
SELECT doc_id, size, source_size, target, taken,
  {_position("0")} AS position, {_position("last")} AS last_position
FROM q"""


def _rules() -> str:
    grid = ", ".join(f"('{name}', {i}, {cut})" for name, (_, _, cuts) in rules.SIGNALS.items() for i, cut in enumerate(cuts, 1))
    rate = rules.MAX_RATE / len(rules.SIGNALS)
    unions = " UNION ALL ".join(
        f"SELECT n, doc_id, stratum, base_failed, '{name}' AS signal, (1000 * {part}) // greatest({whole}, 1) AS value FROM c"
        for name, (part, whole, _) in rules.SIGNALS.items()
    )
    return f"""
WITH r AS (
  SELECT row_number() OVER () AS n, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT *, regexp_extract_all(text, '{_WORD}') AS w FROM r),
g AS (
  SELECT n, i, array_to_string(w[i:i + 7], ' ') AS run
  FROM (SELECT n, w, unnest(range(1, len(w) - 6)) AS i FROM w WHERE len(w) >= 8)),
twice AS (
  SELECT n, count(DISTINCT p) AS words FROM (
    SELECT n, unnest(range(i, i + 8)) AS p FROM (SELECT *, count(*) OVER (PARTITION BY n, run) AS times FROM g) WHERE times > 1)
  GROUP BY n),
dup AS (
  SELECT n, count(*) - count(DISTINCT line) AS lines
  FROM (SELECT n, unnest(string_split(text, chr(10))) AS line FROM r) WHERE regexp_matches(line, '{_WORD}') GROUP BY n),
c0 AS (
  SELECT n, doc_id, stratum, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    CAST(coalesce(dup.lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(twice.words, 0) AS BIGINT) AS n_repeat_words,
    CAST(length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS BIGINT) AS n_capitals
  FROM w LEFT JOIN twice USING (n) LEFT JOIN dup USING (n)),
c AS (
  SELECT *, n_words < {rules.LEAST_WORDS} OR 100 * n_repeat_words > {rules.MOST_REPEATED} * n_words AS base_failed FROM c0),
v AS ({unions}),
marks AS (
  SELECT doc_id, max(quality) AS good FROM labels WHERE quality IN (0, 1) GROUP BY doc_id),
grid(signal, step, cutoff) AS (VALUES {grid}),
tried AS (
  SELECT stratum, signal, step, cutoff, sum(good) AS n,
    coalesce(sum(good) FILTER (value > cutoff), 0) AS lost, coalesce(sum(1 - good) FILTER (value > cutoff), 0) AS caught
  FROM v JOIN marks USING (doc_id) JOIN grid USING (signal) WHERE NOT base_failed GROUP BY ALL),
tested AS (
  SELECT *, CASE WHEN lost > n * {rate!r} THEN 1.0 ELSE
    (SELECT sum(exp(CASE WHEN i = 0 THEN 0 ELSE lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) END
      + i * ln({rate!r}) + (n - i) * ln(1 - {rate!r}))) FROM range(CAST(lost + 1 AS BIGINT)) x(i)) END AS p,
    {rules.ERROR} / ({len(rules.SIGNALS)} * (SELECT count(DISTINCT stratum) FROM tried)) AS level FROM tried),
certified AS (
  SELECT *, max(CASE WHEN p > level THEN 1 ELSE 0 END) OVER (PARTITION BY stratum, signal ORDER BY step) AS failed FROM tested),
chosen AS (
  SELECT stratum, signal, cutoff FROM certified WHERE failed = 0 AND caught > 0 AND caught - {rules.COST} * lost > 0
  QUALIFY row_number() OVER (PARTITION BY stratum, signal ORDER BY caught - {rules.COST} * lost DESC, step) = 1),
over AS (
  SELECT DISTINCT n FROM v JOIN chosen USING (stratum, signal) WHERE value > cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_capitals, base_failed,
  NOT base_failed AND over.n IS NULL AS kept
FROM c LEFT JOIN over USING (n)"""


def _centroids(k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: str = "1:") -> str:
    """Rounds one after the other: distances of all vectors to all centroids, then exact means."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT n, any_value(vec_id) AS vec_id, any_value(v) AS v, arg_min(c, distance) AS c, min(distance) AS distance
  FROM (SELECT n, vec_id, v, c, CAST(list_sum([(v[i] - w[i]) * (v[i] - w[i]) for i in range(1, {dims + 1})]) AS BIGINT) AS distance
    FROM kept CROSS JOIN (SELECT * FROM c{r} ORDER BY c)) GROUP BY n)""")
        if r < rounds:
            steps.append(f"""
m{r} AS (
  SELECT c, list(mean ORDER BY i) AS w
  FROM (SELECT c, i, CAST(floor_div AS BIGINT) AS mean FROM (
    SELECT c, i, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS floor_div
    FROM (SELECT c, unnest(v) AS x, unnest(range(1, {dims + 1})) AS i FROM a{r}) GROUP BY c, i)) GROUP BY c),
c{r + 1} AS MATERIALIZED (SELECT c, coalesce(m{r}.w, c{r}.w) AS w FROM c{r} LEFT JOIN m{r} USING (c))""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, [CAST(floor(CAST(x AS DOUBLE) * {scale}) AS BIGINT) for x in embedding] AS v
  FROM embeddings
  WHERE len(embedding) = {dims} AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = {dims}),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v AS w
  FROM (SELECT v, sha256('{seed}' || CAST(vec_id AS VARCHAR)) AS h FROM kept ORDER BY h, v LIMIT {k})),{",".join(steps)}
SELECT vec_id, CAST(c AS INT) AS cluster, distance,
  CAST(sum(distance) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(w, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (c)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op5_mixing": _mixing(),
        "op6_warc": _WARC,
        "op8_url_filter": _URLS,
        "op9_quality_rules": _rules(),
        "op10_decontamination": _DECONTAM,
        "op11_lexical_search": _LEXICAL,
        "op12_minhash": _MINHASH,
        "op13_centroids": _centroids(),
    }
