"""URL filters: host-suffix and path-prefix expressions, hash prefixes, full digests.

Every URL is expanded into the expressions a rule could have: the suffixes of its host
with as many labels as some rule's host, with the prefixes of its path as long as some
rule's path. Expressions meet rules by the first bytes of their digests; the full
digests confirm. The strongest rule of a URL is one number, so it is found by a
map-side combined maximum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.session import stage

#: Hex digits of a digest that the join reads; copies of the rules the join spreads over.
PREFIX, SALTS = 8, 16
ALLOW, BLOCK = "allow", "block"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty for null or without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, path


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """Rules from (verdict, rule) pairs; a rule is a host and a path that begins with /."""
    rows = [(verdict, *rule.partition("/")[::2]) for verdict, rule in rules]
    rows = [(verdict, host, f"/{path}") for verdict, host, path in rows]
    return spark.createDataFrame(rows, "verdict string, host string, path string")


def _digest(host: Column, path: Column) -> Column:
    # No host holds a slash, and a path begins with one, so the joint text is unambiguous.
    return F.sha2(F.concat(host, path), 256)


def judge(pages: DataFrame, rules: DataFrame, default: str = ALLOW, url_col: str = "url") -> DataFrame:
    """Per row: ``page_id``, ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has ``verdict``, ``host`` and ``path``. A rule fits its host and all
    subdomains, where the URL's path begins with the rule's. The longest rule text wins;
    of equally long ones the one with the longer host, then block. Without a fitting
    rule ``rule`` is null and the verdict ``default``. Null and malformed URLs have an
    empty host and path; rules with a null or unknown verdict, a null or empty host or a
    path that does not begin with / are ignored; repeated rules count once. Only
    ``page_id`` and the URL are read, and each row gives a row. Each distinct URL is
    judged once; the copies of a popular expression are spread over ``SALTS`` copies of
    the rules.
    """
    host, path = host_and_path(F.col(url_col))
    rows = stage(pages.select("page_id", host.alias("host"), path.alias("path")), "urls")
    usable = F.col("verdict").isin(ALLOW, BLOCK) & (F.col("host") != "") & F.col("path").startswith("/")
    rules = rules.filter(usable).select("verdict", "host", "path").distinct()
    blocks = (F.col("verdict") == BLOCK).cast("long")
    # Text length, then host length, then block, in one number.
    strength = F.length("host") + F.length("path")
    strength = (strength.cast("long") * (1 << 24) + F.length("host")) * 2 + blocks
    rules = rules.select(strength.alias("strength"), "host", "path", _digest(F.col("host"), F.col("path")).alias("full"))
    labels = [r[0] for r in rules.select(F.size(F.split("host", r"\.")).alias("n")).distinct().collect()]
    lengths = [r[0] for r in rules.select(F.length("path").alias("n")).distinct().collect()]

    seen = rows.select("host", "path").distinct()
    parts = F.split("host", r"\.")
    suffixes = F.array(*[F.when(F.size(parts) >= n, F.substring_index("host", ".", -n)) for n in sorted(labels)])
    prefixes = F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in sorted(lengths)])
    empty = F.array().cast("array<string>")
    seen = seen.select("host", "path", F.explode(F.array_compact(suffixes) if labels else empty).alias("suffix"))
    seen = seen.select("host", "path", "suffix", F.explode(F.array_compact(prefixes) if lengths else empty).alias("prefix"))
    seen = seen.select("host", "path", _digest(F.col("suffix"), F.col("prefix")).alias("digest"))
    salt = F.pmod(F.xxhash64("host", "path"), F.lit(SALTS))
    seen = seen.select("host", "path", "digest", F.substring("digest", 1, PREFIX).alias("short"), salt.alias("salt"))
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    spread = rules.select("strength", "full", F.substring("full", 1, PREFIX).alias("short"), salts.alias("salt"))
    hits = seen.join(spread, ["short", "salt"]).filter(F.col("digest") == F.col("full"))
    best = hits.groupBy("host", "path").agg(F.max("strength").alias("strength"))
    best = best.select(F.col("host").alias("h"), F.col("path").alias("p"), "strength")
    judged = rows.join(best, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")), "left")
    top = F.shiftright("strength", 1)
    host_size = top.bitwiseAND(F.lit((1 << 24) - 1)).cast("int")
    path_size = (F.shiftright(top, 24) - host_size).cast("int")
    rule = F.concat(F.col("host").substr(F.length("host") - host_size + 1, host_size), F.col("path").substr(F.lit(1), path_size))
    verdict = F.when(F.col("strength") % 2 == 1, BLOCK).when(F.col("strength").isNotNull(), ALLOW)
    return judged.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.lit(default)).alias("verdict"))
