from __future__ import annotations

import random

import pytest

from sightline.llm import urls


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    at = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:at])
    path = rest[at:]
    end = min([path.index(c) for c in "?#" if c in path] or [len(path)])
    return host, path[:end]


def plain(url, rules, default="allow"):
    host, path = split(url)
    best = None
    for verdict, rule in rules:
        h, _, p = rule.partition("/")
        p = f"/{p}"
        if (host == h or host.endswith(f".{h}")) and path.startswith(p):
            key = (len(h + p), len(h), verdict == "block", h + p, verdict)
            best = max(best or key, key)
    return host, path, best and best[3], best[4] if best else default


RULES = [
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
    ("block", "b.c/de"), ("allow", "c/x/de"), ("block", "same.net/"), ("allow", "same.net/"), ("allow", "é.org/ü"),
]
URLS = [
    None, "", "org/", "http://", "http://ORG/", "http://org", "https://a.example.org/es/x", "http://example.org/en/12?x#y", "http://example.org/en/2",
    "http://notexample.org/es/", "http://x.com/fr/", "http://x.com/de/a", "http://com/de/", "http://a.b.c/de", "http://b.c/x/de", "http://same.net/q",
    "http://x.É.org/ü1", "http://x.é.org/ü1", "http://a..org/", "http://org./", "http://u@h.org:80/p", "ftp://a://b.org/", "http://x.org?/es/", "http://\nx.org/\n/",
]


@pytest.mark.parametrize("rules", [RULES, RULES[:5], []])
def test_judgements(spark, rules):
    rng = random.Random(3)
    made = ["://".join(["http", rng.choice(["", "www."]) + rng.choice(["example.org", "b.c", "c", "x.com"]) + rng.choice(["/es/", "/en/1", "/x/de", "/fr/"])]) for _ in range(60)]
    every = URLS + made + [None]
    pages = spark.createDataFrame([(i if i else None, u, "x") for i, u in enumerate(every)], "page_id long, url string, host string")
    table = spark.createDataFrame([], "verdict string, host string, path string") if not rules else urls.rule_table(spark, rules + rules[:2])
    found = urls.judge(pages, table)
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    expected = [(i if i else None, *plain(u, rules)) for i, u in enumerate(every)]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected))


def test_odd_rules_and_empty_tables(spark):
    odd = [("allow", None, "/"), ("maybe", "org", "/"), ("block", "", "/"), ("block", "org", "x"), (None, "org", "/")]
    table = spark.createDataFrame(odd, "verdict string, host string, path string")
    pages = spark.createDataFrame([(1, "http://a.org/x"), (1, "http://a.org/x")], "page_id long, url string")
    assert [(r.rule, r.verdict) for r in urls.judge(pages, table, default="block").collect()] == [(None, "block")] * 2
    assert urls.judge(pages.limit(0), table).count() == 0


def test_a_long_host_and_path(spark):
    url = "http://" + "a." * 3000 + "org/" + "p" * 100_000
    pages = spark.createDataFrame([(1, url)], "page_id long, url string")
    assert urls.judge(pages, urls.rule_table(spark, RULES)).first().rule == "org/"
