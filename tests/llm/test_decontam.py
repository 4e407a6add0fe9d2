from __future__ import annotations

import hashlib
import random
import re

from sightline.llm import decontam

PLAIN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    return re.findall(PLAIN_WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(text, items, size=10):
    got, hit, names = words(text), set(), set()
    for item, content in items:
        w = words(content)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            window = w[i : i + size]
            for k in range(len(got) - len(window) + 1):
                if got[k : k + len(window)] == window:
                    hit.update(range(k, k + len(window)))
                    names.add("" if item is None else str(item))
    return len(got), len(hit), sorted(names)


def tables(spark):
    rng = random.Random(5)
    vocab = ["é", "the", "cat", "Sat", "on", "a", "mat", "ñu", "7", "日本"]
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, say(rng.choice([3, 9, 10, 11, 25]))) for i in range(14)]
    items += [(50, "The  Cat—sat"), (51, None), (52, "!!!"), (None, "ñu ñu 7 7 ñu ñu"), (3, items[3][1]), (53, items[4][1])]
    texts = [say(rng.choice([0, 5, 60, 200])) for _ in range(25)]
    texts += [f"{say(4)}, {items[i][1].upper()}! {say(3)}" for i in range(14) if items[i][1]] + [None, "", "ñu, ñu 7 7\nñu ñu"]
    docs = [(i, t, "x") for i, t in enumerate(texts)] + [(None, texts[30], "x"), (3, texts[3], "x")]
    return docs, items, spark.createDataFrame(docs, "doc_id long, text string, found string"), spark.createDataFrame(items, "item_id long, text string")


def test_results_are_brute_forces(spark):
    docs, items, table, bench = tables(spark)
    for limit in (decontam.MAX_WINDOWS, 40):
        marked = decontam.contamination(table, bench, name="hit", max_windows=limit).collect()
        assert len(marked) == len(docs)
        for row in marked:
            assert (row.hit.n_words, row.hit.n_hit, row.hit["items"]) == plain(row.text, items)
            spans = [row.text[s.start : s.end] for s in row.hit.spans]
            assert sum(len(words(s)) for s in spans) == row.hit.n_hit == sum(w.end - w.start for w in row.hit.words)
            for span, place in zip(spans, row.hit.words):
                assert words(span) == words(row.text)[place.start : place.end]


def test_only_clean_rows_stay(spark):
    docs, items, table, bench = tables(spark)
    kept = decontam.decontaminated(table, bench)
    assert kept.columns == table.columns
    assert sorted(str(tuple(r)) for r in kept.collect()) == sorted(str(d) for d in docs if not plain(d[1], items)[1])


def test_empty_tables(spark):
    _, _, table, bench = tables(spark)
    assert decontam.contamination(table.limit(0), bench, name="hit").count() == 0
    assert {r.hit.n_hit for r in decontam.contamination(table, bench.limit(0), name="hit").collect()} == {0}


def test_long_text_is_scanned_to_its_end(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = spark.createDataFrame([(1, "x " * 400_000 + item)], "doc_id long, text string")
    bench = spark.createDataFrame([(9, item)], "item_id long, text string")
    row = decontam.contamination(docs, bench).first().found
    assert (row.n_words, row.n_hit, row["items"]) == (400_010, 10, ["9"])


def test_digest_of_items(spark):
    from conftest import SF_DIR

    from sightline.llm.queries import op10_decontamination

    rows = op10_decontamination(spark, SF_DIR).collect()
    assert {r.items_sha256 for r in rows if not r.n_items} == {hashlib.sha256(b"").hexdigest()}
    assert any(r.contaminated for r in rows)
