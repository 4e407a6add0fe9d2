"""Quality rules: base counts of a text, and cutoffs with certified false rejection.

A signal is a count relative to the text's size, in thousandths; a document is rejected
where a signal exceeds the cutoff of its stratum (language). Cutoffs come from labelled
documents. For each stratum and signal a fixed list of cutoffs is tried from the
loosest on. A cutoff is certified while an exact binomial test rejects "it turns away
more than its share of good documents", and the list ends at the first that is not:
testing in a fixed order needs no correction inside a list, and the error is divided
by the number of lists (Bonferroni). The allowed rate is divided by the number of
signals, so the rate of a stratum over all its signals stays below ``max_rate`` with
confidence ``1 - error``. Among the certified cutoffs the one that turns away most bad
documents is taken, each good one lost counting as ``cost`` bad ones; ties go to the
loosest, and a cutoff that turns away no bad document is not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightline.llm.common import free_name
from sightline.session import once, stage

WORD_BREAK = r"[\x20\x09-\x0D]+"
_BLANK, SYMBOL, CAPITAL = r"[\x20\x09-\x0D]", "[#*$%&|<>]", "[A-Z]"
WINDOW = 8
#: Words a text must have, and the largest share (in hundredths) of repeated words.
LEAST_WORDS, MOST_REPEATED = 20, 30

_SHARES = [900, 800, 700, 600, 500, 450, 400, 350, 300, 250, 200, 150, 100, 75, 50, 40, 30, 20, 10, 5]
_LENGTHS = [60000, 40000, 30000, 25000, 20000, 18000, 16000, 15000, 14000, 13000, 12000, 11000, 10000, 9000, 8000]
#: Signal: what is counted, what it is relative to, cutoffs from the loosest on.
SIGNALS = {
    "symbols": ("n_symbols", "word_chars", _SHARES),
    "dup_lines": ("n_dup_lines", "n_words", _SHARES),
    "repeats": ("n_repeat_words", "n_words", _SHARES),
    "word_length": ("word_chars", "n_words", _LENGTHS),
    "capitals": ("n_capitals", "word_chars", _SHARES),
}
MAX_RATE, ERROR, COST = 0.1, 0.05, 20
#: Strata up to which their cutoffs are broadcast (some 100 bytes each).
BROADCAST_STRATA = 10_000
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals"]


def _number(text: Column, characters: str) -> Column:
    return F.regexp_count(text, F.lit(characters)).cast("long")


def with_counts(docs: DataFrame, text_col: str = "text", name: str = "counts") -> DataFrame:
    """``docs`` with a struct ``name`` of the base counts, all long; null has no words.

    Windows are compared by 64-bit hashes of their words' 64-bit hashes. Everything
    stays in the row: nothing is shuffled, and a text without repeated windows is not
    sorted. The steps are kept apart so that each array is made once.
    """
    text, tmp = F.coalesce(F.col(text_col), F.lit("")), free_name(docs, "rule_step")
    words = F.filter(F.split(text, WORD_BREAK), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: F.trim(line, F.lit(" \t\n\x0b\x0c\r")) != "")
    first = F.struct(
        F.transform(words, lambda w: F.xxhash64(w)).alias("words"),
        (F.length(text) - _number(text, _BLANK)).alias("word_chars"),
        _number(text, SYMBOL).alias("n_symbols"),
        _number(text, CAPITAL).alias("n_capitals"),
        lines.alias("lines"),
    )
    step = F.col(tmp)
    df = once(docs, {tmp: first})
    w = step["words"]
    size = F.size(w)
    window = lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)])
    windows = F.when(size >= WINDOW, F.transform(F.sequence(F.lit(0), size - WINDOW), window))
    second = F.struct(
        size.cast("long").alias("n_words"),
        *[step[c].alias(c) for c in ("word_chars", "n_symbols", "n_capitals")],
        (F.size(step["lines"]) - F.size(F.array_distinct(step["lines"]))).cast("long").alias("n_dup_lines"),
        F.coalesce(windows, F.array().cast("array<bigint>")).alias("windows"),
    )
    df = once(df, {tmp: second})
    found = step["windows"]
    numbered = F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    several = F.size(F.array_distinct(found)) < F.size(found)
    numbers = [step[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_capitals", "n_dup_lines")]
    nothing = F.array().cast("array<struct<h:bigint,i:int>>")
    df = once(df, {tmp: F.struct(*numbers, F.when(several, F.sort_array(numbered)).otherwise(nothing).alias("sorted"))})
    ranked = step["sorted"]
    repeated = F.filter(
        ranked,
        lambda x, k: F.coalesce(F.get(ranked, k - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get(ranked, k + 1)["h"] == x["h"], F.lit(False)),
    )
    places = F.sort_array(F.transform(repeated, lambda x: x["i"]))
    df = once(df, {tmp: F.struct(*numbers, places.alias("places"))})
    at = step["places"]
    gaps = F.transform(at, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW))))
    covered = F.aggregate(gaps, F.lit(0).cast("long"), lambda total, gap: total + gap)
    counts = F.struct(*numbers, covered.alias("n_repeat_words"))
    return df.withColumn(tmp, counts).withColumnRenamed(tmp, name)


def base_failed(counts: Column) -> Column:
    words = counts["n_words"]
    return (words < LEAST_WORDS) | (100 * counts["n_repeat_words"] > MOST_REPEATED * words)


def signal(counts: Column, name: str) -> Column:
    part, whole, _ = SIGNALS[name]
    return (F.lit(1000) * counts[part] / F.greatest(counts[whole], F.lit(1))).cast("long")


def _step(counts: Column, name: str) -> Column:
    """The first cutoff of a signal's list that a document exceeds; one past the end if none."""
    value, grid = signal(counts, name), SIGNALS[name][2]
    return F.lit(len(grid) + 1) - F.size(F.filter(F.array(*map(F.lit, grid)), lambda x: value > x))


def tail(k: Column, n: Column, rate: float) -> Column:
    """P(X <= k) for X binomial (n, rate), summed term by term on the log scale.

    It is at most 1, and 1 where more than the allowed share was seen: no such cutoff
    can pass, so the sum is left out.
    """
    odds = F.lit(rate / (1 - rate))
    first = n * F.log(F.lit(1 - rate))
    start = F.struct(first.alias("term"), F.exp(first).alias("total"))

    def add(state: Column, i: Column) -> Column:
        term = state["term"] + F.log((n - i + 1) / i * odds)
        return F.struct(term.alias("term"), (state["total"] + F.exp(term)).alias("total"))

    steps = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    total = F.aggregate(steps, start, add, lambda state: state["total"])
    return F.when(k > n * rate, F.lit(1.0)).otherwise(total)


def _marks(labels: DataFrame) -> DataFrame:
    """(doc_id, good) of the labelled ids."""
    marks = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).filter(F.col("quality").isin(0, 1))
    return marks.groupBy("doc_id").agg(F.max("quality").alias("good"))


def cutoffs(counted: DataFrame, labels: DataFrame, max_rate: float = MAX_RATE, error: float = ERROR, cost: int = COST) -> DataFrame:
    """(stratum, signal, cutoff) for every list with a usable certified cutoff.

    ``counted`` has ``doc_id``, ``stratum`` and the struct ``counts``; ``labels`` has
    ``doc_id`` and ``quality``. Documents that fail the base rules are not in the
    tests. All labelled rows take part; an id labelled twice counts with its largest
    label, and labels other than 0 and 1 are ignored.
    """
    marks = _marks(labels)
    c = F.col("counts")
    known = counted.filter(~base_failed(c)).join(marks, "doc_id")
    at = F.array(*[F.struct(F.lit(name).alias("signal"), _step(c, name).alias("step")) for name in SIGNALS])
    known = known.select("stratum", "good", F.inline(at))
    known = known.groupBy("stratum", "signal", "step").agg(
        F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad")
    )
    lists = F.array(
        *[
            F.struct(F.lit(name).alias("signal"), F.lit(i + 1).alias("step"), F.lit(cut).cast("long").alias("cutoff"))
            for name, (_, _, grid) in SIGNALS.items()
            for i, cut in enumerate([*grid, -1])
        ]
    )
    strata = known.select("stratum").distinct()
    grid = strata.select("stratum", F.inline(lists)).join(known, ["stratum", "signal", "step"], "left")
    one = Window.partitionBy("stratum", "signal")
    upto = one.orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = grid.select(
        "stratum", "signal", "step", "cutoff",
        F.coalesce(F.sum("good").over(one), F.lit(0)).alias("n"),
        F.coalesce(F.sum("good").over(upto), F.lit(0)).alias("lost"),
        F.coalesce(F.sum("bad").over(upto), F.lit(0)).alias("caught"),
    ).filter("cutoff >= 0")
    number = strata.agg((F.count("*") * len(SIGNALS)).alias("lists"))
    level = F.lit(error) / F.col("lists")
    tested = running.crossJoin(F.broadcast(number)).withColumn("failed", (tail(F.col("lost"), F.col("n"), max_rate / len(SIGNALS)) > level).cast("int"))
    tested = tested.withColumn("failed", F.max("failed").over(upto)).filter("failed = 0 and caught > 0")
    gain = F.col("caught") - cost * F.col("lost")
    best = Window.partitionBy("stratum", "signal").orderBy(gain.desc(), F.col("step"))
    chosen = tested.filter(gain > 0).withColumn("rank", F.row_number().over(best)).filter("rank = 1")
    return chosen.select("stratum", "signal", "cutoff")


def by_stratum(found: DataFrame) -> DataFrame:
    """One row per stratum with a map from signal to cutoff (a signal without one is absent)."""
    pairs = F.sort_array(F.collect_list(F.struct("signal", "cutoff")))
    return found.groupBy("stratum").agg(F.map_from_entries(pairs).alias("cuts"))


def _judged(df: DataFrame, found: DataFrame, stratum: str, counts: str, verdict: str) -> DataFrame:
    """``df`` with the boolean ``verdict``; the cutoffs are a row per stratum."""
    table = stage(by_stratum(found), "cutoffs")
    key, cuts = free_name(df, "cut_stratum"), free_name(df, "cut_map")
    small = table.count() <= BROADCAST_STRATA
    table = table.select(F.col("stratum").alias(key), F.col("cuts").alias(cuts))
    joined = df.join(F.broadcast(table) if small else table, F.col(stratum) == F.col(key), "left")
    over = [F.coalesce(signal(F.col(counts), n) > F.col(cuts)[n], F.lit(False)) for n in SIGNALS]
    rejected = base_failed(F.col(counts))
    for one in over:
        rejected = rejected | one
    return joined.withColumn(verdict, ~rejected).drop(key, cuts)


def _stratum(lang: Column) -> Column:
    return F.coalesce(lang.cast("string"), F.lit(""))


def _narrow(docs: DataFrame) -> DataFrame:
    rows = with_counts(docs.select("doc_id", "text", _stratum(F.col("lang")).alias("stratum")))
    return stage(rows.select("doc_id", "stratum", "counts"), "rules")


def quality_rules(docs: DataFrame, labels: DataFrame, **limits) -> DataFrame:
    """Per row: ``doc_id``, the base counts, ``base_failed`` and ``kept``.

    Null and empty texts have no words and fail the base rules. Ids may be null (never
    labelled) or repeat. Languages are strata; null is the stratum of the empty
    language. Without labels, or with too few to certify anything, only the base rules
    reject. Of ``docs`` only ``doc_id``, ``text`` and ``lang`` are read.
    """
    rows = _narrow(docs)
    judged = _judged(rows, cutoffs(rows, labels, **limits), "stratum", "counts", "kept")
    counts = [F.col("counts")[c].alias(c) for c in COUNTS]
    return judged.select("doc_id", *counts, base_failed(F.col("counts")).alias("base_failed"), "kept")


def accepted(docs: DataFrame, labels: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns as they were.

    Rows repeat, and ids may be null, as in ``quality_rules``, and an empty table stays
    empty. Cutoffs only need the labelled documents, so the others are counted once.
    """
    labelled = docs.select("doc_id", "text", "lang").join(_marks(labels).select("doc_id"), "doc_id", "left_semi")
    found = cutoffs(_narrow(labelled), labels, **limits)
    counts, stratum = free_name(docs, "counts"), free_name(docs, "stratum")
    verdict = free_name(docs, "kept")
    rows = with_counts(docs.withColumn(stratum, _stratum(F.col("lang"))), name=counts)
    judged = _judged(rows, found, stratum, counts, verdict)
    return judged.filter(F.col(verdict)).select(*[F.col(f"`{c}`") for c in docs.columns])
