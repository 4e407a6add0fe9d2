"""Benchmark decontamination: one Aho-Corasick automaton over normalised test texts.

The automaton's letters are words: a test word's number, or 0 for any other word. Each
text is scanned once. Matches are word ranges, which map back to offsets in the original
text, because normalising keeps every byte in its place.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.llm.common import PLAIN, byte_slices, free_name
from sightline.session import stage

WINDOW = 10
#: Windows in one automaton: about 10 nodes each, some 100 MB in a worker.
MAX_WINDOWS = 150_000
_BYTES = 4 << 20
_SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("words", T.ArrayType(_SPAN)),
        T.StructField("spans", T.ArrayType(_SPAN)),
    ]
)


def windows_of(words: list[bytes], size: int = WINDOW) -> set[tuple[bytes, ...]]:
    """Runs of ``size`` words; all the words if they are fewer, none if there are none."""
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


class Automaton:
    """Automaton over the windows of (item id, text) rows."""

    def __init__(self, items: list[tuple[str, str]], size: int = WINDOW) -> None:
        self.numbers: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            for window in windows_of((text or "").encode().translate(PLAIN).split(), size):
                key = tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in window)
                owners.setdefault(key, set()).add(item)
        self.windows = [(len(key), frozenset(names)) for key, names in owners.items()]
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for number, key in enumerate(owners):
            self.machine.add_word(key, number)
        if owners:
            self.machine.make_automaton()

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, merged word ranges [start, end) that are hit, items found."""
        words = text.translate(PLAIN).split()
        if not self.windows or not words:
            return len(words), [], set()
        get = self.numbers.get
        numbers = tuple([get(w, 0) for w in words])
        ranges, items = [], set()
        for end, number in self.machine.iter(numbers):
            length, names = self.windows[number]
            ranges.append((end - length + 1, end + 1))
            items |= names
        return len(words), merged(ranges), items


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges joined where they touch or overlap."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def char_spans(text: bytes, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code point offsets in the original text of word ranges, in order."""
    plain, spans, at, number, chars, seen = text.translate(PLAIN), [], 0, 0, 0, 0
    wanted = iter([edge for r in ranges for edge in ((r[0], 0), (r[1] - 1, 1))])
    target = next(wanted, None)
    marks = []
    while target is not None:
        while plain[at : at + 1] == b" ":
            at += 1
        end = plain.find(b" ", at)
        end = len(plain) if end < 0 else end
        while target is not None and target[0] == number:
            to = end if target[1] else at
            chars, seen = chars + len(text[seen:to].decode()), to
            marks.append(chars)
            target = next(wanted, None)
        number, at = number + 1, end
    spans = list(zip(marks[::2], marks[1::2]))
    return spans


#: The automaton a worker holds, by the name of its set of items.
_BUILT: dict[str, Automaton] = {}


def _automaton(name: str, shared, size: int) -> Automaton:
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = Automaton(shared.value, size)
    return _BUILT[name]


def _scan(shared, size: int, found: Column | None, text: Column) -> Column:
    """Scan with the automaton of one set of items, adding to what other sets found."""

    name = uuid.uuid4().hex

    def results(texts: pa.Array, earlier: list | None) -> pa.Array:
        automaton = _automaton(name, shared, size)
        out = []
        for run in byte_slices(texts, _BYTES):
            for content in run:
                n_words, ranges, items = automaton.scan(content)
                if earlier is not None and (old := earlier[len(out)]):
                    ranges = merged([*ranges, *((s["start"], s["end"]) for s in old["words"])])
                    items = items | set(old["items"])
                as_dict = lambda pairs: [{"start": a, "end": b} for a, b in pairs]
                hit = sum(b - a for a, b in ranges)
                spans = char_spans(content, ranges) if ranges else []
                out.append({"n_words": n_words, "n_hit": hit, "items": sorted(items), "words": as_dict(ranges), "spans": as_dict(spans)})
        return pa.array(out, _ARROW)

    if found is None:

        @F.arrow_udf(FOUND)
        def first(texts: pa.Array) -> pa.Array:
            return results(texts, None)

        return first(text)

    @F.arrow_udf(FOUND)
    def again(texts: pa.Array, earlier: pa.Array) -> pa.Array:
        return results(texts, earlier.to_pylist())

    return again(text, found)


_PAIR = pa.struct([("start", pa.int32()), ("end", pa.int32())])
_ARROW = pa.struct(
    [("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("words", pa.list_(_PAIR)), ("spans", pa.list_(_PAIR))]
)


def _sets(items: DataFrame, max_windows: int) -> Iterator[list[tuple[str, str]]]:
    """Items in sets of bounded size: one for a usual benchmark, read set by set beyond."""
    items = items.distinct()
    total = items.agg(F.sum(F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")))).first()[0] or 0
    number = max(1, -(-total // max_windows))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(number))
    for k in range(number):
        yield [(r.item_id, r.text) for r in items.filter(part == k).collect()]


def contamination(docs: DataFrame, items: DataFrame, text_col: str = "text", name: str = "found", size: int = WINDOW, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """``docs`` with a struct ``name`` of what each text shares with the items.

    ``items`` has ``item_id`` and ``text`` (a row per question, answer or both). The
    struct holds ``n_words``, ``n_hit`` (words inside any occurrence of a window),
    ``items`` (sorted ids as text), ``words`` and ``spans`` (hit ranges, end exclusive,
    in words and in code points of the original). Null and empty texts have no words;
    repeated rows each get a result; an item without an id is the item named by the
    empty string; items without words match nothing; no items give no hits. A benchmark
    beyond ``max_windows`` is scanned in several automata, one pass each, with the rows
    written between the passes, so a worker holds one automaton of bounded size.
    """
    spark = docs.sparkSession
    item = F.coalesce(F.col("item_id").cast("string"), F.lit(""))
    items = items.select(item.alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    out, found = docs, None
    for rows in _sets(items, max_windows):
        if found is not None:
            out = stage(out, "decontam")
        shared = spark.sparkContext.broadcast(rows)
        out = out.withColumn(name, _scan(shared, size, found, F.col(text_col)))
        found = F.col(name)
    return out


def decontaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that share no window with an item, columns as they were."""
    name = free_name(docs, "found")
    marked = contamination(docs, items, name=name, **options)
    return marked.filter(F.col(f"{name}.n_hit") == 0).select(*[F.col(f"`{c}`") for c in docs.columns])
