"""LM scoring by masked pseudo-likelihood: a small bidirectional window network in numpy.

Words become 256 symbols: the edge of a text, the most frequent words of the corpus, and
groups of the other words by the hash of their last three bytes. The network predicts
every symbol from the two before and the two after it; a word of a group then has its
share of the group, by the counts of all words. The sum of both log-probabilities over
all words scores a document.

The shares of up to ``COMMON`` words travel with the tasks; those of all rarer words are
joined to the texts that have them.

Training reads every document. Vocabulary counts are summed over all words. The windows
of every text are dealt out over the rounds, so that every position is predicted in one
of them. Each round, every partition starts from the same parameters and trains on its
windows of that round; the parameters come back as one row a partition and are averaged
by their number of windows in groups of bounded size.
"""

from __future__ import annotations

import ctypes
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.llm.common import PLAIN, byte_slices
from sightline.session import stage

#: Symbols; frequent words among them; symbols seen on each side; width of the network.
SYMBOLS, WORDS, SIDE, HIDDEN = 256, 191, 2, 24
#: Rounds, over which all windows are dealt out; windows in a step; step size.
ROUNDS, STEP, RATE = 2, 512, 0.1
#: Words counted before a partition hands its counts on; rows averaged in one group.
KEPT_COUNTS, FAN_IN = 200_000, 64
#: Words whose counts are broadcast; those of the others are joined.
COMMON = 1 << 16
#: Steps in which the logarithms of joined words are added, so that any order adds up alike.
_FINE = 1 << 24
_BYTES = 4 << 20
#: Positions scored at a time; symbols of texts scored together, or one text.
_CHUNK, _TOGETHER = 1 << 9, 1 << 18
#: Where a padded text has a position's neighbours; the embeddings' first row of each place.
_PLACES = np.array([k for k in range(2 * SIDE + 1) if k != SIDE])
_FIRST_ROWS = np.arange(2 * SIDE)[:, None] * SYMBOLS


def one_thread() -> None:
    """Keep BLAS to the core of the task: on products this small its threads mostly spin.

    Changes only the speed; a BLAS without either name keeps its threads.
    """
    blas = ctypes.CDLL(np._core._multiarray_umath.__file__)
    for name in ("scipy_openblas_set_num_threads64_", "openblas_set_num_threads"):
        if hasattr(blas, name):
            getattr(blas, name)(1)
            return


def words_of(text: bytes) -> list[bytes]:
    """The words of one text; ``words_in`` takes those of many at a time."""
    return text.translate(PLAIN).split()


def words_in(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of ``texts``, the place of every word among them, and the words of each text.

    The places are in the order of the texts. No word becomes a Python object.
    """
    plain = np.frombuffer(b" ".join([b"", *texts, b""]).translate(PLAIN), np.uint8)
    space = plain == 32
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edges[::2], edges[1::2]
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(plain[~space])]
    found = pa.Array.from_buffers(pa.binary(), len(starts), buffers).dictionary_encode()
    over = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]))
    return found.dictionary, found.indices.to_numpy(), np.diff(over, prepend=0)


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n) of every word of all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = pa.table({"word": pa.array([], pa.binary()), "n": pa.array([], pa.int64())})
        for batch in batches:
            for run in byte_slices(batch.column(0), _BYTES):
                distinct, places, _ = words_in(run)
                found = pa.table({"word": distinct, "n": np.bincount(places, minlength=len(distinct))})
                both = pa.concat_tables([waiting, found]).group_by("word", use_threads=False)
                waiting = both.aggregate([("n", "sum")]).rename_columns(["word", "n"])
                if len(waiting) > KEPT_COUNTS:
                    yield from waiting.to_batches()
                    waiting = waiting.slice(0, 0)
        yield from waiting.to_batches()

    counted = docs.select(text_col).mapInArrow(count, "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def frequent(counted: DataFrame, size: int = WORDS) -> list[tuple[bytes, int]]:
    """The words with the largest counts, largest first, ties by the word."""
    return [(bytes(r.word), r.n) for r in counted.orderBy(F.col("n").desc(), "word").limit(size).collect()]


def vocabulary(docs: DataFrame, size: int = WORDS, text_col: str = "text") -> list[bytes]:
    """The most frequent words of all texts, most frequent first, ties by the word."""
    return [w for w, _ in frequent(word_counts(docs, text_col), size)]


def group_of(word: bytes, groups: int) -> int:
    return zlib.crc32(word[-3:]) % groups


class Shares:
    """log P(word | its group) by Witten and Bell: a word seen n times in a group of N words
    of T kinds has n / (N + T), all unseen words together have T / (N + T).

    ``logs`` has the words of the vocabulary, which are no group, and common others;
    ``rest`` is the counts of all others, or None if there are none.
    """

    def __init__(self, counted: DataFrame, known: list[tuple[bytes, int]]) -> None:
        self.groups = SYMBOLS - len(known) - 1
        total, kinds = np.zeros(self.groups, np.int64), np.zeros(self.groups, np.int64)
        for r in counted.groupBy(self._group().alias("g")).agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).collect():
            total[r.g], kinds[r.g] = r.n, r.kinds
        for word, n in known:
            total[group_of(word, self.groups)] -= n
            kinds[group_of(word, self.groups)] -= 1
        self.kinds = [max(1, int(k)) for k in kinds]
        self.all = [math.log(max(1, int(n + k))) for n, k in zip(total, kinds)]

        level = F.floor(F.log2("n") * 8)
        edge, room = None, COMMON
        for r in sorted(counted.groupBy(level.alias("level")).count().collect(), key=lambda r: -r.level):
            room -= r["count"]
            if room < 0:
                edge = r.level
                break
        common = counted if edge is None else counted.where(level > edge)
        self.logs = {bytes(r.word): math.log(r.n) - self.all[group_of(r.word, self.groups)] for r in common.collect()}
        self.logs |= {word: 0.0 for word, _ in known}
        self.rest = None if edge is None else counted.where(level <= edge)

    def _group(self) -> Column:
        return (F.crc32(F.substring("word", -3, 3)) % self.groups).cast("int")

    def of_rest(self, symbols: DataFrame) -> DataFrame:
        """(row, rest): the sum over the words in ``tail``, in steps of 1 / _FINE."""
        of = lambda values: F.get(F.array(*map(F.lit, values)), self._group())
        tails = symbols.select("row", F.inline("tail")).withColumnRenamed("n", "times")
        log = F.log(F.coalesce("n", of(self.kinds)).cast("double")) - of(self.all)
        steps = F.round(log * _FINE).cast("long") * F.col("times")
        return tails.join(self.rest, "word", "left").groupBy("row").agg(F.sum(steps).alias("rest"))


def symbols_of(distinct: pa.Array, words: pa.Array) -> np.ndarray:
    """The symbols of words: 0 is the edge, then ``words``, then groups of other words."""
    first = len(words) + 1
    ends = pc.binary_slice(distinct, -3).dictionary_encode()
    groups = np.array([group_of(end, SYMBOLS - first) for end in ends.dictionary.to_pylist()], np.int64)
    known = pc.index_in(distinct, value_set=words).fill_null(-1).to_numpy()
    return np.where(known < 0, first + groups[ends.indices.to_numpy()], known + 1).astype(np.uint8)


def encoded(docs: DataFrame, words: list[bytes], logs: dict[bytes, float] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, symbols, within, tail) with a byte per word of the whole text.

    ``within`` sums ``logs`` over the words that are there; ``tail`` counts the others.
    """
    shared = docs.sparkSession.sparkContext.broadcast((words, logs if logs is not None else dict.fromkeys(words, 0.0)))
    source = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    tail = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, log_of = shared.value
        known, having_log = pa.array(known, pa.binary()), pa.array(list(log_of), pa.binary())
        log_at = np.array([*log_of.values(), math.nan])
        for batch in batches:
            at = 0
            for run in byte_slices(batch.column(2), _BYTES):
                distinct, places, sizes = words_in(run)
                symbols = symbols_of(distinct, known)[places]
                logs = log_at[pc.index_in(distinct, value_set=having_log).fill_null(len(log_of)).to_numpy()][places]
                owner = np.repeat(np.arange(len(run)), sizes)
                joined = np.isnan(logs)
                logs[joined] = 0.0
                within = np.bincount(owner, logs, len(run)).astype(np.float64)
                pairs, times = np.unique(owner[joined] * len(distinct) + places[joined], return_counts=True)
                others = pa.StructArray.from_arrays([distinct.take(pa.array(pairs % max(1, len(distinct)))), pa.array(times, pa.int64())], fields=list(tail.value_type))
                begins = np.searchsorted(pairs, np.arange(len(run) + 1) * len(distinct)).astype(np.int32)
                ids = batch.slice(at, len(run))
                at += len(run)
                offsets = np.zeros(len(run) + 1, np.int32)
                np.cumsum(sizes, out=offsets[1:])
                texts = pa.Array.from_buffers(pa.binary(), len(run), [None, pa.py_buffer(offsets), pa.py_buffer(symbols)])
                columns = [ids.column(0), ids.column(1), texts, pa.array(within), pa.ListArray.from_arrays(begins, others, type=tail)]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "symbols", "within", "tail"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(of, f"row long, doc_id {kind}, symbols binary, within double, tail array<struct<word: binary, n: long>>")


class Network:
    """Sum of one embedding per place, rectified, then a softmax over the symbols."""

    SHAPES = {"embed": (2 * SIDE, SYMBOLS, HIDDEN), "hidden": (HIDDEN,), "out": (HIDDEN, SYMBOLS), "bias": (SYMBOLS,)}

    def __init__(self, vector: np.ndarray | None = None, seed: int = 0) -> None:
        sizes = [int(np.prod(s)) for s in self.SHAPES.values()]
        if vector is None:
            vector = np.random.default_rng(seed).normal(0, 0.1, sum(sizes))
            vector[-SYMBOLS:] = 0
        self.vector, self._slope, self._size = vector.astype(np.float32), *np.zeros((2, sum(sizes)), np.float32)
        parts = lambda v: (p.reshape(s) for p, s in zip(np.split(v, np.cumsum(sizes)[:-1]), self.SHAPES.values()))
        self.embed, self.hidden, self.out, self.bias = parts(self.vector)
        self._slopes = [*parts(self._slope)]
        # What a call needs for its windows: embeddings, hidden values with a one, logits.
        self._rows = np.ones((0, HIDDEN + 1), np.float32)

    def unscaled(self, cells: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hidden values, exponentials by (symbol, n), their sums, log-probabilities of ``target``.

        The first two are in memory that the next call uses again.
        """
        n = len(target)
        if n > len(self._rows):
            self._rows = np.ones((n, HIDDEN + 1), np.float32)
            self._taken = np.empty(2 * SIDE * n * HIDDEN, np.float32)
            self._logits = np.empty(SYMBOLS * n, np.float32)
        taken = self._taken[: 2 * SIDE * n * HIDDEN].reshape(2 * SIDE, n, HIDDEN)
        np.take(self.embed.reshape(-1, HIDDEN), cells, axis=0, out=taken, mode="clip")
        h = taken[0]
        for k in range(1, 2 * SIDE):
            h += taken[k]
        h += self.hidden
        np.maximum(h, 0, out=h)
        self._rows[:n, :HIDDEN] = h
        # ``bias`` follows ``out`` in the vector; the ones at the end of a row add it.
        last = self.vector[-(HIDDEN + 1) * SYMBOLS :].reshape(HIDDEN + 1, SYMBOLS)
        logits = np.matmul(last.T, self._rows[:n].T, out=self._logits[: SYMBOLS * n].reshape(SYMBOLS, n))
        logits -= logits.max(axis=0)
        found = logits[target, np.arange(n)]
        np.exp(logits, out=logits)
        sums = logits.sum(axis=0)
        return h, logits, sums, found - np.log(sums)

    def forward(self, around: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hidden values and log-probabilities of all symbols for (n, 2 SIDE) neighbours."""
        h = self.hidden + sum(self.embed[k][around[:, k]] for k in range(2 * SIDE))
        h = np.maximum(h, 0)
        logits = h @ self.out + self.bias
        logits -= logits.max(axis=1, keepdims=True)
        logits -= np.log(np.exp(logits).sum(axis=1, keepdims=True))
        return h, logits

    def train(self, around: np.ndarray, target: np.ndarray, past: np.ndarray, rate: float = RATE) -> float:
        """One AdaGrad step on the mean log-loss; ``past`` holds squared gradients."""
        n, cells = len(target), cells_of(around)
        h, error, sums, logs = self.unscaled(cells, target)
        loss = -float(logs.mean())
        error *= np.float32(1 / n) / sums
        error[target, np.arange(n)] -= np.float32(1 / n)
        back = np.multiply((self.out @ error).T, h > 0, order="C")
        # Sums of ``back`` by place and symbol: equal ones are made neighbours.
        cells = cells.astype(np.uint16).ravel()
        order = np.argsort(cells, kind="stable")
        cells = cells[order]
        starts = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
        embed, hidden, out, bias = self._slopes
        embed[:] = 0
        embed.reshape(-1, HIDDEN)[cells[starts]] = np.add.reduceat(back.take(order % n, axis=0), starts, axis=0)
        back.sum(axis=0, out=hidden)
        out[:] = (error @ h).T
        error.sum(axis=1, out=bias)
        past += np.multiply(self._slope, self._slope, out=self._size)
        np.sqrt(past, out=self._size)
        self._size += 1e-4
        self._slope *= rate
        self._slope /= self._size
        self.vector -= self._slope
        return loss

    def log_probs(self, texts: list[bytes]) -> list[float]:
        """Per text, the sum over all positions of log P(symbol | its neighbours).

        Texts share a pass, with edges between them; a text's sum does not depend on the others.
        """
        sizes = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(sizes)
        symbols = np.frombuffer(bytes(SIDE).join(texts), np.uint8)
        padded, logs = padded_of(symbols), np.empty(sizes.sum(), np.float32)
        for start in range(0, len(logs), _CHUNK):
            at = np.arange(start, min(start + _CHUNK, len(logs)))
            at += SIDE * np.searchsorted(ends, at, side="right")
            logs[start : start + len(at)] = self.unscaled(cells_of(windows_at(padded, at)), symbols[at])[-1]
        found = []
        for end, size in zip(ends.tolist(), sizes.tolist()):
            parts = (logs[k : min(k + _CHUNK, end)] for k in range(end - size, end, _CHUNK))
            found.append(sum((float(p.sum(dtype=np.float64)) for p in parts), 0.0))
        return found

    def log_prob(self, symbols: np.ndarray) -> float:
        """Sum over all positions of log P(symbol | its neighbours)."""
        return self.log_probs([symbols.astype(np.uint8).tobytes()])[0]


def padded_of(symbols: np.ndarray) -> np.ndarray:
    edge = np.zeros(SIDE, symbols.dtype)
    return np.concatenate([edge, symbols, edge])


def windows_at(padded: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The neighbours of the positions ``at``: nearest last on the left, first on the right."""
    return padded[at[:, None] + _PLACES]


def cells_of(around: np.ndarray) -> np.ndarray:
    """(2 SIDE, n): the rows of the embeddings, over all places, that the windows add up."""
    return np.add(around.T, _FIRST_ROWS, dtype=np.intp, order="C")


def positions(text: bytes, number: int, rounds: int) -> Iterator[np.ndarray]:
    """The positions of ``text`` that train in round ``number``; all of them over the rounds."""
    first = (zlib.crc32(text) + number) % rounds
    for begin in range(first, len(text), rounds * STEP):
        yield np.arange(begin, min(begin + rounds * STEP, len(text)), rounds)


def _trained(vector: np.ndarray, number: int, rounds: int):
    """A partition's pass: parameters after its windows, and how many there were."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_thread()
        net, past, windows = Network(vector.copy()), np.zeros(len(vector), np.float32), 0
        around: list[np.ndarray] = []
        target: list[np.ndarray] = []
        waiting = 0

        def steps(last: bool) -> None:
            nonlocal around, target, waiting
            if waiting < STEP and not (last and waiting):
                return
            a, t = np.concatenate(around), np.concatenate(target)
            whole = len(t) if last else len(t) // STEP * STEP
            for k in range(0, whole, STEP):
                net.train(a[k : min(k + STEP, whole)], t[k : min(k + STEP, whole)], past)
            around, target, waiting = [a[whole:]], [t[whole:]], len(t) - whole

        for batch in batches:
            for start in range(0, len(batch), 64):
                for text in batch.column(0).slice(start, 64).to_pylist():
                    symbols = np.frombuffer(text, np.uint8)
                    padded = padded_of(symbols)
                    for at in positions(text, number, rounds):
                        around.append(windows_at(padded, at))
                        target.append(symbols[at])
                        windows += len(at)
                        waiting += len(at)
                        if waiting >= 16 * STEP:
                            steps(last=False)
        steps(last=True)
        if windows:
            yield _averaged_batch(TaskContext.get().partitionId(), windows, net.vector)

    return run


_PARAMETERS = "part long, windows long, vector binary"


def _averaged_batch(part: int, windows: int, vector: np.ndarray) -> pa.RecordBatch:
    row = {"part": part, "windows": windows, "vector": vector.astype(np.float32).tobytes()}
    return pa.RecordBatch.from_pylist([row], pa.schema([("part", pa.int64()), ("windows", pa.int64()), ("vector", pa.binary())]))


def _average(group: pa.Table) -> pa.Table:
    """One row for a group of at most FAN_IN: the mean by windows, in order of part."""
    rows = sorted(group.to_pylist(), key=lambda r: r["part"])
    windows = sum(r["windows"] for r in rows)
    vector = sum(np.frombuffer(r["vector"], np.float32).astype(np.float64) * (r["windows"] / windows) for r in rows)
    return pa.Table.from_batches([_averaged_batch(rows[0]["part"] // FAN_IN, windows, vector)])


def fit(symbols: DataFrame, rounds: int = ROUNDS) -> Network:
    """The network after all windows of ``symbols``, in ``rounds`` parts; without words, untrained."""
    net = Network()
    for number in range(rounds):
        parts = symbols.select("symbols").mapInArrow(_trained(net.vector, number, rounds), _PARAMETERS)
        while True:
            parts = stage(parts.groupBy((F.col("part") / FAN_IN).cast("long").alias("g")).applyInArrow(_average, _PARAMETERS), "lm-round")
            left = parts.count()
            if left <= 1:
                break
        for row in parts.collect():
            net = Network(np.frombuffer(row.vector, np.float32).copy())
    return net


def score(symbols: DataFrame, net: Network, shares: Shares | None = None) -> DataFrame:
    """(doc_id, n_words, log_prob, mean_log_prob); a text without words scores 0, mean null.

    Without ``shares`` the words in ``tail`` count by their group only.
    """
    shared = symbols.sparkSession.sparkContext.broadcast(net.vector)

    @F.arrow_udf("double")
    def of(texts: pa.Array) -> pa.Array:
        one_thread()
        model, out = Network(shared.value), []
        for run in byte_slices(texts, _TOGETHER):
            out += model.log_probs(run)
        return pa.array(out, pa.float64())

    log_prob = of(F.col("symbols")) + F.col("within")
    rows = symbols.select("row", "doc_id", F.octet_length("symbols").cast("long").alias("n_words"), log_prob.alias("log_prob"))
    if shares and shares.rest is not None:
        rows = rows.join(shares.of_rest(symbols), "row", "left")
        rows = rows.withColumn("log_prob", F.col("log_prob") + F.coalesce(F.col("rest") / _FINE, F.lit(0.0))).drop("rest")
    mean = F.when(F.col("n_words") > 0, F.col("log_prob") / F.col("n_words"))
    return rows.drop("row").withColumn("mean_log_prob", mean)


def lm_scores(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``log_prob`` and ``mean_log_prob``.

    Words are runs of letters and digits, A-Z in lower case. Null and empty texts have
    no words. Ids may be null or repeat; each row gives a row. Only ``doc_id`` and
    ``text`` are read. An empty table gives no rows.
    """
    counted = stage(word_counts(docs), "lm-words")
    known = frequent(counted)
    shares = Shares(counted, known)
    symbols = stage(encoded(docs, [w for w, _ in known], shares.logs), "lm-symbols")
    return score(symbols, fit(symbols, rounds), shares)
