"""MinHash near-dedup by an inverted join on signature coordinates.

Equal shingle sets are one row, the others get a MinHash signature. Every coordinate and
its value is a posting list. Two sets at the wanted similarity agree on at least
``matches`` of the coordinates, but for a chance below ``MISS``. A set whose coordinates
meet too few others in any list is skipped at once; of the rest each posts only its
prefix, its rarest lists: ``coordinates - matches + 1`` of them, in which lists of one
member count, so two sets with enough matches share a list of both prefixes. Sets that
meet have their collisions counted over whole signatures; those above the threshold are
confirmed on full sets, and confirmed links are merged into components. Before that a
parity sketch turns away pairs that surely differ too much: each element that only one
of the sets has flips one bit, so two sketches never differ in more bits than the sets
in elements.

Lists are taken in rounds, so that a group of copies is never expanded into its pairs.
First every member meets the list's leader. What that merged is skipped from then on:
only members of different components still meet, in cells of bounded size, each with a
bounded number of partners a round, until no pair is left. A round takes only the lists
in which the one before left candidates.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.llm.common import byte_chunks, byte_slices
from sightline.llm.components import components
from sightline.session import stage

#: Coordinates of a signature, and the chance that a link has too few matches.
COORDINATES, MISS = 64, 1e-9
#: Members of a list in one half of a cell; partners a member gets in the first turn, and
#: at most in a later one (sixteen times as many as in the turn before).
HALF, PARTNERS, MOST_PARTNERS = 2048, 64, 1024
_SEED = 42
#: Bytes of text split into words at a time, shingles in one block of signature work.
_PIECE, _BLOCK = 1 << 20, 512
_BREAKS = b" \t\n\x0b\x0c\r"
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SIGNED = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("k1", T.LongType()),
        T.StructField("k2", T.LongType()),
        T.StructField("sig", T.ArrayType(T.IntegerType())),
        T.StructField("odd", T.ArrayType(T.LongType())),
    ]
)


def least_matches(coordinates: int, percent: int, miss: float = MISS) -> int:
    """The most matches that a pair at ``percent`` similarity reaches but for ``miss``."""
    p, below = percent / 100, 0.0
    for t in range(coordinates + 1):
        below += comb(coordinates, t) * p**t * (1 - p) ** (coordinates - t)
        if below > miss:
            return max(t, 1)
    return coordinates


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _numbers(count: int, start: int) -> np.ndarray:
    return _mix(np.arange(start, start + count, dtype=np.uint64) * _STEP)


#: A number per byte, none for white space; a word's hash is a polynomial in them.
_LETTER = _numbers(256, _SEED << 8)
_LETTER[[9, 10, 11, 12, 13, 32]] = 0
_BASE = int(_numbers(1, _SEED)[0]) | 1
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(length: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, at least ``length`` of them."""
    if len(_POWERS[0]) < length:
        for k, factor in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(2 * length, factor, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS


def word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash and starting byte of every word, A-Z in lower case."""
    letters = np.frombuffer(text.lower(), np.uint8)
    value = _LETTER[letters]
    inside = np.zeros(len(letters) + 2, np.int8)
    inside[1:-1] = value != 0
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    powers, inverse = _powers(len(letters))
    total = np.zeros(len(letters) + 1, np.uint64)
    np.cumsum(value * powers[: len(letters)], out=total[1:])
    # The sum over a word, moved to its start; equal words have equal values.
    moved = (total[ends] - total[starts]) * inverse[starts]
    return _mix(moved + (ends - starts).astype(np.uint64) * _STEP), starts


def _runs(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words."""
    out = np.full(max(len(words) - size + 1, 0) if size else 0, size, np.uint64)
    for k in range(size):
        out = _mix(out * _STEP + words[k : k + len(out)])
    return out


def _distinct(runs: np.ndarray) -> np.ndarray:
    runs = np.sort(runs)
    first = np.ones(len(runs), bool)
    first[1:] = runs[1:] != runs[:-1]
    return runs[first]


def shingle_sets(texts: list[bytes], size: int) -> Iterator[np.ndarray]:
    """Sorted 64-bit hashes of the distinct shingles of each whole text.

    Short texts are hashed together, a long one piece by piece.
    """
    if len(texts) == 1:
        parts = [word_hashes(piece)[0] for piece in byte_chunks(texts[0], _PIECE, _BREAKS)]
        words, cuts = np.concatenate(parts), None
    else:
        words, starts = word_hashes(b" ".join(texts))
        cuts = np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in texts)]))
    runs = _runs(words, size)
    for low, high in [(0, len(words))] if cuts is None else zip(cuts, cuts[1:]):
        few = high - low < size
        yield _distinct(_runs(words[low:high], high - low) if few else runs[low : high - size + 1])


def _rows_of(count: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = _numbers(2 * count, 1)
    return seeds[:count, None] | np.uint64(1), seeds[count:, None]


def signature(members: np.ndarray, count: int = COORDINATES) -> np.ndarray:
    """Least value of each of ``count`` hash functions over the set."""
    factor, shift = _rows_of(count)
    best = np.full(count, np.iinfo(np.uint64).max)
    for start in range(0, len(members), _BLOCK):
        block = factor * members[start : start + _BLOCK]
        block += shift
        np.minimum(best, block.min(axis=1), out=best)
    return (best >> np.uint64(32)).astype(np.uint32).view(np.int32)


def odd_sketch(members: np.ndarray) -> np.ndarray:
    """Parities of the numbers of members that fall on each bit: 2 to 4 bits a member, 512 to 32,768 in all."""
    bits = 1 << min(max((2 * len(members) - 1).bit_length(), 9), 15)
    count = np.bincount((members & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((count & 1).astype(np.uint8), bitorder="little").view(np.int64)


def _folded(sketches: np.ndarray) -> np.ndarray:
    """The sketches of half the size."""
    half = sketches.shape[-1] // 2
    return sketches[..., :half] ^ sketches[..., half:]


class Sketches:
    """Parity sketches of several sizes."""

    def __init__(self, words: np.ndarray, ends: np.ndarray) -> None:
        self.length = np.diff(ends)
        self.place, self.rows = np.zeros(len(self.length), np.int64), {}
        for n in np.unique(self.length):
            of_size = np.flatnonzero(self.length == n)
            self.place[of_size] = np.arange(len(of_size))
            self.rows[int(n)] = words[ends[of_size][:, None] + np.arange(n)]

    def differing(self, x: int, others: np.ndarray) -> np.ndarray:
        """Bits in which the sketches differ from that of ``x``, at the smaller size of the two.

        Sizes further apart than by one half belong to sets too unlike in size: 0.
        """
        out = np.zeros(len(others), np.int64)
        own = int(self.length[x])
        mine = self.rows[own][self.place[x]]
        for n in (own // 2, own, 2 * own):
            at = np.flatnonzero(self.length[others] == n)
            if not len(at):
                continue
            theirs = self.rows[n][self.place[others[at]]]
            a, b = (_folded(mine), theirs) if n < own else (mine, theirs if n == own else _folded(theirs))
            out[at] = np.bitwise_count((a ^ b).view(np.uint64)).sum(axis=1)
        return out


def _may_link(differing, sizes, percent: int):
    """Whether sets of together ``sizes`` elements may differ in so few that they link."""
    return differing * (100 + percent) <= sizes * (100 - percent)


def _sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    for run in byte_slices(texts, _PIECE):
        yield from shingle_sets(run, size)


def _key(members: np.ndarray) -> tuple[int, int]:
    k1, k2 = np.frombuffer(xxhash.xxh3_128_digest(members.tobytes()), np.int64)
    return int(k1), int(k2)


def _signed(text: Column, size: int, count: int) -> Column:
    """Size, key and signature of a text's set; only the size, 0, of an empty one."""

    @F.arrow_udf(_SIGNED)
    def of(texts: pa.Array) -> pa.Array:
        n, keys, signatures, odd = [], [], [], []
        for members in _sets(texts, size):
            n.append(len(members))
            keys.append(_key(members) if len(members) else (None, None))
            signatures.append(signature(members, count) if len(members) else None)
            odd.append(odd_sketch(members) if len(members) else None)
        columns = [pa.array(n, pa.int64()), *(pa.array([k[i] for k in keys], pa.int64()) for i in (0, 1))]
        lists = [pa.array(signatures, pa.list_(pa.int32())), pa.array(odd, pa.list_(pa.int64()))]
        return pa.StructArray.from_arrays([*columns, *lists], names=_SIGNED.names)

    return of(text)


def _marked(value: Column, bits: int) -> Column:
    """The place of a value among ``bits`` bits."""
    return F.pmod(F.xxhash64(value), F.lit(bits)).cast("long")


def _bitmap(values: DataFrame, column: str) -> np.ndarray:
    """One bit for the hash of each value: about 16 bits a value, 16 MB at most.

    Spark builds it in pieces of 4 KB. What it lets through by chance is dropped by the
    join that follows; with more values it lets through more.
    """
    count = values.count()
    bits = 1 << min(max((16 * count).bit_length(), 15), 27)
    at = _marked(F.col(column), bits)
    # Bucket numbers of these functions begin with 1.
    rows = values.groupBy(F.bitmap_bucket_number(at + 1).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at + 1)).alias("piece"))
    out = np.zeros(bits // 8, np.uint8)
    for row in rows.collect():
        start = (row.bucket - 1) * 4096
        out[start : start + 4096] = np.frombuffer(bytes(row.piece), np.uint8)[: len(out) - start]
    return out


def _full(size: int, wanted):
    """Key and hashes of the sets of a partition's texts (text, place) whose place is marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(1).to_numpy()
            found = (wanted.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
            for texts in byte_slices(batch.column(0).filter(pa.array(found)), 4 * _PIECE):
                sets = [s.view(np.int64) for s in _sets(pa.array(texts, pa.binary()), size)]
                keys = [_key(s) if len(s) else (None, None) for s in sets]
                columns = [pa.array([k[i] for k in keys], pa.int64()) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(sets, pa.list_(pa.int64()))], names=["k1", "k2", "members"])

    return run


def posts(sets: DataFrame, matches: int) -> DataFrame:
    """(list, id, mask): the prefixes of all sets that can reach ``matches`` collisions.

    A list's coordinate is its number above 32 bits; the mask has a bit for each
    coordinate of the set's prefix.
    """
    key = F.shiftleft(F.col("pos").cast("long"), 32) + F.col("col").cast("long").bitwiseAND(F.lit((1 << 32) - 1))
    rows = sets.select("id", F.posexplode("sig")).select("id", key.alias("list"))
    shared = rows.groupBy("list").agg(F.count("*").alias("times")).filter("times > 1")
    met = rows.join(shared, "list").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("times", "list"))).alias("lists"))
    rarest = F.slice("lists", F.lit(1), F.size("lists") - F.lit(matches - 1))
    prefix = met.filter(F.size("lists") >= matches).select("id", F.transform(rarest, lambda p: p["list"]).alias("prefix"))
    bit = lambda total, p: total.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(p, 32).cast("int")))
    mask = F.aggregate("prefix", F.lit(0).cast("long"), bit)
    return prefix.select(F.explode("prefix").alias("list"), "id", mask.alias("mask"))


def _likely(matches: int, percent: int) -> Column:
    """Whether pairs (n_a, s_a, o_a, n_b, s_b, o_b) have enough collisions and may link."""

    @F.arrow_udf(T.BooleanType())
    def of(n_a: pa.Array, s_a: pa.Array, o_a: pa.Array, n_b: pa.Array, s_b: pa.Array, o_b: pa.Array) -> pa.Array:
        rows = len(n_a)
        if not rows:
            return pa.array([], pa.bool_())
        sizes = np.stack([n_a.to_numpy(), n_b.to_numpy()])
        signatures = [s.flatten().to_numpy().reshape(rows, -1) for s in (s_a, s_b)]
        good = (signatures[0] == signatures[1]).sum(axis=1) >= matches
        good &= 100 * sizes.min(axis=0) >= percent * sizes.max(axis=0)
        lengths = np.concatenate([o.value_lengths().to_numpy() for o in (o_a, o_b)])
        sketches = Sketches(np.concatenate([o.flatten().to_numpy() for o in (o_a, o_b)]), np.append(0, np.cumsum(lengths)))
        for i in np.flatnonzero(good):
            good[i] = _may_link(sketches.differing(i, np.array([rows + i]))[0], sizes[:, i].sum(), percent)
        return pa.array(good)

    return of(*[F.col(f"{c}_{side}") for side in "ab" for c in "nso"])


def confirmed(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have the similarity."""
    side = lambda name: full.select(F.col("id").alias(name), F.col("members").alias(f"m_{name}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a")
    common = F.size(F.array_intersect("m_a", "m_b"))
    sizes = both.select("a", "b", common.alias("common"), (F.size("m_a") + F.size("m_b")).alias("total"))
    return sizes.filter(100 * F.col("common") >= percent * (F.col("total") - F.col("common"))).select("a", "b")


def _leader_pairs(lists: DataFrame, sets: DataFrame, matches: int, percent: int) -> DataFrame:
    """Pairs of a member and its list's leader with enough collisions."""
    leaders = lists.groupBy("list").agg(F.min("id").alias("a"))
    pairs = lists.select("list", "id").join(leaders, "list").filter("id != a").select("a", F.col("id").alias("b")).distinct()
    side = lambda name: sets.select(
        F.col("id").alias(name), F.col("n").alias(f"n_{name}"), F.col("sig").alias(f"s_{name}"), F.col("odd").alias(f"o_{name}")
    )
    both = pairs.join(side("b"), "b").join(side("a"), "a")
    return both.filter(_likely(matches, percent)).select("a", "b")


def cell_pairs(ids, first, current, sizes, half, masks, signatures, sketches: Sketches, leader, coordinate: int, split: bool, low: int, high: int, matches: int, percent: int):
    """Pairs of one cell to confirm in this turn, and whether later turns have more.

    Members of different components meet, each pair only in the first list that both have
    in their prefix. A turn takes the candidates ``low`` to ``high`` of each member,
    counted by the components before the first turn, so that turns do not overlap.
    """
    kinds, number = np.unique(first, return_inverse=True)
    main = np.bincount(number).argmax()
    others = np.flatnonzero((number != main) & (ids != leader))
    rank = np.full(len(ids), len(ids))
    rank[others] = np.arange(len(others))
    bits = (masks[:, None] >> np.arange(signatures.shape[1]) & 1).astype(bool)
    a, b, more = [], [], False
    for i, x in enumerate(others):
        able = (number != number[x]) & (ids != leader) & ~(rank < i)
        able &= 100 * np.minimum(sizes, sizes[x]) >= percent * np.maximum(sizes, sizes[x])
        if split:
            able &= half != half[x]
        met = np.flatnonzero(able)
        equal = signatures[met] == signatures[x]
        enough = equal.sum(axis=1) >= matches
        met, equal = met[enough], equal[enough]
        met = met[(equal & bits[met] & bits[x]).argmax(axis=1) == coordinate]
        met = met[_may_link(sketches.differing(x, met), sizes[met] + sizes[x], percent)]
        open_ = current[met] != current[x]
        more |= bool(open_[high:].any())
        met = met[low:high][open_[low:high]]
        a.append(np.minimum(ids[met], ids[x]))
        b.append(np.maximum(ids[met], ids[x]))
    return a, b, more


_CELL = "list, low, high, id, first, current, n, half, mask, leader, sig, odd"


def _cells(start: int, end: int, matches: int, percent: int):
    """The pairs of the cells of one partition, sorted by (list, low, high)."""

    def pairs(rows: list[np.ndarray], signatures: np.ndarray, words: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
        lists, low, high, ids, first, current, sizes, half, masks, leader = rows
        new = np.ones(len(ids) + 1, bool)
        new[1:-1] = (lists[1:] != lists[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        at = np.flatnonzero(new)
        a, b, more = [np.empty(0, np.int64)], [np.empty(0, np.int64)], []
        for i, j in zip(at[:-1], at[1:]):
            s = slice(i, j)
            got = cell_pairs(
                ids[s], first[s], current[s], sizes[s], half[s], masks[s], signatures[s], Sketches(words, ends[i : j + 1]), leader[i], lists[i] >> 32, low[i] != high[i], start, end,
                matches, percent,
            )
            a, b = a + got[0], b + got[1]
            more += [int(lists[i])] * got[2]
        found = np.unique(np.stack([np.concatenate(a), np.concatenate(b)]), axis=1)
        # A row without a first member names a list of which a later turn has more.
        columns = [pa.array([*c.tolist(), *rest], pa.int64()) for c, rest in zip(found, ([None] * len(more), more))]
        return pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            last = [c[batch.num_rows - 1].as_py() for c in batch.columns[:3]] if batch.num_rows else None
            if last and [c[0].as_py() for c in held[0].columns[:3]] != last:
                # All but the last cell are complete; that one may go on in the next batch.
                table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                same = np.all([c.to_numpy() == at for c, at in zip(table.columns[:3], last)], axis=0)
                cut = len(same) - int(same.sum())
                yield pairs(*_columns(table.slice(0, cut)))
                held = [table.slice(cut)]
        if sum(b.num_rows for b in held):
            yield pairs(*_columns(pa.Table.from_batches(held).combine_chunks().to_batches()[0]))

    return run


def _columns(batch: pa.RecordBatch) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Plain columns, the matrix of signatures, and the sketches with where each ends."""
    plain = [c.to_numpy(zero_copy_only=False) for c in batch.columns[:-2]]
    signatures = batch.columns[-2].flatten().to_numpy().reshape(batch.num_rows, -1)
    odd = batch.columns[-1]
    return plain, signatures, odd.flatten().to_numpy(), np.append(0, np.cumsum(odd.value_lengths().to_numpy()))


def _still_open(members: DataFrame, component: str) -> DataFrame:
    """Members of the lists that hold different components; a closed list stays closed."""
    kinds = members.groupBy("list").agg(F.min(component).alias("from"), F.max(component).alias("to"))
    return members.join(kinds.filter("`from` != `to`").select("list"), "list", "left_semi")


def _open_members(lists: DataFrame, sets: DataFrame, first: DataFrame, half: int) -> DataFrame:
    """Members of the open lists, with all that a cell needs, written once.

    Lists of two are done: the leader has met the only other member.
    """
    large = lists.groupBy("list").agg(F.count("*").alias("times"), F.min("id").alias("leader")).filter("times > 2")
    large = large.select("list", "leader", F.ceil(F.col("times") / half).cast("int").alias("parts"))
    members = lists.join(large, "list").join(first, "id", "left").withColumn("first", F.coalesce("first", "id"))
    members = _still_open(stage(members, "minhash-members"), "first")
    return stage(members.join(sets.select("id", "n", "sig", "odd"), "id"), "minhash-open")


def _dealt(members: DataFrame) -> DataFrame:
    """Members with ``current`` in the cells of their lists: pairs of halves."""
    rows = members.withColumn("half", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.withColumn("low", F.least("half", "other")).withColumn("high", F.greatest("half", "other"))
    columns = _CELL.split(", ")
    return rows.select(columns).repartition("list", "low", "high").sortWithinPartitions("list", "low", "high", "id")


def linked(sets: DataFrame, full_of, matches: int, percent: int, half: int = HALF, partners: int = PARTNERS) -> DataFrame:
    """(id, root) of every set that links, from ``sets`` (id, n, sig, odd).

    ``full_of`` gets the ids that posted and returns their full sets, (id, members).
    """
    lists = stage(posts(sets, matches), "minhash-posts")
    sets = stage(sets.join(lists.select("id").distinct(), "id", "left_semi"), "minhash-sets")
    full = stage(full_of(sets.select("id")), "minhash-full")
    pairs = stage(_leader_pairs(lists, sets, matches, percent), "minhash-pairs")
    links = stage(confirmed(pairs, full, percent), "minhash-links")
    root = components(links)
    first = root.select(F.col("node").alias("id"), F.col("root").alias("first"))
    members = _open_members(lists, sets, first, half)
    current = members.withColumn("current", F.col("first"))
    low, high, more = 0, partners, True
    while more:
        found = _dealt(current).mapInArrow(_cells(low, high, matches, percent), "a long, b long")
        found = stage(found, "minhash-pairs")
        total, pairs = found.agg(F.count("*"), F.count("a")).first()
        more = total > pairs
        if more:
            going = found.filter("a is null").select(F.col("b").alias("list")).distinct()
            members, current = (rows.join(going, "list", "left_semi") for rows in (members, current))
        fresh = stage(confirmed(found.filter("a is not null").distinct(), full, percent), "minhash-links") if pairs else None
        if fresh is not None and not fresh.isEmpty():
            # The trees so far stand for the links that made them.
            root = components(root.select(F.col("node").alias("a"), F.col("root").alias("b")).union(fresh))
            if more:
                named = root.select(F.col("node").alias("id"), F.col("root").alias("current"))
                current = members.join(named, "id", "left").withColumn("current", F.coalesce("current", "id"))
                current = _still_open(current, "current")
        low, high = high, high + min(16 * (high - low), MOST_PARTNERS)
    return root.select(F.col("node").alias("id"), "root")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    percent: int = 80,
    coordinates: int = COORDINATES,
    half: int = HALF,
    partners: int = PARTNERS,
) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``.

    Two documents link when the sets of their ``shingle``-word runs have ``percent`` of
    their union in common; a text with fewer words is one run. ``component_id`` is the
    smallest id reachable, ``kept`` whether that is the row's own. Null and empty texts
    and texts without words have no runs and link with nothing: their component is their
    own id. Repeated rows each give a row; a row without an id has the component of its
    text, null (and is kept) if nobody there has an id. Only the two columns named are
    read. A link has too few matches to be found with a chance below ``MISS``.
    """
    if not 1 <= coordinates <= 64:
        raise ValueError("a signature has 1 to 64 coordinates")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = stage(texts.select("doc_id", _signed(F.col("text"), shingle, coordinates).alias("s")).select("doc_id", "s.*"), "minhash")
    classes = rows.filter("n > 0").groupBy("k1", "k2", "n", "sig", "odd").agg(F.min("doc_id").alias("low"))
    # Numbers of the sets: fixed once written.
    classes = stage(classes.withColumn("id", F.monotonically_increasing_id()), "minhash-classes")

    def full_of(ids: DataFrame) -> DataFrame:
        wanted = stage(classes.join(ids, "id", "left_semi").select("id", "k1", "k2", F.col("low").alias("low_id")), "minhash-wanted")
        bitmap = _bitmap(wanted, "low_id")
        placed = texts.select("text", _marked(F.col("doc_id"), 8 * len(bitmap)).alias("place"))
        # Texts are not shuffled: those of other ids go before they are hashed.
        shared = docs.sparkSession.sparkContext.broadcast(bitmap)
        made = placed.mapInArrow(_full(shingle, shared), "k1 long, k2 long, members array<long>")
        made = made.join(wanted, ["k1", "k2"])
        return made.select("id", "members").dropDuplicates(["id"])

    root = linked(classes.select("id", "n", "sig", "odd"), full_of, least_matches(coordinates, percent), percent, half, partners)
    member = classes.join(root, "id", "left").select("k1", "k2", "low", F.coalesce("root", "id").alias("root"))
    lows = member.groupBy("root").agg(F.min("low").alias("component"))
    named = stage(member.join(lows, "root").select("k1", "k2", "component"), "minhash-members")
    found = rows.select("doc_id", "n", "k1", "k2").join(named, ["k1", "k2"], "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    out = found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
