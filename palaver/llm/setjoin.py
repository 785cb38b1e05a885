"""Similarity self-join of shingle sets, size-aware: subsets for small sets, inverted lists for large ones.

Two documents link when the Jaccard similarity of their shingle sets reaches `share` percent.  For sets
of n and m shingles that is an overlap of at least c(n, m) = ceil(share * (n + m) / (100 + share)).

Light part: a set of at most `boundary` shingles lists, for each size m that a partner may have, all its
subsets of c(n, m) shingles under keys of 128 bits.  Sets that share one are linked; no check is needed.  The
boundary is where the cost of both parts together is least, by the number of sets of each size and the measured
length of the lists (see `boundary_of`).

Heavy part: the other sets (and the small ones that a large one may link with) are entered in inverted
lists of their prefix: the n - ceil(share * n / 100) + 1 first shingles in an order in which frequent ones
come last.  A short list pairs all its members, a long one each with one pivot first; linked ones form components.
A list of a frequent shingle is split into parts of about `split` members with a pivot each, and the pivots are
paired with the first of them, so no list is one task's however long it is.  Then only pairs of one list that still
lie in different components are compared: a list is cut into blocks by size of set, and two blocks whose sizes
allow links meet in a task, which passes on the pairs whose places and sketches leave room for the overlap.  This
loses no component, as a pair skipped is either linked already or can't link.  Parity sketches that differ in more
bits than the sets may in shingles rule a pair out (a shingle flips one bit, so the sketches never differ more than
the sets); the rest is checked on the whole sets.  Sketches grow with their sets, in powers of two: a larger one is
folded to the length of a smaller one.

Sets are 64-bit shingle hashes.  Equal sets are one set from the start, and a task enters only the first of them.
What is broadcast is bounded: the order of at most `frequent` frequent shingles, hot keys (see `attach`), and bit tables
of at most MOST_BITS bits that only save work; beyond their reach a join takes their place.

Null and empty texts have empty sets and link with nothing; texts of fewer than n words are one shingle, texts of any
length are read whole; repeated rows link as equal sets; a null id links with nothing and has a null component; an empty
table has no rows; other columns aren't read by `link` and are kept by `keep_one`.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from palaver.llm.common import Scratch, Shared, attach, cut, partitions, ranked
from palaver.llm.components import components
from palaver.llm.kernel import NON_SPACE, Words, distinct, mix, shingles, slices, string_bytes

#: SKETCH: the fewest 64-bit words of a sketch.
FREQUENT, SKETCH = 1 << 18, 8
#: Lists of at most so many members have all their pairs compared at once.
SHORT = 12
#: Members of a part of a long list, and of a block.
SPLIT, BLOCK = 1 << 15, 1 << 12
#: Bit tables have 16 bits an id, at least and at most so many.
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 28
#: One in so many shingles is counted whatever its frequency, to measure the lists.
SAMPLED = 1 << 12


def overlap(n: int, m: int, share: int) -> int:
    return -(-share * (n + m) // (100 + share))


def partners(n: int, share: int) -> range:
    """The sizes of sets that may link with one of n shingles."""
    return range(-(-share * n // 100), 100 * n // share + 1)


def subsets_of(n: int, share: int, boundary: int = 1 << 30) -> int:
    """How many subsets a set of n shingles lists for partners of at most `boundary` shingles."""
    return sum(math.comb(n, min(n, overlap(n, m, share))) for m in partners(n, share) if overlap(n, m, share) <= n and m <= boundary)


def prefix_of(n: int, share: int) -> int:
    return n - -(-share * n // 100) + 1


def boundary_of(sizes: dict[int, int], share: int, met: float, check: float = 4.0, most: int = 64) -> int:
    """The boundary at which both parts cost least; `sizes` has the number of sets of each size up to `most` by share.

    A subset costs 1.  An entry of a list costs 1 and, for each of the `met` sets that it meets there on average, a
    `check`.  Sizes that no set has cost nothing.
    """

    def cost(b: int) -> float:
        light = sum(k * subsets_of(n, share, b) for n, k in sizes.items() if n <= b)
        heavy = sum(k * prefix_of(n, share) * (1 + met * check) for n, k in sizes.items() if n >= -(-share * (b + 1) // 100))
        return light + heavy

    return min(range(most), key=lambda b: (cost(b), b)) if sizes else 0


def sketch_of(s: np.ndarray) -> np.ndarray:
    """Bit k: whether the set has an odd number of hashes that are k modulo the number of bits, at least half the set's size."""
    bits = 64 * SKETCH
    while 2 * bits < len(s):
        bits *= 2
    odd = np.bincount((s % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


class Sets:
    """Shingle sets of a batch: sorted distinct hashes of every text."""

    def __init__(self, column, n: int):
        hashes, first = shingles(Words(*string_bytes(column), NON_SPACE), n)
        self.each = distinct(hashes, first)


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _profile(docs: DataFrame, n: int) -> DataFrame:
    """`id`, `n`, a 128-bit hash of the set in two halves, and the set's parity sketch."""

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                sets = Sets(batch.column("text"), n).each
                one, two = np.array([_set_keys(s) for s in sets], np.uint64).reshape(-1, 2).T.copy()
                lists = pa.array([sketch_of(s) for s in sets], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(_signed(one)), pa.array(_signed(two)), lists], names=["id", "n", "k1", "k2", "sketch"])

    return docs.mapInArrow(run, "id bigint, n bigint, k1 bigint, k2 bigint, sketch array<bigint>")


def frequent_shingles(docs: DataFrame, n: int, least: int = 3, most: int = FREQUENT) -> tuple[np.ndarray, np.ndarray, float]:
    """Hashes of frequent shingles, least frequent first (at most `most`), their counts, and how many sets an entry meets.

    Each task counts all its rows and passes on shingles that it saw `least` times or more, and all of the sampled
    ones, from which the last number comes.  The result orders prefixes and places the boundary: any gives the same links.
    """

    def run(batches):
        held, total, known = [], 0, (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        for whole in batches:
            for batch in slices(whole, "text"):
                sets = Sets(batch.column("text"), n).each
                held += sets
                total += sum(map(len, sets))
                if total > 1_000_000:
                    known, held, total = _merge(known, held, 2), [], 0
        values, counts = _merge(known, held, least)
        for a in range(0, len(values), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(_signed(values[a : a + (1 << 16)])), pa.array(counts[a : a + (1 << 16)])], names=["shingle", "count"])

    counted = docs.select("text").mapInArrow(run, "shingle bigint, count bigint").groupBy("shingle").agg(F.sum("count").alias("count"))
    sampled = F.pmod("shingle", F.lit(SAMPLED)) == 0
    met, seen = Observation(), F.when(sampled, F.col("count"))
    counted = counted.observe(met, F.sum(seen).alias("entries"), F.sum(seen * F.least(F.col("count") - 1, F.lit(SHORT))).alias("met"))
    rows = counted.where(F.col("count") >= least).orderBy(F.desc("count"), "shingle").limit(most).collect()[::-1]
    found = met.get
    return np.array([r[0] for r in rows], np.int64).view(np.uint64), np.array([r[1] for r in rows], np.int64), (found["met"] or 0) / (found["entries"] or 1)


def _merge(known, sets, least: int):
    """Adds the sets to the counts and keeps shingles counted `least` times at least, and sampled ones."""
    values, counts = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    both = np.concatenate([known[0], values])
    order = np.argsort(both, kind="stable")
    both, number = both[order], np.concatenate([known[1], counts])[order]
    first = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1]))) if len(both) else np.zeros(0, np.int64)
    total = np.add.reduceat(number, first) if len(first) else number
    keep = (total >= least) | (both[first] % np.uint64(SAMPLED) == 0)
    return both[first][keep], total[keep]


class Order:
    """Places of shingles: rare ones by hash, then frequent ones by count."""

    def __init__(self, frequent: np.ndarray, counts: np.ndarray | None = None):
        order = np.argsort(frequent, kind="stable")
        self.values, self.rank = frequent[order], order + 1
        self.counts = np.zeros(len(frequent), np.int64) if counts is None else counts[order]

    def _at(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.values, values), len(self.values) - 1)
        return at, self.values[at] == values

    def prefix(self, values: np.ndarray, size: int) -> np.ndarray:
        if len(self.values):
            at, known = self._at(values)
            return values[np.lexsort((values, np.where(known, self.rank[at], 0)))[:size]]
        return values[:size]

    def parts(self, values: np.ndarray, split: int) -> np.ndarray:
        """Into how many parts the lists of these shingles are split."""
        if not len(self.values):
            return np.ones(len(values), np.int64)
        at, known = self._at(values)
        return np.where(known, self.counts[at] // split + 1, 1)


ENTRY = "token bigint, check bigint, id bigint, n int, place int, kind tinyint, part int, rank int"


def _entries(docs: DataFrame, n: int, share: int, boundary: int, order, split: int) -> DataFrame:
    """Rows of the subsets (`kind` 0: token, check, side) and of the inverted lists (`kind` 1, those of split ones 2: token, place, part).

    Of equal sets in a task, only the first is entered.
    """
    lowest = max(-(-share * (boundary + 1) // 100), 1)

    def run(batches):
        known = set()
        for whole in batches:
            for batch in slices(whole, "text"):
                out = [[] for _ in range(8)]
                for key, s in zip(batch.column("id").to_numpy(), Sets(batch.column("text"), n).each, strict=True):
                    digest = _set_keys(s)
                    if not len(s) or digest in known:
                        continue
                    known.add(digest)
                    if len(s) <= boundary:
                        keys, checks, sides = subset_keys(s, share, boundary)
                        rows = (keys, checks, key, len(s), sides, 0, 0, sides)
                        _extend(out, rows, len(keys))
                    if len(s) >= lowest:
                        first = order.value.prefix(s, prefix_of(len(s), share))
                        size, parts = len(first), order.value.parts(first, split)
                        # in thirds of the prefix, so that the lists of a group mostly agree on the smallest id
                        rank = 3 * np.arange(size) // size
                        rows = (first, 0, key, len(s), np.arange(size), np.where(parts > 1, 2, 1), (digest[0] >> 7) % parts, rank)
                        _extend(out, rows, size)
                if out[0]:
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int8(), pa.int32(), pa.int32())
                    arrays = [np.concatenate(x) for x in out]
                    yield pa.RecordBatch.from_arrays([pa.array(_signed(x) if k < 2 else x.astype(np.int64)).cast(kind) for k, (x, kind) in enumerate(zip(arrays, kinds, strict=True))], names=[c.split()[0] for c in ENTRY.split(", ")])

    return docs.mapInArrow(run, ENTRY)


def _extend(out: list[list], rows: tuple, size: int) -> None:
    for k, (column, value) in enumerate(zip(out, rows, strict=True)):
        column.append(np.broadcast_to(np.asarray(value, np.uint64 if k < 2 else np.int64), (size,)))


def _set_keys(s: np.ndarray) -> tuple[int, int]:
    """A 128-bit hash of a set, in two halves."""
    return int(s.sum(dtype=np.uint64)), int(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))


def subset_keys(s: np.ndarray, share: int, boundary: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """128-bit hashes, in two halves, of the subsets of a small set, one list for each partner size; side 0 if the set is the smaller one or equal."""
    keys, checks, sides, size = [], [], [], len(s)
    twin = mix(s ^ np.uint64(0x5851F42D4C957F2D))
    for m in partners(size, share):
        c = overlap(size, m, share)
        if not 0 < c <= min(size, m) or m > boundary:
            continue
        salt = np.uint64(min(size, m) * 1_000_003 + max(size, m))
        # by what they leave out
        left = np.array(list(itertools.combinations(range(size), size - c)), np.int64).reshape(math.comb(size, c), size - c)
        for out, values in ((keys, s), (checks, twin)):
            sums = np.full(len(left), values.sum(dtype=np.uint64)) - values[left].sum(axis=1, dtype=np.uint64)
            out.append(mix(mix(sums) + salt))
        sides.append(np.full(len(left), int(size > m), np.int64))
    none = np.zeros(0, np.uint64)
    return (np.concatenate(keys), np.concatenate(checks), np.concatenate(sides)) if keys else (none, none, np.zeros(0, np.int64))


def _bits(ids: DataFrame, most: int = MOST_BITS) -> np.ndarray | None:
    """A table in which every id's bit is set, of 16 bits an id or a little more; None if that takes more than `most` bits."""
    bits = LEAST_BITS
    while bits < 16 * ids.count():
        bits *= 2
    if bits > most:
        return None
    bit = _bit("id", bits)
    words = ids.groupBy((bit / 64).cast("int").alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (bit % 64).cast("int"))).alias("value"))
    table = np.zeros(bits // 64, np.int64)
    for word, value in words.toLocalIterator():
        table[word] = value
    return table


def _bit(column, bits: int):
    return F.pmod(F.xxhash64(column), F.lit(bits))


def _inside(table: np.ndarray, bit: np.ndarray) -> np.ndarray:
    return (table[bit // 64] >> (bit % 64)) & 1 == 1


def _sets_of(docs: DataFrame, ids: DataFrame, n: int, most: int = MOST_BITS) -> DataFrame:
    """`id`, `set` of the documents whose ids are given (and of a few more)."""
    ids = cut(ids)
    found = _bits(ids, most)
    if found is None:
        docs, found = docs.join(ids, "id", "left_semi"), np.full(LEAST_BITS // 64, -1)
    table, bits = Shared(docs.sparkSession, found), 64 * len(found)

    def run(batches):
        for whole in batches:
            wanted = np.flatnonzero(_inside(table.value, whole.column("bit").to_numpy()))
            for batch in slices(whole.take(pa.array(wanted)), "text"):
                for a in range(0, batch.num_rows, 256):
                    part = batch.slice(a, 256)
                    yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([_signed(s) for s in Sets(part.column("text"), n).each], pa.list_(pa.int64()))], names=["id", "set"])

    return docs.withColumn("bit", _bit("id", bits)).mapInArrow(run, "id bigint, set array<bigint>")


def _linked(pairs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """The candidate pairs (`a`, `b`) whose whole sets reach the similarity."""
    withb = pairs.join(sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b")
    both = withb.join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a").select("a", "b", "sa", "sb")

    def run(batches):
        for batch in batches:
            left, right = batch.column("sa"), batch.column("sb")
            keep = []
            for x, y in zip(left, right, strict=True):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= share * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a bigint, b bigint")


PAIRS = "kind tinyint, a bigint, b bigint, token bigint, n int, place int"
#: Kinds of rows that reading the lists gives.
LINKED, NEAR, MEMBER, STAR, PIVOT = range(5)


def _lists(entries: DataFrame, share: int, parts: int) -> DataFrame:
    """Reads the lists and subsets in order of token, as a stream, into rows of five kinds.

    LINKED: a pair (`a`, `b`) of one subset.  NEAR: a pair of a list of at most SHORT members.  MEMBER: member `a` of
    a longer list or of a split one.  STAR: a pair of such a list's first member, whose shingle stands earliest, with
    another one.  PIVOT: the first member of a part of a split list.  Only the members of one short list are held at
    a time, so a list may have any length.
    """
    columns = ("token", "check", "kind", "part", "id", "n", "place")

    def room(n1, p1, n2, p2):
        return np.minimum(n1 - p1, n2 - p2) >= -(-share * (n1 + n2) // (100 + share))

    def out(kind, a, b=None, token=None, n=None, place=None):
        zeros = np.zeros(len(a), np.int64)
        value = [np.full(len(a), kind, np.int8), a, *(zeros if x is None else x for x in (b, token, n, place))]
        kinds = (pa.int8(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(value, kinds, strict=True)], names=["kind", "a", "b", "token", "n", "place"])

    def star(rows, at, first):
        """The rows at these places with their group's first member, whose arrays have one entry a row."""
        token, _, _, _, ident, n, place = (x[at] for x in rows)
        keep = (ident != first[0]) & room(n, place, first[1], first[2])
        yield out(STAR, np.maximum(ident, first[0])[keep], np.minimum(ident, first[0])[keep])
        yield out(MEMBER, ident, None, token, n, place)

    def subset(rows, at, first):
        ident, keep = rows[4][at], (rows[4][at] != first[0]) & (first[2] == 0)
        yield out(LINKED, np.maximum(ident, first[0])[keep], np.minimum(ident, first[0])[keep])

    def work(rows, starts, sizes, first, goes_on):
        """Whole groups, and pieces of long ones; `first` has each group's first member, `goes_on` says that its beginning came before."""
        token, _, kind, _, ident, n, place = rows
        subsets = kind[starts] == 0
        long = ~subsets & ((sizes > SHORT) | (kind[starts] == 2) | goes_on)
        for wanted, make in ((subsets, subset), (long, star)):
            which = np.repeat(np.flatnonzero(wanted), sizes[wanted])
            if len(which):
                at = starts[which] + np.arange(len(which)) - np.repeat(np.cumsum(sizes[wanted]) - sizes[wanted], sizes[wanted])
                yield from make(rows, at, [x[which] for x in first])
        new = starts[(kind[starts] == 2) & ~goes_on]
        yield out(PIVOT, ident[new], None, token[new], n[new], place[new])
        for m in range(2, SHORT + 1):
            base = starts[~subsets & ~long & (sizes == m)]
            if len(base):
                i, j = np.triu_indices(m, 1)
                x, y = (base[:, None] + i).reshape(-1), (base[:, None] + j).reshape(-1)
                keep = (ident[x] != ident[y]) & room(n[x], place[x], n[y], place[y])
                a, b = ident[x[keep]], ident[y[keep]]
                yield out(NEAR, np.maximum(a, b), np.minimum(a, b))

    def run(batches):
        held, state = None, None  # rows of a group that may go on; key and first member of one that does
        for batch in _then_none(batches):
            rows = held
            if batch is not None:
                new = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns]
                rows = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
            if rows is None or not len(rows[0]):
                continue
            key = rows[:4]
            starts = np.flatnonzero(np.concatenate(([True], np.any([x[1:] != x[:-1] for x in key], axis=0))))
            sizes = np.diff(np.concatenate((starts, [len(rows[0])])))
            first, goes_on = [x[starts] for x in rows[4:]], np.zeros(len(starts), bool)
            if state and state[0] == tuple(x[0] for x in key):
                goes_on[0] = True
                for x, value in zip(first, state[1], strict=True):
                    x[0] = value
            held = state = None
            if batch is not None:
                if sizes[-1] <= SHORT and not goes_on[-1]:
                    held = [x[starts[-1] :] for x in rows]
                    starts, sizes, first, goes_on = starts[:-1], sizes[:-1], [x[:-1] for x in first], goes_on[:-1]
                else:
                    state = (tuple(x[-1] for x in key), tuple(x[-1] for x in first))
            if len(starts):
                yield from work(rows, starts, sizes, first, goes_on)

    dealt = entries.repartition(parts, "token", "check", "kind", "part").sortWithinPartitions("token", "check", "kind", "part", "rank", "id")
    return dealt.select(*columns).mapInArrow(run, PAIRS)


def _then_none(batches):
    yield from batches
    yield None


def _need(share: int, n1, n2):
    """c(n1, n2) as a column."""
    return F.ceil(F.lit(share) * (n1 + n2) / F.lit(100.0 + share) - F.lit(1e-9))


def _heads_of(pairs: DataFrame, alias: DataFrame) -> DataFrame:
    """The pairs with copies replaced by the one that stands for them; the larger id is `a`."""
    for side in ("a", "b"):
        pairs = pairs.join(alias.select(F.col("id").alias(side), F.col("head").alias(f"head_{side}")), side, "left")
    one, two = F.coalesce("head_a", "a"), F.coalesce("head_b", "b")
    return pairs.select(F.greatest(one, two).alias("a"), F.least(one, two).alias("b")).where("a <> b").distinct()


def _close(pairs: DataFrame, profile: DataFrame, share: int) -> DataFrame:
    """The pairs whose sketches don't differ more than linked sets may, and in how many bits they do."""
    for side in ("a", "b"):
        pairs = pairs.join(profile.select(F.col("id").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}")), side)
    words = F.least(F.size("sketch_a"), F.size("sketch_b"))
    xor = F.zip_with(_folded("sketch_a", words), _folded("sketch_b", words), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    differ = F.aggregate(xor, F.lit(0), lambda total, x: total + x)
    return pairs.withColumn("differ", differ).where(F.col("differ") <= F.col("n_a") + F.col("n_b") - 2 * _need(share, F.col("n_a"), F.col("n_b"))).select("a", "b", "differ")


def _folded(sketch: str, words):
    """A sketch as it would be with only so many words."""
    start = F.array_repeat(F.lit(0).cast("bigint"), words)
    parts = F.sequence(F.lit(0), (F.size(sketch) / words).cast("int") - 1)
    return F.aggregate(parts, start, lambda total, k: F.zip_with(total, F.slice(sketch, k * words + 1, words), lambda x, y: x.bitwiseXOR(y)))


def _across(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """The pairs that lie in different components."""
    for side in ("a", "b"):
        pairs = pairs.join(known.select(F.col("node").alias(side), F.col("component").alias(f"component_{side}")), side, "left")
    return pairs.where(F.coalesce("component_a", "a") != F.coalesce("component_b", "b")).select("a", "b")


def _met(rows: DataFrame, share: int, block: int) -> DataFrame:
    """Pairs (`a`, `b`) of one list (`token`, `id`, `n`, `place`, `component`, `sketch`) in different components that may still link.

    Lists are cut into blocks in order of the sets' sizes.  Two blocks meet if sizes allow a link, in one group of at most two blocks.
    """
    laid = cut(ranked(rows, ["token"], ["n", "id"], "_rank", few=False).withColumn("_block", F.expr(f"_rank div {block}")))
    blocks = laid.groupBy("token", "_block").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    other = blocks.select("token", F.col("_block").alias("_second"), "low")
    meet = blocks.drop("low").join(other, "token").where((F.col("_block") <= F.col("_second")) & (100 * F.col("high") >= share * F.col("low")))
    meet = cut(meet.select("token", F.col("_block").alias("_first"), "_second"))
    one = laid.join(meet.withColumn("_block", F.col("_first")), ["token", "_block"])
    two = laid.join(meet.where("_first < _second").withColumn("_block", F.col("_second")), ["token", "_block"])

    def run(table: pa.Table) -> pa.Table:
        ident, n, place, component, side = (table.column(c).to_numpy() for c in ("id", "n", "place", "component", "_block"))
        mixed = len(np.unique(side)) > 1
        words = [np.asarray(x, np.int64).view(np.uint64) for x in table.column("sketch").to_pylist()]
        sizes = np.array([len(w) for w in words])
        a, b = [], []
        for length in np.unique(sizes):  # rows whose sketch is at least as long, folded to this length
            whole = np.flatnonzero(sizes >= length)
            folded = np.stack([np.bitwise_xor.reduce(words[k].reshape(-1, length), axis=0) for k in whole])
            own = np.flatnonzero(sizes[whole] == length)
            for k in own:
                x = whole[k]
                need = -(-share * (n[x] + n[whole]) // (100 + share))
                keep = (component[whole] != component[x]) & (np.minimum(n[x] - place[x], n[whole] - place[whole]) >= need)
                # equal lengths meet twice, and of two blocks only rows of different ones
                keep &= (sizes[whole] > length) | (np.arange(len(whole)) > k)
                if mixed:
                    keep &= side[whole] != side[x]
                at = np.flatnonzero(keep)
                differ = np.bitwise_count(folded[at] ^ folded[k]).sum(axis=1, dtype=np.int64)
                at = whole[at[differ <= (n[x] + n[whole] - 2 * need)[at]]]
                a.append(np.maximum(ident[at], ident[x])), b.append(np.minimum(ident[at], ident[x]))
        pairs = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in (a, b)]
        return pa.table({"a": pa.array(pairs[0], pa.int64()), "b": pa.array(pairs[1], pa.int64())})

    return one.union(two.select(*one.columns)).groupBy("token", "_first", "_second").applyInArrow(run, "a bigint, b bigint").distinct()


def link(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n: int = 4, share: int = 85, frequent: int = FREQUENT, boundary: int | None = None, split: int = SPLIT, block: int = BLOCK, most_bits: int = MOST_BITS) -> DataFrame:
    """One row a document: the id, `n_shingles` and `component_id`, the smallest id that links reach.

    Rows that share an id are one document in several texts: what links to one of them links to all.
    """
    options = {"n": n, "share": share, "frequent": frequent, "boundary": boundary, "split": split, "block": block, "most_bits": most_bits}
    docs = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    repeated = docs.where("id is not null").groupBy("id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    if repeated.isEmpty():
        return _linked_rows(docs, **options).select(F.col("id").alias(id_col), "n_shingles", "component_id")
    # by places in the order of id, so that the smallest place has the smallest id
    placed = cut(ranked(docs.where("id is not null"), [], ["id"], "_place"))
    rows = placed.select("_place", "id").join(_linked_rows(placed.select(F.col("_place").alias("id"), "text"), **options).withColumnRenamed("id", "_place"), "_place")
    rows = cut(rows)
    first = rows.groupBy("id").agg(F.min("component_id").alias("b"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    same = attach(rows, first, "id", ["b"], rows.count(), F.col("_place")).where("b is not null")
    joined = components(same.select(F.col("component_id").alias("a"), "b"))
    ids = placed.select(F.col("_place").alias("component"), F.col("id").alias("component_id"))
    rows = rows.withColumnRenamed("component_id", "node").join(joined, "node", "left")
    rows = rows.select("id", "n_shingles", F.coalesce("component", "node").alias("component")).join(ids, "component")
    rest = docs.where("id is null")
    found = rows.select("id", "n_shingles", "component_id").union(_linked_rows(rest, **options))
    return found.withColumnRenamed("id", id_col)


def _linked_rows(docs: DataFrame, *, n: int, share: int, frequent: int, boundary: int | None, split: int, block: int, most_bits: int) -> DataFrame:
    """The same for rows (id, text) whose ids differ, or are null."""
    scratch, session = Scratch(docs.sparkSession), docs.sparkSession
    profile = scratch.store(_profile(docs, n), "profile")
    common, counts, met = frequent_shingles(docs, n, most=frequent)
    if boundary is None:
        boundary = boundary_of({r[0]: r[1] for r in profile.where("n between 1 and 80").groupBy("n").count().collect()}, share, met)
    # equal sets: the one of the smallest id stands for all
    keyed = profile.where("n > 0 and id is not null").select("id", F.concat_ws("/", "k1", "k2").alias("key"))
    heads = keyed.groupBy("key").agg(F.min("id").alias("head"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    alias = cut(attach(keyed, heads, "key", ["head"], profile.count(), F.col("id")).where("id <> head").select("id", "head").distinct())
    sketches = profile.select("id", "n", "sketch").join(alias, "id", "left_anti").dropDuplicates(["id"])
    order = Shared(session, Order(common, counts))
    joined = scratch.store(_lists(_entries(docs.where("id is not null"), n, share, boundary, order, split), share, partitions(session)), "lists")
    pairs = lambda kind: joined.where(F.col("kind") == kind).select("a", "b")
    pivots = joined.where(F.col("kind") == PIVOT).select("token", F.col("a").alias("b"))
    pivots = pivots.join(pivots.groupBy("token").agg(F.min("b").alias("a")), "token").where("a <> b").select("a", "b")
    light = pairs(LINKED).distinct()
    star = cut(_close(_heads_of(pairs(NEAR).union(pairs(STAR)).union(pivots).distinct(), alias), sketches, share))
    # each document with the nearest of its pivots first
    first = star.groupBy("a").agg(F.min(F.struct("differ", "b")).alias("m")).select("a", "m.b")
    edges = cut(_linked(first, scratch.store(_sets_of(docs, _ids(first), n, most_bits), "star"), share).union(_heads_of(light, alias)))
    known = components(edges)
    # in the long lists, pairs of different components are left; copies stand as their heads
    rows = joined.where(F.col("kind") == MEMBER).select("token", F.col("a").alias("id"), "n", "place").join(alias, "id", "left")
    rows = rows.select("token", F.coalesce("head", "id").alias("id"), "n", "place").distinct()
    rows = rows.join(known.select(F.col("node").alias("id"), "component"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    rows = scratch.store(rows, "members")
    mixed = rows.groupBy("token").agg(F.min("component").alias("_low"), F.max("component").alias("_high"), F.count(F.lit(1)).alias("_n")).where("_low < _high")
    rows = attach(rows, mixed, "token", ["_low"], rows.count(), F.col("id")).where("_low is not null").drop("_low")
    rows = scratch.store(rows.join(sketches.select("id", "sketch"), "id"), "rest")
    more = _across(star, known)
    if not rows.isEmpty():
        more = more.union(_met(rows, share, block))
    pairs = cut(more.distinct().join(first, ["a", "b"], "left_anti"))
    if not pairs.isEmpty():
        more = cut(_linked(pairs, scratch.store(_sets_of(docs, _ids(pairs), n, most_bits), "pairs"), share))
        if not more.isEmpty():
            known = components(edges.union(more))
    sizes = cut(profile.select("id", "n"))
    scratch.drop()
    found = sizes.join(alias, "id", "left").withColumn("head", F.coalesce("head", "id")).join(known.select(F.col("node").alias("head"), "component"), "head", "left")
    # a component's smallest set head is its smallest document: heads are the smallest ids of their copies
    return found.select("id", F.col("n").alias("n_shingles"), F.coalesce("component", "head").alias("component_id"))


def _ids(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", most_bits: int = MOST_BITS, **options) -> DataFrame:
    """The documents with one of each group of linked ones, that of the smallest id; unlinked ones stay.

    Rows that share an id stay or go together; a null id has no group and stays.  Documents whose bit isn't in the table
    of the dropped ids stay where they are; only the others are joined with those ids.
    """
    found = cut(link(docs, id_col=id_col, text_col=text_col, most_bits=most_bits, **options))
    dropped = cut(found.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("id")).distinct())
    gone = dropped.select(F.col("id").alias("_dropped"))
    bits_table = _bits(dropped, most_bits)
    if bits_table is None:
        return docs.join(gone, F.col(id_col) == F.col("_dropped"), "left_anti")
    table, bits = Shared(docs.sparkSession, bits_table), 64 * len(bits_table)
    marked = docs.withColumn("_bit", _bit(F.col(id_col).cast("bigint"), bits))

    def part(inside: bool):
        def run(batches):
            for batch in batches:
                yield batch.filter(pa.array(_inside(table.value, batch.column("_bit").to_numpy()) == inside, pa.bool_()))

        return marked.mapInArrow(run, marked.schema).drop("_bit")

    rest = part(True).join(gone, F.col(id_col) == F.col("_dropped"), "left_anti")
    return part(False).unionByName(rest).select(*docs.columns)
