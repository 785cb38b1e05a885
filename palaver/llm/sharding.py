"""Minimax contiguous sharding of atomic groups, in DataFrame functions only.

Documents get their place in the order of their ids, from 0 without gaps; a group (equal texts) stands at its
first document's place.  The capacity is the smallest one for which the ordered groups fit into the shards
without cutting a group: a binary search whose check fills shards greedily.  The cuts then lie as near to
equal shares as that capacity allows.

The driver sees sums over ranges of places only.  A range counts as divisible for a lower bound of the
capacity and as indivisible for an upper bound; the ranges in which a cut may lie are split further by one
aggregation a round until both bounds meet, so what is collected never grows with the data.

Ids may be any numbers, hashes included.  Null and empty texts are one group of size 1 a row; null ids sort
first, rows of one id by their texts' hashes; with fewer groups than shards, the last shards stay empty;
repeated rows are rows of one group; a text of any length is one size and one hash; an empty table gives no
rows; other columns aren't read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.llm.common import attach, cut, ranked

#: Ranges of places that one round asks for, at most.
RANGES = 1 << 14


@dataclass(frozen=True)
class Segment:
    """Neighbouring groups: their smallest and largest place, their size together, and the width of the range they fill."""

    low: int
    high: int
    size: int
    width: int = 1

    @property
    def whole(self) -> bool:
        return self.low == self.high


def _fits(segments: list[Segment], shards: int, capacity: int, divisible: bool) -> bool:
    used, free = 1, capacity
    for s in segments:
        rest = s.size
        if divisible and not s.whole:
            if rest > free:
                rest -= free
                more = -(-rest // capacity)
                used, free = used + more, more * capacity - rest
            else:
                free -= rest
        elif rest > capacity:
            return False
        elif rest > free:
            used, free = used + 1, capacity - rest
        else:
            free -= rest
        if used > shards:
            return False
    return True


def capacity(segments: list[Segment], shards: int, divisible: bool = False) -> int:
    """The smallest feasible capacity, by binary search."""
    low, high = 1, max(1, sum(s.size for s in segments))
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if _fits(segments, shards, mid, divisible) else (mid + 1, high)
    return low


def _reach(sizes: list[int], shards: int, most: int) -> list[int]:
    """For each cut, the most segments that fit before it under the capacity."""
    out, at = [], 0
    for _ in range(shards - 1):
        total = 0
        while at < len(sizes) and total + sizes[at] <= most:
            total, at = total + sizes[at], at + 1
        out.append(at)
    return out


def _open(segments: list[Segment], shards: int, low: int, high: int) -> list[Segment]:
    """Divisible segments in which a cut may lie for a capacity from `low` to `high`."""
    sums = [0]
    for s in segments:
        sums.append(sums[-1] + s.size)
    found, first, last = set(), 0, 0
    for _ in range(shards - 1):
        # earliest end of the shard: capacity low, nothing divided; latest: capacity high, all divided
        i = first
        while i < len(segments) and sums[i + 1] <= sums[first] + low:
            i += 1
        last += high
        j = i
        while j < len(segments) and sums[j] <= last:
            if not segments[j].whole:
                found.add(j)
            j += 1
        first = i
    return [segments[j] for j in sorted(found)]


def cuts(segments: list[Segment], shards: int, most: int) -> list[int]:
    """The first place of every shard but the first, near equal shares under the capacity `most`."""
    sizes = [s.size for s in segments]
    latest = _reach(sizes, shards, most)
    earliest = [len(sizes) - x for x in reversed(_reach(sizes[::-1], shards, most))]
    sums = [0]
    for x in sizes:
        sums.append(sums[-1] + x)
    out, before = [], 0
    for k, (a, b) in enumerate(zip(earliest, latest, strict=True), 1):
        ideal = sums[-1] * k / shards
        a, best = max(a, before), None
        for i in range(a, b + 1):
            if sums[i] - sums[before] <= most and (best is None or abs(sums[i] - ideal) < abs(sums[best] - ideal)):
                best = i
        before = best if best is not None else a
        out.append(segments[before].low if before < len(segments) else None)
    return out


def _sums(groups: DataFrame, ranges: list[Segment]) -> list[Segment]:
    """Each range, all of one width, split into parts of equal width: one aggregation."""
    width = ranges[0].width
    finer = max(1, -(-width // max(2, RANGES // len(ranges))))
    wanted = groups.sparkSession.createDataFrame([(r.low // width,) for r in ranges], "_range bigint")
    inside = groups.withColumn("_range", F.expr(f"_key div {width}")).join(F.broadcast(wanted), "_range")
    found = inside.groupBy("_range", F.expr(f"_key div {finer}").alias("_part")).agg(F.min("_key"), F.max("_key"), F.sum("_size"))
    return [Segment(*row[2:], finer) for row in found.collect()]


def plan(groups: DataFrame, shards: int) -> tuple[int, list[int]]:
    """The minimax capacity of `groups` (`_key`, `_size`: rows of one key add up) and the shards' first keys; keys are not negative."""
    row = groups.agg(F.min("_key"), F.max("_key"), F.sum("_size")).first()
    if row[0] is None:
        return 0, []
    segments = [Segment(*row, row[1] + 1)]
    while True:
        low, high = capacity(segments, shards, divisible=True), capacity(segments, shards)
        wanted = [] if low == high and len(segments) > 1 else _open(segments, shards, low, high)
        if not wanted:
            return high, cuts(segments, shards, high)
        parts = []
        for width in sorted({s.width for s in wanted}):
            parts += _sums(groups, [s for s in wanted if s.width == width])
        gone = set(wanted)
        segments = sorted([s for s in segments if s not in gone] + parts, key=lambda s: s.low)


def assign(docs: DataFrame, *, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: `size`, `text_crc32`, `law`, `shard`, `slot`, `grown_shard`."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("_id"), (F.octet_length(text) + 1).cast("bigint").alias("_size"), F.crc32(text.cast("binary")).alias("_crc"), F.sha2(text, 256).alias("_text"),
    )
    rows = cut(ranked(cut(rows), [], ["_id", "_text"], "_place"))
    # texts that occur once are groups of their own; the others take the place of their first document
    copies = rows.groupBy("_text").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    rows = attach(rows, copies, "_text", ["_first"], rows.count(), F.col("_place")).drop("_text")
    rows = cut(rows.withColumn("_key", F.coalesce("_first", "_place")).drop("_first"))
    _, firsts = plan(rows.select("_key", "_size"), shards)
    shard = F.lit(0)
    for first in firsts:
        if first is not None:
            shard = shard + (F.col("_key") >= first).cast("int")
    out = ranked(rows.withColumn("shard", shard), ["shard"], ["_place"], "slot")
    return out.select(
        F.col("_id").alias(id_col), F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
