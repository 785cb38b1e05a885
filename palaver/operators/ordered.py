"""Folds over ordered rows that no task has to see whole: ranges of rows, transitions between them, one scan of the transitions.

Rows are dealt by ranges of their order, so a range may begin and end anywhere in a file or a speaker's run.  Each task
sums up what its range does to any state it may be entered with; these summaries, one a range, are put together in
order; then each task knows its state at entry and does its part.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.streaming.dedup import folder


def cut(df: DataFrame) -> DataFrame:
    """A copy in the shared checkpoint folder, with the same partitions."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder(df.sparkSession, "checkpoint"))
    return df.checkpoint()


def laid(df: DataFrame, order: list[str]) -> DataFrame:
    """The rows in ranges of `order`, sorted, with the range's number as `_part`."""
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return cut(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()))


def follows(before: tuple, own: tuple, gap: float) -> bool:
    """Whether a message (file, speaker, time) goes on with the run of the one before it."""
    if before is None or before[:2] != own[:2] or own[1] is None or pd.isna(before[2]) or pd.isna(own[2]):
        return False
    return (own[2] - before[2]) / np.timedelta64(1, "us") / 60e6 <= gap


class Greedy:
    """Messages in order, and where greedy merging would begin a new one.

    `jump[i]` is the next beginning after one at i, from prefix sums of lengths; the last one points to itself.
    """

    def __init__(self, rows: pd.DataFrame, gap: float, longest: int):
        self.n, self.longest, own = len(rows), longest, ["source_file", "speaker"]
        ts = rows["ts"].to_numpy("datetime64[us]")
        same = (rows[own].to_numpy(object)[1:] == rows[own].to_numpy(object)[:-1]).all(axis=1) & rows["speaker"].notna().to_numpy()[1:]
        late = np.diff(ts) / np.timedelta64(1, "us") / 60e6 <= gap
        breaks = np.flatnonzero(~(same & late)) + 1
        self.first_break = int(breaks[0]) if len(breaks) else self.n
        self.sums = np.cumsum(rows["size"].to_numpy(np.int64) + 1)
        self.before = self.sums - rows["size"].to_numpy(np.int64) - 1
        at = np.arange(self.n)
        ends = np.append(breaks, self.n)[np.searchsorted(breaks, at, "right")]
        self.next = np.minimum(ends, np.searchsorted(self.sums, self.before + longest + 1, "right").clip(at + 1))
        self.jump = np.where(self.next < self.n, self.next, at)
        files, speakers = rows["source_file"].iloc, rows["speaker"].iloc
        self.edges = [(files[k], None if pd.isna(speakers[k]) else speakers[k], ts[k]) for k in (0, -1)]

    def entered(self, size: np.ndarray) -> np.ndarray:
        """The first beginning after an open message of `size` characters goes on with row 0."""
        return np.minimum(self.first_break, np.searchsorted(self.sums, self.longest - size, "right"))

    def exit(self) -> tuple[int, np.ndarray, np.ndarray]:
        """Length of the open message at the end: after a beginning at row 0, and after each size at entry; and whether it is the entered one."""
        last = self.jump
        while (further := last[last]) is not None and (further != last).any():
            last = further
        size = np.arange(self.longest + 1)
        at = self.entered(size)
        through = at == self.n
        end = int(self.sums[-1])
        sizes = np.where(through, size + end, end - self.before[last[np.minimum(at, self.n - 1)]] - 1)
        return end - int(self.before[last[0]]) - 1, sizes, through

    def beginnings(self, first: int) -> np.ndarray:
        """All beginnings from one at `first` on, by doubling of the pointers."""
        mark, jump = np.zeros(self.n, bool), self.jump
        mark[first : first + 1] = True
        while True:
            mark[jump[mark]] = True
            further = jump[jump]
            if (further == jump).all():
                return np.flatnonzero(mark)
            jump = further


@dataclass
class Range:
    """What a range does: its first and last message, and the open message at its end for any at its entry."""

    first: tuple
    last: tuple
    fresh: int
    sizes: np.ndarray
    through: np.ndarray

    def then(self, batch: Greedy, gap: float) -> Range:
        fresh, sizes, through = batch.exit()
        if not follows(self.last, batch.edges[0], gap):
            return Range(self.first, batch.edges[1], fresh, np.full_like(sizes, fresh), np.zeros_like(through))
        at = np.minimum(self.sizes, batch.longest)
        return Range(self.first, batch.edges[1], int(sizes[min(self.fresh, batch.longest)]), sizes[at], self.through & through[at])


def _summaries(rows: DataFrame, gap: float, longest: int) -> list[tuple[int, Range]]:
    """One a range that has rows, in order."""

    def run(batches):
        part = own = None
        for rows in batches:
            if len(rows):
                batch = Greedy(rows, gap, longest)
                part = int(rows["_part"].iloc[0])
                own = own.then(batch, gap) if own else Range(*batch.edges, *batch.exit())
        if own:
            (f, s, t), (f2, s2, t2) = own.first, own.last
            yield pd.DataFrame({"part": [part], "f": [f], "s": [s], "t": [pd.Timestamp(t)], "f2": [f2], "s2": [s2], "t2": [pd.Timestamp(t2)], "fresh": [own.fresh], "sizes": [own.sizes], "through": [own.through]})

    kind = "part int, f string, s string, t timestamp_ntz, f2 string, s2 string, t2 timestamp_ntz, fresh bigint, sizes array<bigint>, through array<boolean>"
    found = rows.select("_part", "source_file", "speaker", "ts", "size").mapInPandas(run, kind).orderBy("part").collect()
    time = lambda t: np.datetime64(t if t is not None else "NaT", "us")
    return [(r.part, Range((r.f, r.s, time(r.t)), (r.f2, r.s2, time(r.t2)), r.fresh, np.array(r.sizes), np.array(r.through))) for r in found]


def _entries(summaries: list[tuple[int, Range]], gap: float, longest: int) -> dict[int, tuple[int, int]]:
    """For each range that is entered in the middle of a message: its size so far and the range in which it began."""
    out, last, size, began = {}, None, 0, -1
    for part, own in summaries:
        if follows(last, own.first, gap):
            size = min(size, longest)
            out[part] = size, began
            began = began if own.through[size] else part
            size = int(own.sizes[size])
        else:
            size, began = own.fresh, part
        last = own.last
    return out


def merge(df: DataFrame, gap: float = 2.0, longest: int = 320) -> DataFrame:
    """Neighbouring messages of one speaker as one while gaps and length allow; it has the first one's `seq` and the last one's time.

    A speaker's run may have any number of messages and lies in as many ranges as its rows fill.  A message without speaker
    or time isn't merged; a null text is empty; rows of equal time and `seq` stand in any order.
    """
    rows = laid(df.select("source_file", "ts", "seq", "speaker", F.coalesce("text", F.lit("")).alias("text")).withColumn("size", F.length("text")), ["source_file", "ts", "seq"])
    entries = _entries(_summaries(rows, gap, longest), gap, longest)
    names = ["source_file", "seq", "ts", "speaker", "text", "_began", "_part"]

    def run(batches):
        # the open message: file, seq, time, speaker, texts, where it began (None: in this range), and the last row's key
        held = last = None
        part = size = 0

        def closed(began):
            return [held[0], held[1], held[2], held[3], "\n".join(held[4]), began, part]

        for rows in batches:
            if not len(rows):
                continue
            batch, out = Greedy(rows, gap, longest), []
            columns = [rows[c].tolist() for c in ("source_file", "seq", "ts", "speaker", "text")]
            part = int(rows["_part"].iloc[0])
            if last is None and part in entries:
                size, began = entries[part]
                held = [columns[0][0], columns[1][0], columns[2][0], columns[3][0], [], began]
                goes_on = True
            else:
                goes_on = follows(last, batch.edges[0], gap)
            upto = int(batch.entered(np.array(min(size, longest)))) if goes_on else 0
            if upto:
                held[4] += columns[4][:upto]
                held[2] = columns[2][upto - 1]
                size += int(batch.sums[upto - 1])
            if upto < batch.n:
                if held and held[4]:
                    out.append(closed(held[5]))
                starts = batch.beginnings(upto).tolist()
                for a, b in zip(starts, [*starts[1:], batch.n], strict=True):
                    held = [columns[0][a], columns[1][a], columns[2][b - 1], columns[3][a], columns[4][a:b], None]
                    if b < batch.n:
                        out.append(closed(None))
                size = int(batch.sums[-1] - batch.before[starts[-1]] - 1)
            last = batch.edges[1]
            if out:
                yield _frame(out, names)
        if held:
            # it may go on in the next range
            yield _frame([closed(part if held[5] is None else held[5])], names)

    kind = "source_file string, seq bigint, ts timestamp_ntz, speaker string, text string, _began int, _part int"
    pieces = cut(rows.mapInPandas(run, kind))
    # two pieces a range at most have another range's rows beside them
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_part", "text"))), lambda x: x["text"]), "\n")
    met = pieces.where("_began is not null").groupBy("_began").agg(
        *(F.min_by(c, "_part").alias(c) for c in ("source_file", "seq")), F.max_by("ts", "_part").alias("ts"), F.min_by("speaker", "_part").alias("speaker"), text.alias("text"),
    )
    own = ["source_file", "seq", "ts", "speaker", "text"]
    return pieces.where("_began is null").select(*own).unionByName(met.select(*own))


def _frame(rows: list, names: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=names)
    return out.astype({"_began": "Int32", "_part": "int32"})
