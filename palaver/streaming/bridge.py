"""Snapshots of chat rooms as a stream: new messages once, a first snapshot that only fills the memory, limited replies, fallbacks.

State is kept by room with `transformWithState`, in single entries: a map of what was seen and one of the order in which it
was added, so a message costs a few entries however much is remembered; a queue of the times of the replies of the last
hour; a ring of the last fallback decisions with their sum.  A batch works on copies of the entries that it needs and writes
back those that it changed (`Held`).  With `idle`, entries that weren't written for so long are forgotten.  A room's rows of
one batch are taken in order of `seq`; a restart goes on from the checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from palaver.streaming.dedup import falls_back

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUT = "room string, seq bigint, uid string, action string"
#: Entries that a batch holds of one map; rows that are Python objects at once.
ENTRIES, ROWS = 1 << 18, 10_000
KINDS = {"seq": pa.int64(), "uid": pa.large_string(), "at": pa.float64(), "wants_reply": pa.bool_(), "confidence": pa.float64()}


def _in_order(rows, names: list[str]) -> Iterator[tuple]:
    """A room's rows of one batch in order of `seq`: held as Arrow columns, Python has `ROWS` of them at once."""
    parts: dict[str, list] = {n: [] for n in names}
    for some in rows:
        for n in names:  # what isn't a number stays one
            given = some[n].to_numpy("float64") if pa.types.is_floating(KINDS[n]) else some[n]
            parts[n].append(pa.array(given, KINDS[n], from_pandas=not pa.types.is_floating(KINDS[n])))
    held = {n: pa.concat_arrays(parts.pop(n)) for n in names}
    order = held["seq"].to_numpy(zero_copy_only=False).argsort(kind="stable")
    for at in range(0, len(order), ROWS):
        some = pa.array(order[at : at + ROWS])
        yield from zip(*(c.take(some).to_pylist() for c in held.values()), strict=True)


def _given(found: Iterator[tuple], names: list[str]) -> Iterator[pd.DataFrame]:
    """Frames of `ROWS` rows."""
    while some := list(islice(found, ROWS)):
        yield pd.DataFrame(some, columns=names)


class Held:
    """A map state's entries as a batch sees them, read once and written once; more than `ENTRIES` are written before the end and read anew."""

    def __init__(self, state, empty: bool):
        """`empty`: the state is known to have no entry yet, so none is looked up."""
        self.state, self.empty = state, empty
        self.now, self.changed, self.fresh = {}, set(), set()

    def get(self, key):
        """None without an entry, or for one that has been idle for too long."""
        if key in self.now or self.empty:
            return self.now.get(key)
        self._limit()
        found = self.state.getValue((key,))
        self.now[key] = found[0] if found else None
        return self.now[key]

    def put(self, key, value, new: bool = False) -> None:
        """`new`: the key has no entry."""
        self._limit()
        if new and key not in self.changed:
            self.fresh.add(key)
        self.now[key] = value
        self.changed.add(key)

    def drop(self, key) -> None:
        if key not in self.fresh:
            self.now[key] = None
            self.changed.add(key)
            return
        self.fresh.discard(key)
        self.changed.discard(key)
        if self.empty:
            del self.now[key]
        else:
            self.now[key] = None

    def _limit(self) -> None:
        if len(self.now) >= ENTRIES:
            self.write()

    def write(self) -> None:
        for key in self.changed:
            if self.now[key] is not None:
                self.state.updateValue((key,), (self.now[key],))
            elif self.state.containsKey((key,)):
                self.state.removeKey((key,))
        self.empty = self.empty and not self.changed
        self.now, self.changed, self.fresh = {}, set(), set()


class Rooms(StatefulProcessor):
    """Actions: `seen` (dropped from the output), `context`, `reply` or `limited`."""

    def __init__(self, most: int, per_hour: int, spacing: float, per_batch: int, first_is_old: bool, idle: int | None):
        self.most, self.per_hour, self.spacing, self.per_batch, self.first_is_old, self.idle = most, per_hour, spacing, per_batch, first_is_old, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "uid string", "place bigint", self.idle)
        self.order, self.sends = (handle.getMapState(n, "place bigint", f"value {kind}", self.idle) for n, kind in (("order", "string"), ("sends", "double")))
        self.ends = handle.getValueState("ends", "head bigint, tail bigint, first bigint, next bigint", self.idle)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        yield from _given(self._decided(key[0], rows), ["room", "seq", "uid", "action"])

    def _decided(self, room: str, rows) -> Iterator[tuple]:
        started, replies = self.ends.exists(), 0
        head, tail, first, then = self.ends.get() if started else (0, 0, 0, 0)
        seen, order, sends = (Held(x, not started and self.idle is None) for x in (self.seen, self.order, self.sends))
        for seq, uid, at, wants in _in_order(rows, ["seq", "uid", "at", "wants_reply"]):
            if seen.get(uid) is not None:
                continue
            # remembers the id, and forgets the one that was added first if they are too many
            seen.put(uid, tail, new=True)
            order.put(tail, uid, new=True)
            tail += 1
            if tail - head > self.most:
                oldest = order.get(head)
                if oldest is not None:
                    seen.drop(oldest)
                order.drop(head)
                head += 1
            action = "context"
            if wants and (started or not self.first_is_old) and replies < self.per_batch:
                while first < then and ((x := sends.get(first)) is None or at - x >= 3600):
                    sends.drop(first)
                    first += 1
                free = then - first < self.per_hour and (first == then or at - sends.get(then - 1) >= self.spacing)
                action, replies = ("reply" if free else "limited"), replies + 1
                if free:
                    sends.put(then, at, new=True)
                    then += 1
            yield room, seq, uid, action
        for held in (seen, order, sends):
            held.write()
        self.ends.update((head, tail, first, then))

    def close(self) -> None:
        pass


class Fallbacks(StatefulProcessor):
    """`fallback` as `dedup.fallback_rate` decides it, a ring of the last decisions being the state."""

    def __init__(self, threshold: float, target: float, window: int, idle: int | None):
        self.threshold, self.target, self.window, self.idle = threshold, target, window, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ring = handle.getMapState("ring", "place int", "flag int", self.idle)
        self.sums = handle.getValueState("sums", "n bigint, total int", self.idle)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        yield from _given(self._decided(key[0], rows), ["room", "seq", "fallback"])

    def _decided(self, room: str, rows) -> Iterator[tuple]:
        started = self.sums.exists()
        n, total = self.sums.get() if started else (0, 0)
        ring = Held(self.ring, not started and self.idle is None)
        for seq, sure in _in_order(rows, ["seq", "confidence"]):
            held, place = min(n, self.window), n % self.window
            flag = falls_back(room, seq, sure, total, held, self.threshold, self.target)
            if held == self.window:
                total -= ring.get(place) or 0
            ring.put(place, int(flag))
            n, total = n + 1, total + int(flag)
            yield room, seq, flag
        ring.write()
        self.sums.update((n, total))

    def close(self) -> None:
        pass


def _with_state(rows: DataFrame, processor: StatefulProcessor, out: str, idle: int | None) -> DataFrame:
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    mode = "processingTime" if idle else "none"
    return rows.groupBy("room").transformWithStateInPandas(statefulProcessor=processor, outputStructType=out, outputMode="append", timeMode=mode)


def actions(messages: DataFrame, *, most: int = 2000, per_hour: int = 40, spacing: float = 12.0, per_batch: int = 2, first_is_old: bool = True, idle: int | None = None) -> DataFrame:
    """A stream of (`room`, `seq`, `uid`, `at` in seconds, `wants_reply`) as new messages with what to do about them.

    At least 100 ids are remembered a room.  With `first_is_old` a room's first batch gets no replies.  `idle` is in milliseconds
    and for triggers by processing time: with it, a query of what is available runs on and on.
    """
    return _with_state(messages, Rooms(max(100, most), per_hour, spacing, per_batch, first_is_old, idle), OUT, idle)


def fallbacks(replies: DataFrame, *, threshold: float = 0.5, target: float = 0.2, window: int = 200, idle: int | None = None) -> DataFrame:
    """A stream of (`room`, `seq`, `confidence`) with `fallback`: low confidence, as long as the share of the last `window` decisions allows it."""
    return _with_state(replies, Fallbacks(threshold, target, max(20, window), idle), "room string, seq bigint, fallback boolean", idle)
