"""Streams with state over restarts, and event-time windows with late rows."""

import datetime
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from palaver.streaming import bridge, windows
from palaver.streaming import dedup as streams


def batches(spark, tmp_path, schema, parts, make):
    """Each part as a new batch, each with a query of its own that goes on from the checkpoint."""
    source = tmp_path / "in"
    for rows in parts:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source))
        out = streams.run_available(make(spark.readStream.schema(schema).parquet(str(source))), str(tmp_path / "out"), str(tmp_path / "state"))
    return out


def test_actions_forget_idle_rooms(spark, tmp_path):
    """With a time to live of an hour nothing is forgotten within the test; the trigger is one of processing time."""
    import time

    kind, source = "room string, seq bigint, uid string, at double, wants_reply boolean", tmp_path / "in"
    rows = [("r", 1, "a", 0.0, True), ("r", 2, "b", 1.0, False), ("r", 3, "a", 2.0, True), ("s", 4, "a", 3.0, True)]
    spark.createDataFrame(rows, kind).coalesce(1).write.parquet(str(source))
    found = bridge.actions(spark.readStream.schema(kind).parquet(str(source)), first_is_old=False, idle=3_600_000)
    query = found.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(processingTime="1 second").start()
    try:
        until = time.time() + 60
        while time.time() < until and query.isActive and not any(p["numInputRows"] for p in query.recentProgress):
            time.sleep(0.5)
        assert query.exception() is None
    finally:
        query.stop()
    got = spark.read.schema(bridge.OUT).parquet(str(tmp_path / "out")).collect()
    assert {(r.room, r.uid, r.action) for r in got} == {("r", "a", "reply"), ("r", "b", "context"), ("s", "a", "reply")}


def test_actions_over_restarts(spark, tmp_path):
    rng = random.Random(1)
    rows = [(rng.choice("rs"), k, f"u{rng.randrange(160)}", float(30 * k), rng.random() < 0.5) for k in range(500)]
    parts = [rows[:100], rows[100:110], rows[110:]]
    out = batches(spark, tmp_path, "room string, seq bigint, uid string, at double, wants_reply boolean", parts, lambda s: bridge.actions(s, most=100, per_hour=9, spacing=60.0, per_batch=25))
    want, seen, sends, started = {}, {"r": [], "s": []}, {"r": [], "s": []}, set()
    for part in parts:
        replies = dict.fromkeys("rs", 0)
        for room, seq, uid, at, wants in part:
            if uid in seen[room]:
                continue
            seen[room] = [*seen[room], uid][-100:]
            want[seq] = "context"
            if wants and room in started and replies[room] < 25:
                near = [x for x in sends[room] if at - x < 3600]
                free = len(near) < 9 and (not near or at - near[-1] >= 60)
                want[seq], replies[room] = "reply" if free else "limited", replies[room] + 1
                sends[room] += [at] if free else []
        started |= {r[0] for r in part}
    assert {r.seq: r.action for r in out.collect()} == want and {"reply", "limited"} <= set(want.values())


def test_fallbacks_over_restarts(spark, tmp_path):
    rng = random.Random(2)
    rows = [(rng.choice("rs"), k, rng.random()) for k in range(400)]
    kind = "room string, seq bigint, confidence double"
    out = batches(spark, tmp_path, kind, [rows[:150], rows[150:155], rows[155:]], lambda s: bridge.fallbacks(s, target=0.25, window=24))
    batch = streams.fallback_rate(spark.createDataFrame(rows, kind), "room", target=0.25, window=24)
    assert {r.seq: r.fallback for r in out.collect()} == {r.seq: r.fallback for r in batch.collect()}


def test_windows_and_late_rows(spark, tmp_path):
    at = datetime.datetime(2024, 1, 1)
    minute = lambda m: at + datetime.timedelta(minutes=m)
    kind = "room string, ts timestamp_ntz, v int"
    parts = [[("r", minute(m), 1) for m in (0, 5, 65, 300)] + [("s", minute(20), 1), ("s", None, 9)], [("r", minute(301), 1)], [("r", minute(m), 7) for m in (1, 61, 290)], [("r", minute(900), 1)]]
    source = tmp_path / "in"
    for rows in parts:
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(str(source))
    got = {}
    for name, options in (("tumbling", {"size": "1 hour"}), ("sliding", {"size": "2 hours", "slide": "1 hour"}), ("session", {"gap": "30 minutes"})):
        stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(str(source))
        df, late = windows.run(windows.windowed(stream, "ts", ["room"], [F.sum("v").alias("v")], delay="30 minutes", **options), str(tmp_path / name), str(tmp_path / f"{name}-state"))
        got[name] = sorted((r.room, (r.started - at) / pd.Timedelta(minutes=1), (r.ended - at) / pd.Timedelta(minutes=1), r.v) for r in df.collect()), late
    assert got["tumbling"] == ([("r", 0, 60, 2), ("r", 60, 120, 1), ("r", 240, 300, 7), ("r", 300, 360, 2), ("s", 0, 60, 1)], 2)
    assert got["sliding"][0] == [("r", -60, 60, 2), ("r", 0, 120, 3), ("r", 60, 180, 1), ("r", 180, 300, 7), ("r", 240, 360, 9), ("r", 300, 420, 2), ("s", -60, 60, 1), ("s", 0, 120, 1)]
    assert got["session"] == ([("r", 0, 35, 2), ("r", 65, 95, 1), ("r", 290, 331, 9), ("s", 20, 50, 1)], 2)
    with pytest.raises(ValueError, match="size or a gap"):
        windows.windowed(stream, "ts", ["room"], [], size="1 hour", gap="1 hour")


class Map:
    """A map state that counts what is asked of it."""

    def __init__(self):
        self.held, self.calls = {}, 0

    def __getattr__(self, name):
        def run(key, *value):
            self.calls += 1
            return {"getValue": self.held.get, "containsKey": self.held.__contains__, "removeKey": self.held.pop, "updateValue": self.held.__setitem__}[name](key, *value)

        return run


class Value:
    def __init__(self):
        self.held = None

    def exists(self):
        return self.held is not None

    def get(self):
        return self.held

    def update(self, value):
        self.held = value


def test_a_batch_asks_the_state_for_few_entries(monkeypatch):
    """Not for some in every row; and the entries are those of rows that come one by one, however few are held."""
    rng, ends = random.Random(4), {}
    data = pd.DataFrame([("r", k, f"u{rng.randrange(300)}", 40.0 * k, rng.random() < 0.5, rng.random()) for k in range(3000)], columns=["room", "seq", "uid", "at", "wants_reply", "confidence"])
    for most, size in ((1 << 18, 3000), (1 << 18, 1000), (1 << 18, 1), (8, 500)):
        monkeypatch.setattr(bridge, "ENTRIES", most)
        acting, falling = bridge.Rooms(100, 5, 60.0, 1 << 40, False, None), bridge.Fallbacks(0.5, 0.3001, 41, None)
        acting.seen, acting.order, acting.sends, acting.ends, falling.ring, falling.sums = Map(), Map(), Map(), Value(), Map(), Value()
        out = []
        for at in range(0, len(data), size):
            part = data[at : at + size].sample(frac=1, random_state=at)
            for p in (acting, falling):
                out += [tuple(r) for f in p.handleInputRows(("r",), iter([part[:9], part[9:]] if size > 9 else [part]), None) for r in f.itertuples(index=False)]
        maps = acting.seen, acting.order, acting.sends, falling.ring
        ends[most, size] = sorted(map(str, out)), [dict(m.held) for m in maps], acting.ends.held, falling.sums.held
        assert most == 8 or size == 1 or sum(m.calls for m in maps) < 400 + 1500 * (3000 // size - 1)
        assert len(maps[0].held) == len(maps[1].held) == 100
    assert all(e == ends[1 << 18, 1] for e in ends.values()) and len(ends[1 << 18, 1][0]) > 4000
