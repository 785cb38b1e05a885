"""Greedy merging over ranges against the loop itself."""

import datetime
import random

import numpy as np
import pandas as pd
import pytest

from palaver.operators import ordered


def greedy(rows, gap=2.0, longest=320):
    """Rows of (file, ts, seq, speaker, text) in order."""
    out, before = [], None
    for f, ts, seq, speaker, text in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2])):
        text = text or ""
        joins = before and before[:2] == (f, speaker) and speaker is not None and ts is not None and before[2] is not None
        if joins and (ts - before[2]).total_seconds() / 60 <= gap and len(out[-1][4]) + len(text) + 1 <= longest:
            out[-1] = [f, out[-1][1], ts, speaker, out[-1][4] + "\n" + text]
        else:
            out.append([f, seq, ts, speaker, text])
        before = f, speaker, ts
    return sorted(map(tuple, out), key=str)


def run(spark, rows, parts, **options):
    frame = spark.createDataFrame([(*r, 1) for r in rows], "source_file string, ts timestamp_ntz, seq bigint, speaker string, text string, size int")
    held = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        out = ordered.merge(frame, **options).select("source_file", "seq", "ts", "speaker", "text").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", held)
    return sorted(map(tuple, out), key=str)


def messages(seed, n, speakers, minutes, sizes):
    rng, at, rows = random.Random(seed), datetime.datetime(2024, 1, 1), []
    for k in range(n):
        at += datetime.timedelta(minutes=rng.choice(minutes))
        rows.append((rng.choice(["a", "b"]), at, k, rng.choice(speakers), "é" * rng.choice(sizes)))
    return rows


@pytest.mark.parametrize("case", [(["x"], [0, 0, 1, 2, 3], [0, 1, 5, 90]), (["x", "y"], [0, 1], [0, 0, 1, 400, 40]), (["x", "x", "x", None], [0, 3], [10])])
@pytest.mark.parametrize("parts", [1, 7])
def test_random_messages(spark, case, parts):
    rows = messages(parts, 900, *case)
    assert run(spark, rows, parts) == greedy(rows)
    assert run(spark, rows, parts, longest=11, gap=0.0) == greedy(rows, 0.0, 11)


def test_a_message_across_ranges(spark):
    """One run over many ranges, so short that a merged message spans several; empty and null texts, null times, no rows."""
    at = datetime.datetime(2024, 1, 1)
    rows = [("f", at, k, "x", None if k % 7 == 0 else "") for k in range(300)] + [("f", None, k, "x", "t") for k in range(5)] + [("g", at, 0, "x", "u")]
    assert run(spark, rows, 40) == greedy(rows)
    assert run(spark, [], 3) == []


def test_ranges_compose_in_any_cut():
    """Batches of any size put together do what one does."""
    rng = np.random.default_rng(4)
    n = 400
    rows = pd.DataFrame({"source_file": "f", "speaker": rng.choice(["x", "y"], n, p=[0.98, 0.02]), "ts": pd.Timestamp("2024-01-01"), "size": rng.integers(0, 60, n)})
    whole = ordered.Range(*(b := ordered.Greedy(rows, 2.0, 100)).edges, *b.exit())
    for _ in range(20):
        cuts, own = [0, *sorted(rng.integers(1, n, 6).tolist()), n], None
        for a, z in zip(cuts[:-1], cuts[1:], strict=True):
            if z > a:
                batch = ordered.Greedy(rows.iloc[a:z], 2.0, 100)
                own = own.then(batch, 2.0) if own else ordered.Range(*batch.edges, *batch.exit())
        assert own.fresh == whole.fresh and (own.sizes == whole.sizes).all() and (own.through == whole.through).all()


def test_a_long_run_of_one_speaker(spark):
    """200,000 messages in a row of one speaker and minute."""
    from pyspark.sql import functions as F

    frame = spark.range(200_000).select(F.lit("f").alias("source_file"), F.lit("2024-01-01").cast("timestamp_ntz").alias("ts"), F.col("id").alias("seq"), F.lit("x").alias("speaker"), F.repeat(F.lit("w"), (F.col("id") * 7919 % 31).cast("int")).alias("text"))
    got = [(r.seq, r.n) for r in ordered.merge(frame).select("seq", F.length("text").alias("n")).orderBy("seq").collect()]
    want, size = [], 400
    for k in range(200_000):
        own = k * 7919 % 31
        if size + own + 1 <= 320:
            size += own + 1
        else:
            want.append([k, 0])
            size = own
        want[-1][1] = size
    assert got == [tuple(w) for w in want]
