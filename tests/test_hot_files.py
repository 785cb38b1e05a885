"""Numbers of runs, sessions and places against plain Python, with files that span days, nulls and ties."""

import datetime as dt
import random
from itertools import groupby

from pyspark.sql import functions as F

from palaver.operators import messages

KIND = "source_file string, seq bigint, ts timestamp_ntz, speaker string, text string"


def rows_of(n, seed=7):
    rng, out = random.Random(seed), []
    at = dict.fromkeys(("a", "b", None), dt.datetime(2024, 2, 27, 22, 0))
    for k in range(n):
        name = rng.choice(("a", "a", "a", "b", None))
        at[name] += dt.timedelta(minutes=rng.choice((0, 1, 1, 2, 3, 60, 180, 181, 900)))
        out.append((name, k, None if rng.random() < 0.02 else at[name], rng.choice(("x", "x", "y", None)), f"t{k}"))
    return out


def in_order(rows):
    """Rows of each file, nulls first."""
    key = lambda r: (r[0] is not None, r[0] or "", r[2] is not None, r[2] or dt.datetime.min, r[1])
    return [list(g) for _, g in groupby(sorted(rows, key=key), key=lambda r: r[0])]


def gap(a, b):
    return None if a[2] is None or b[2] is None else (b[2] - a[2]).total_seconds() / 60


def session_of(rows):
    out = {}
    for file in in_order(rows):
        index = 0
        for k, r in enumerate(file):
            index += k > 0 and (gap(file[k - 1], r) or 0) > 180
            out[r[1]] = index
    return out


def test_sessions_of_files_over_days(spark):
    rows = rows_of(600)
    got = messages.sessions(spark.createDataFrame(rows, KIND)).collect()
    assert {r.seq: r.session_index for r in got} == session_of(rows)
    assert got[0].asDict().keys() == {"source_file", "seq", "ts", "speaker", "text", "session_index"}


def test_sessions_need_no_speaker(spark):
    rows = rows_of(50)
    got = messages.sessions(spark.createDataFrame(rows, KIND).drop("speaker")).collect()
    assert {r.seq: r.session_index for r in got} == session_of(rows)


def test_merge_over_midnight(spark):
    rows = rows_of(600)
    want = set()
    for file in in_order(rows):
        runs = []
        for k, r in enumerate(file):
            last = file[k - 1] if k else None
            joins = last and None not in (last[3], r[3]) and last[3] == r[3] and gap(last, r) is not None and gap(last, r) <= 2
            if joins:
                runs[-1].append(r)
            else:
                runs.append([r])
        want |= {(run[0][0], run[0][1], run[-1][2], run[0][3], "\n".join(r[4] for r in run)) for run in runs}
    got = messages.merge(spark.createDataFrame(rows, KIND), longest=10_000).collect()
    assert {(r.source_file, r.seq, r.ts, r.speaker, r.text) for r in got} == want and len(got) == len(want)


def test_split_and_flat_order(spark):
    rows = rows_of(600, seed=11)
    laid = messages.sessions(spark.createDataFrame(rows, KIND))
    index = session_of(rows)
    starts = {}
    for r in rows:
        starts.setdefault((r[0], index[r[1]]), []).append(r)
    first = lambda m: min((r[2] for r in m if r[2]), default=None)
    key = lambda kv: (first(kv[1]) is not None, first(kv[1]) or dt.datetime.min, kv[0][0] is not None, kv[0][0] or "", kv[0][1])
    order = [k for k, _ in sorted(starts.items(), key=key)]
    cut = min(max(int(len(order) * 0.8), 1), len(order) - 1)
    got = {(r.source_file, r.session_index): (r.split, r.n_messages) for r in messages.session_split(laid, 0.2).collect()}
    assert got == {k: ("train" if n < cut else "val", len(starts[k])) for n, k in enumerate(order)}
    shuffled = messages.shuffled_split(laid, 0.2).collect()
    assert len(shuffled) == len(order) and sum(r.split == "train" for r in shuffled) == cut
    inner = lambda m: sorted(m, key=lambda r: (r[2] is not None, r[2] or dt.datetime.min, r[1]))
    flat = [r[1] for k in order for r in inner(starts[k])]
    assert [r.seq for r in messages.flat_order(laid).orderBy("place").collect()] == flat
    assert messages.flat_order(laid).agg(F.max("place")).first()[0] == len(rows) - 1


def test_empty_and_single(spark):
    none = spark.createDataFrame([], KIND)
    laid = messages.sessions(none)
    assert laid.count() == messages.merge(none).count() == messages.session_split(laid).count() == messages.flat_order(laid).count() == 0
    one = messages.sessions(spark.createDataFrame(rows_of(1), KIND))
    assert [r.split for r in messages.session_split(one).collect()] == ["val"]
