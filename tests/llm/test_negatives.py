"""Hard negatives against plain Python and against the SQL."""

import math
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from palaver.llm import negatives
from palaver.llm.oracles import NEGATIVES
from palaver.llm.queries import op11_negatives

COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
KIND = "vec_id bigint, embedding array<float>, label int"


def brute(rows, every=50, positives=5, most=3):
    """Rows of (vec_id, vector, label); labels as they are."""
    own = [(k, [math.floor(256 * float(np.float32(x))) for x in v], label) for k, v, label in rows
           if None not in (k, v, label) and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, (k, q, label) in enumerate(own):
        if k % every:
            continue
        scored = [(-sum(a * b for a, b in zip(q, p)), other, other_label == label) for j, (other, p, other_label) in enumerate(own) if j != i]  # noqa: B905
        for p, positive, _ in sorted(s for s in scored if s[2])[:positives]:
            fit = sorted(s for s in scored if not s[2] and 50 * -p <= 100 * -s[0] <= 95 * -p)[:most]
            out += [(k, positive, rank, n, -p, -s) for rank, (s, n, _) in enumerate(fit, 1)]
    return Counter(out)


def found(df):
    return Counter(tuple(r) for r in df.select(*COLUMNS).collect())


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    got = found(op11_negatives(spark, folder))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    assert Counter(con.sql(f"SELECT {', '.join(COLUMNS)} FROM ({NEGATIVES})").fetchall()) == got and got
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    assert brute([(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in rows]) == got


def odd_rows(seed, n=900, dim=6, steps=5):
    rng = random.Random(seed)
    hot = [rng.randrange(-steps, steps) / 8 for _ in range(dim)]
    rows = []
    for k in range(n):
        vector = hot if k % 3 == 0 else [rng.randrange(-steps, steps) / 8 + 1e-3 for _ in range(dim)]
        rows.append((k - 100, vector, rng.choice([0, 1, 1, 1, 2, -7, 10**6])))
    rows += [(0, hot, 1), (50, hot, 1), (50, hot, 1), (50, hot, 2), (None, hot, 1), (1000, None, 1), (1050, hot, None), (1100, [], 1), (1150, [1.0], 1)]
    rows += [(1200, [math.nan] * dim, 1), (1250, [math.inf, *hot[1:]], 0), (1300, [None, *hot[1:]], 0), (1350, [0.0] * 9, 2), (1400, [-1.0] * dim, 77)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_odd_rows_ties_and_copies(spark, seed):
    rows = odd_rows(seed)
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], KIND + ", rank int, id string").repartition(5)
    assert found(negatives.mine(frame, F.col("vec_id") % 50 == 0)) == brute(rows)
    assert found(negatives.mine(frame, F.col("vec_id") % 10 == 0, positives=2, negatives=7, portion_bytes=600)) == brute(rows, 10, 2, 7)


@pytest.mark.parametrize(("size", "scale"), [(1.0, 256), (40.0, 256), (900.0, 4096)])
def test_small_blocks_and_wide_components(spark, monkeypatch, size, scale):
    """Many blocks, tiles and a first look; products of up to 50 bits."""
    for name, value in (("BLOCK", 100), ("TILE", 16), ("FIRST_LOOK", 3)):
        monkeypatch.setattr(negatives, name, value)
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(4, 12))
    label = rng.integers(0, 3, 1500)
    vectors = np.float32(size * (centre[label] * 0.6 + rng.normal(size=(1500, 12)) * 0.7 + centre[3] * 0.4))
    rows = [(k, v.tolist(), int(x)) for k, (v, x) in enumerate(zip(vectors, label, strict=True))]
    got = found(negatives.mine(spark.createDataFrame(rows, KIND), F.col("vec_id") % 50 == 0, scale=scale))
    own = [(k, [x * scale / 256 for x in v], label) for k, v, label in rows]
    assert got == brute(own) and sum(got.values()) > 100


def test_intervals_drop_pairs_and_never_the_best():
    """Planes of a block, from the top: what is dropped can't be among the best, and most pairs are dropped early."""
    rng = np.random.default_rng(8)
    data = np.floor(256 * rng.normal(size=(3000, 32)) * 0.2).astype(np.int64)[:2048]
    block = negatives.Planes({"block": 3, **negatives._block(range(2048), [1] * 2048, [0] * 2048, data)})
    assert (block.whole(np.arange(2048)) == data).all()
    values, seen = data[:16].astype(np.float32), []
    exact = data[:16] @ data.T
    floor = np.sort(exact, axis=1)[:, -20]

    def wanted(low, high, rows):
        seen.append(low.size)
        if low.ndim == 2:
            assert (low <= exact).all() and (high >= exact).all()
        return high >= floor[rows]

    i, j, score = negatives.pairs(values, block, np.arange(2048), np.ones((16, 2048), bool), wanted)
    assert len(i) == 16 * 20 and (score == exact[i, j]).all() and seen[-1] < seen[0] / 20


def test_empty_and_no_anchor(spark):
    frame = spark.createDataFrame([(1, [0.5], 1), (2, [0.5], 1)], KIND)
    assert not found(negatives.mine(frame, F.col("vec_id") % 50 == 0))
    assert not found(negatives.mine(frame.limit(0), F.lit(True)))
    assert not found(negatives.mine(frame, F.lit(True)))


def test_too_wide(spark):
    with pytest.raises(ValueError, match="53 bits"):
        negatives.mine(spark.createDataFrame([(0, [7e6] * 4, 1)], KIND), F.lit(True))
    with pytest.raises(Exception, match="32 bits"):
        negatives.mine(spark.createDataFrame([(0, [1e30], 1)], KIND), F.lit(True))
