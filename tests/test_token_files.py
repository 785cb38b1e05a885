"""Token and mask files: round trips over parts and blocks, predicates, failed and repeated writes, odd rows."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from palaver.sources import token_files


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    rng = np.random.default_rng(1)
    rows = [(k, rng.integers(0, 65_536, n).tolist(), rng.integers(0, 2, n).tolist()) for k, n in enumerate(rng.integers(0, 300, 400).tolist())]
    frame = spark.createDataFrame(rows, "k int, ids array<int>, mask array<int>").repartition(5)
    path = str(tmp_path_factory.mktemp("tokens"))
    token_files.write(frame, path, ["k"], part_ids=3_000)
    return path, [x for r in rows for x in r[1]], [x for r in rows for x in r[2]]


def whole(df):
    rows = df.orderBy("start").collect()
    assert [r.start for r in rows] == np.cumsum([0, *(len(r.ids) for r in rows)])[:-1].tolist()
    return [x for r in rows for x in r.ids], [x for r in rows for x in r["mask"]]


@pytest.mark.parametrize(("block", "split"), [(1024, 1 << 23), (7, 500), (5_000, 10)])
def test_blocks_across_parts(spark, written, block, split):
    path, ids, mask = written
    df = token_files.read(spark, path, block, split)
    assert whole(df) == (ids, mask)
    assert {len(r.ids) for r in df.where(F.col("start") < len(ids) // block * block).select("ids").collect()} <= {block}
    if split == 500:
        assert df.rdd.getNumPartitions() > 50


@pytest.mark.parametrize("where", ["start = 700", "start >= 60000", "start < 14 AND start > 0", "start IN (7, 21, 8)", "start < 0", "start > 1000000000"])
def test_predicates(spark, written, where):
    path, ids, _ = written
    got = sorted((r.start, *r.ids) for r in token_files.read(spark, path, 7, 500).where(where).collect())
    starts = [r[0] for r in spark.range(0, len(ids), 7).toDF("start").where(where).collect()]
    assert got == sorted((s, *ids[s : s + 7]) for s in starts)


def test_predicate_leaves_runs_out(written):
    from pyspark.sql.datasource import EqualTo

    reader = token_files.TokenReader({"path": written[0], "block": "7", "split": "500"})
    every = len(reader.partitions())
    list(reader.pushFilters([EqualTo(("start",), 7_000)]))
    assert len(reader.partitions()) == 1 < every


def test_files_are_flat(written):
    """What another program reads: the parts' bytes one after the other."""
    path, ids, mask = written
    with open(f"{path}/{token_files.LIST}") as f:
        parts = json.load(f)
    assert np.concatenate([np.fromfile(f"{path}/{p['name']}.ids", "<u2") for p in parts]).tolist() == ids
    assert np.concatenate([np.fromfile(f"{path}/{p['name']}.mask", np.uint8) for p in parts]).tolist() == mask
    assert len(parts) > 8


def test_failed_and_repeated_writes_leave_nothing(spark, tmp_path):
    path = str(tmp_path)
    good = spark.createDataFrame([(2, [3, 4], [0, 1]), (1, [70], [1]), (3, [], []), (4, None, None)], "k int, ids array<int>, mask array<int>")
    token_files.write(good, path, ["k"])
    for ids, mask, message in (([1, 2], [1], "differ"), ([70_000], [1], "65535"), ([-1], [1], "0 to"), ([5], None, "differ")):
        bad = spark.createDataFrame([(1, [9], [1]), (2, ids, mask)], "k int, ids array<int>, mask array<int>")
        with pytest.raises(Exception, match=message):
            token_files.write(bad, path, ["k"])
        # the rows from before still count
        assert whole(token_files.read(spark, path)) == ([70, 3, 4], [1, 0, 1])
    token_files.write(good, path, ["k"])
    listed = {f"{p['name']}.{kind}" for p in json.loads((tmp_path / token_files.LIST).read_text()) for kind in ("ids", "mask")}
    assert {f.name for f in tmp_path.iterdir() if f.name.startswith("part-")} == listed
    mask = next(f for f in tmp_path.iterdir() if f.name.endswith(".mask"))
    mask.write_bytes(mask.read_bytes() + b"\0")
    with pytest.raises(Exception, match="differ in length"):
        token_files.read(spark, path).collect()
    token_files.write(good.limit(0), path, ["k"])
    assert whole(token_files.read(spark, path)) == ([], [])
    assert [f.name for f in tmp_path.iterdir()] == [token_files.LIST]
