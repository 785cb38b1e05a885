"""Learned vocabularies and digests of files."""

import hashlib

from pyspark.sql import functions as F

from palaver.operators import dictionary, manifest
from palaver.operators.tokens import BASE
from palaver.sources import digests


def test_learned_ids(spark, tmp_path):
    names = ["kim", "Ann", "a b", "a_b", "UNKNOWN", "", None, "kim", *(f"n{k}" for k in range(500))]
    rows = spark.createDataFrame([(n, k) for k, n in enumerate(names)], "speaker string, token_id int")
    vocabulary = dictionary.learn(rows)
    held = {r.speaker: (r.token, r.id) for r in vocabulary.collect()}
    assert held.keys() == {n for n in names if n is not None}
    fresh = sorted({t for t, _ in held.values()} - set(BASE))
    ids = dict(zip([*BASE, *fresh], range(len(BASE) + len(fresh)), strict=True))
    assert all(i == ids[t] for t, i in held.values()) and held[""][1] == 3  # which has no name, and comes first
    # the order of the rows changes no id
    assert {r.speaker: r.id for r in dictionary.learn(rows.orderBy(F.desc("token_id"))).collect()} == {k: i for k, (_, i) in held.items()}
    dictionary.save(vocabulary, str(tmp_path / "v"))
    back = dictionary.load(spark, str(tmp_path / "v"))
    assert {r.speaker: (r.token, r.id) for r in back.collect()} == held
    asked = spark.createDataFrame([(n, 0) for n in ("kim", "nobody", None, "a_b")], "speaker string, k int")
    for most in (1_000_000, 10):
        got = [(r.speaker, r.token_id) for r in dictionary.look_up(asked, back, most=most).collect()]
        assert sorted(got, key=str) == sorted([("kim", held["kim"][1]), ("nobody", 3), (None, 3), ("a_b", held["a_b"][1])], key=str)


def test_no_speaker(spark):
    none = spark.createDataFrame([(None,)], "speaker string")
    assert dictionary.learn(none).count() == 0 and [r.token_id for r in dictionary.look_up(none, dictionary.learn(none)).collect()] == [3]


def test_inventory_streams_texts(spark):
    rows = [("a", 2, "second\nline"), ("a", 1, "first é"), ("b", 1, ""), (None, 1, "no name"), ("c", 1, None), ("a", 3, None), ("d", 1, "x\n")]
    got = {r.name: (r.sha256, r.bytes, r.line_count) for r in manifest.inventory(spark.createDataFrame(rows, "name string, k int, text string"), "name", "text", "k").collect()}
    want = {"a": "first é\nsecond\nline", "b": "", None: "no name", "c": "", "d": "x\n"}
    assert got == {k: (hashlib.sha256(t.encode()).hexdigest(), len(t.encode()), t.count("\n") + 1) for k, t in want.items()}


def test_digests_of_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(digests, "BUFFER", 7)
    files = {f"f{k}.txt": bytes([k % 256]) * (k * 5) + b"\nend" * (k % 3) + b"\n" * (k % 2) for k in range(20)} | {"empty": b""}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    df = digests.digests(spark, str(tmp_path), task=200)
    assert df.rdd.getNumPartitions() > 3
    assert {r.source_file: (r.sha256, r.bytes, r.line_count) for r in df.collect()} == {
        n: (hashlib.sha256(d).hexdigest(), len(d), d.count(b"\n") + (bool(d) and not d.endswith(b"\n"))) for n, d in files.items()
    }


def test_digests_of_files_in_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(digests, "BUFFER", 7)
    parts = {"a": [b"x\n" * 9, b"yy\nz", b""], "a-b": [b"\n"], "b": [b"", b"no end"]}
    for name, data in parts.items():
        (tmp_path / name).mkdir()
        for k, d in enumerate(data):
            (tmp_path / name / f"part-{k:05}").write_bytes(d)
        (tmp_path / name / "_SUCCESS").write_bytes(b"")
    whole = {n: b"".join(d) for n, d in parts.items()}
    assert {r.source_file: (r.sha256, r.bytes, r.line_count) for r in digests.digests(spark, str(tmp_path), parts=True).collect()} == {
        n: (hashlib.sha256(d).hexdigest(), len(d), d.count(b"\n") + (not d.endswith(b"\n"))) for n, d in whole.items()
    }


def test_language_files_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """No task takes all texts of a language."""
    from palaver.plans import scale

    seen = []
    monkeypatch.setattr(scale.digests, "digests", lambda s, path, **k: seen.append(path) or s.createDataFrame([], "path string, sha256 string, bytes bigint, line_count bigint"))
    monkeypatch.setattr(scale, "new_folder", lambda s, name: str(tmp_path / name))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        scale.file_digests(spark, "/root/testdata/sf0.01")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = spark.read.text(seen[-1]).select("lang", "_metadata.file_path").groupBy("lang").agg(F.count_distinct("file_path").alias("n"))
    assert max(r.n for r in rows.collect()) > 2
