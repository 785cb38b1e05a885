"""The registered queries themselves, scoring against plain Python, executors without the package, and the stages' edges."""

import math
import os
import re
import subprocess
import sys
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import brute
from palaver.llm import queries

FOLDER = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
KEYS = {"op7_warc": "page_id", "op2_language": "doc_id"}


def duck(folder):
    con = duckdb.connect()
    for f in os.listdir(folder):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{folder}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_registered_query(spark, name):
    df = queries.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    rows = df.select(*columns).collect()
    con = duck(FOLDER)
    if name in queries.ORACLE:
        rel = con.sql(queries.ORACLE[name])
        assert sorted(rel.columns) == columns
        assert Counter(tuple(r) for r in rows) == Counter(rel.select(*columns).fetchall())
    if name in ("op11_negatives", "op12_phrases"):  # rows that aren't one a document
        assert rows
        return
    key = KEYS.get(name, "doc_id")
    table = "pages" if key == "page_id" else "documents"
    wanted = {r[0] for r in con.sql(f"SELECT {key} FROM {table}").fetchall()}
    assert {r[key] for r in rows} - {None} == wanted
    if name not in ("op10_packing", "op2_language"):
        assert len(rows) == len(wanted)


def test_toxicity_against_plain_python(spark):
    from palaver.llm import toxicity
    from palaver.llm.kernel import Words, string_bytes

    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    weight = dict(zip(model.hashes.tolist(), model.weights.tolist()))

    def hashes(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")
        for w in words:
            one = Words(*string_bytes(pa.array([w])))
            yield int(one.hashes[0])
            yield from (int(one.prefixes(n)[0]) for n in toxicity.BEGINNINGS)

    texts = {r.doc_id: r.text for r in docs.where("doc_id % 40 = 0").collect()}
    got = {r.doc_id: r.toxicity for r in toxicity.score(docs, model).collect()}
    for key, text in texts.items():
        score = sum(weight.get(h, 0.0) for h in set(hashes(text)))
        above = [1 / (1 + math.exp(t - score)) for t in model.thresholds]
        each = [1 - above[0], *(a - b for a, b in zip(above, [*above[1:], 0.0]))]
        assert got[key].p_toxic == pytest.approx(above[0], abs=1e-9) and got[key].severity == pytest.approx(sum(above), abs=1e-9)
        assert got[key].grade == int(np.argmax(each))


def test_toxicity_of_more_documents(spark):
    """A held-out quarter of sf0.1's labels."""
    from pyspark.sql import functions as F

    from palaver.llm import toxicity

    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    got = {r.doc_id: r.toxicity for r in toxicity.score(docs, toxicity.fit(docs, labels.where(~fold))).collect()}
    rows = labels.where(fold).collect()
    assert np.mean([got[r.doc_id].p_toxic >= 0.5 for r in rows if r.toxic]) > 0.75
    assert np.mean([got[r.doc_id].p_toxic >= 0.5 for r in rows if not r.toxic]) < 0.005
    assert len({x.grade for x in got.values()}) >= 3


def test_toxicity_of_graded_labels(spark):
    from palaver.llm import toxicity

    rng = np.random.default_rng(4)
    rows = []
    for k in range(1200):
        grade = int(rng.integers(0, 4))
        rows.append((k, " ".join(["plain"] * 5 + [f"bad{x}" for x in range(2 * grade)]), grade))
    table = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    model = toxicity.fit(table.drop("toxic"), table.drop("text"))
    assert len(model.thresholds) == 3 and (np.diff(model.thresholds) > 0).all()
    got = {r.doc_id: r.toxicity for r in toxicity.score(table.drop("toxic"), model).collect()}
    assert np.mean([got[k].grade == g for k, _, g in rows]) > 0.95


def test_quality_measures_against_plain_python():
    from palaver.llm import quality

    half = lambda n: " ".join(f"w{k % (n // 2)}" for k in range(n))
    texts = ["", None, "a b", half(1000), half(2000), " ".join(f"x{k}" for k in range(250)), "one two " * 300, "Ünï çode. " * 40, "a\nb\na\n" * 30]
    values, _ = quality.measures(pa.array(texts))
    for text, row in zip(texts, values, strict=True):
        words = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")
        folded = [brute.folded(w) for w in words]
        assert row[4] == len(words)
        if len(words) < quality.FEW:
            assert np.isnan(row[[1, 2, 3, 5, 6, 11]]).all()
            continue
        distinct = sum(len(set(folded[a : a + 100])) for a in range(0, len(words), 100)) / len(words)
        assert row[1] == pytest.approx(distinct) and row[2] == pytest.approx(max(Counter(folded).values()) / len(words))
        assert row[11] == pytest.approx(sum(a == b for a, b in zip(folded, folded[1:])) / len(words))
        assert row[5] == pytest.approx(sum(len(w.encode()) <= 3 for w in words) / len(words))
    # a text's share of distinct words doesn't depend on how long it is
    long, longer = quality.measures(pa.array([half(1000), " ".join([half(1000)] * 2)]))[0][:, 1]
    assert long == pytest.approx(longer)


def test_language_against_plain_python(spark):
    from palaver.llm import langid

    k, names = 3, ["aa", "bb", "cc"]
    rng = np.random.default_rng(7)
    rows = [(i, rng.choice(["h1", "h2", "h3", None]), rng.choice(["s1", "s2", None]), rng.choice([*names, "zz", None]), [0.0] * k if i % 9 == 0 else (-rng.random(k) * 9).tolist()) for i in range(300)]
    rows = [(i, *(None if x is None else str(x) for x in r[:3]), r[3]) for i, *r in rows]
    frame = spark.createDataFrame(rows, "id bigint, host string, suffix string, declared string, like array<double>")
    got = {r.id: (r.language, r.confidence, r.text_language) for r in langid.fuse(frame, names).collect()}
    soft = lambda x: (np.exp(np.array(x)) / np.exp(np.array(x)).sum())
    own = {r[0]: soft(r[4]) for r in rows}
    seen = {r[0] for r in rows if max(r[4]) < 0}
    world = np.ones(k) + sum(own[r[0]] for r in rows if r[0] in seen)
    world /= world.sum()
    table = np.full((k, k), langid.DECLARED)
    for r in rows:
        if r[0] in seen and r[3] in names:
            table[names.index(r[3])] += own[r[0]]
    table = np.log(table / table.sum(axis=0))
    for r in rows:
        def others(at):
            return sum((own[x[0]] for x in rows if x[at] == r[at] and x[0] in seen and x[0] != r[0]), np.zeros(k)) if r[at] is not None else np.zeros(k)

        by_suffix, by_host = others(2), others(1)
        prior = (by_suffix + langid.SUFFIX * world) / (by_suffix.sum() + langid.SUFFIX)
        prior = (by_host + langid.HOST * prior) / (by_host.sum() + langid.HOST)
        logs = np.array(r[4]) + np.log(prior) + (table[names.index(r[3])] if r[3] in names else 0)
        want = soft(logs)
        language, sure, text = got[r[0]]
        assert sure == pytest.approx(want.max(), abs=1e-9) and language == names[int(want.argmax())]
        assert text == (names[int(np.argmax(r[4]))] if r[0] in seen else None)


@pytest.mark.parametrize("unclosed", ["<!-- x ", "<script ", "<", "</script"])
def test_visible_is_linear(unclosed):
    import time

    from palaver.llm.langid import visible

    began = time.time()
    visible(unclosed * 50_000)
    assert time.time() - began < 2
    assert visible("a<!-- <b> -->b<script>x</SCRIPT >c<p>d&amp;e<style>f") == "a b c d e f"


def test_any_ids(spark):
    """Hashed, negative, extreme, repeated and null ids."""
    from pyspark.sql import functions as F

    from palaver.llm import fingerprint, sharding

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select(F.xxhash64("doc_id").alias("doc_id"), "text")
    odd = [(None, "a b"), (None, None), (2**63 - 1, "x"), (-(2**63), "y"), (2**62 + 5, None), (7, "twice"), (7, "twice")]
    table = docs.union(spark.createDataFrame(odd, "doc_id bigint, text string"))
    rows = sorted(((r[0], r[1] or "") for r in table.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = brute.edited(list(enumerate(t for _, t in rows)))
    got = fingerprint.digest(table).collect()
    assert Counter((r.doc_id, r.edited_sha256) for r in got) == Counter((rows[k][0], brute.sha(t)) for k, t in want.items())
    load, sizes, first = Counter(), Counter(), {}
    for r in sharding.assign(table).collect():
        load[r.shard] += r["size"]
    for k, (_, t) in enumerate(rows):
        sizes[first.setdefault(t, k)] += len(t.encode()) + 1
    assert sum(load.values()) == sum(sizes.values())
    # rows of one id may stand in another order here, which moves no group but those that begin there
    assert max(load.values()) <= brute.minimax([sizes[k] for k in sorted(sizes)], 16) + 20


def test_executors_without_the_package(tmp_path):
    """All queries from a folder that lacks the repository; only the driver finds it."""
    script = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
def absent(_):
    import importlib.util
    return importlib.util.find_spec("palaver") is None
assert spark.sparkContext.parallelize([0]).map(absent).first()
from palaver.llm import queries
for name, query in queries.QUERIES.items():
    assert query(spark, {FOLDER!r}).count() > 0, name
print("all ran")
"""
    (tmp_path / "driver.py").write_text(script)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    said = subprocess.run([sys.executable, str(tmp_path / "driver.py")], cwd=tmp_path, capture_output=True, text=True, env=env, timeout=900)
    assert "all ran" in said.stdout, said.stderr[-3000:]


@pytest.mark.parametrize("which", ["odd", "empty", "repeated"])
def test_stages_on_odd_documents(spark, which):
    import corpus_pipeline

    rows = [(1, None, None, None, None), (None, "no id at all here", "en", "s", 17), (2, "", "en", "s", 0), (3, "w " * 30_000, "en", None, 60_000), (4, "password = abcdefghij0123456789", None, "s", 5)]
    rows = {"odd": rows, "empty": [], "repeated": [(5, "one two three four five six", "en", "s", 27)] * 3 + [(6, "one two three four five six", "en", "s", 27)]}[which]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").selectExpr("*", "1 as toxicity", "2 as secrets", "3 as contamination", "'x' as id", "'y' as token")
    for name, stage in corpus_pipeline.STAGES:
        left = stage(spark, docs, FOLDER)
        got = left.collect()
        if name == "packing":
            assert {r.doc_id for r in got} == {r[0] for r in rows}
            continue
        assert left.dtypes == docs.dtypes
        ids = Counter(r.doc_id for r in got)
        want = Counter(r[0] for r in rows)
        assert ids == (Counter({5: 3}) if name == "setjoin" and which == "repeated" else want)
        if name == "secrets" and which == "odd":
            text = {r.doc_id: (r.text, r.n_chars) for r in got}
            assert text[4] == ("<assign>", 8) and text[1] == (None, 0)
