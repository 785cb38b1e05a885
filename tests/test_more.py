"""Replies, vocabulary, rooms, datasets and configurations against plain Python."""

import random
from difflib import SequenceMatcher

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from palaver import cli
from palaver.functions import replies as R
from palaver.operators import dialogue, rooms
from palaver.operators.vocabulary import Vocabulary
from palaver.plans import config
from palaver.sources import datasets
from palaver.streaming import dedup as streams


def one(spark, text, f):
    return spark.createDataFrame([(text,)], "t string").select(f("t")).first()[0]


@pytest.mark.parametrize(("text", "want"), [
    (None, ""), ("", ""), ("답변: 출력:  hi", "hi"), ("x [ANSWER] a [ANSWER] b", "b"), ("[TASK] go", "go"), ("a [DIALOGUE] b", "a"),
    ("ok Bot: no", "ok"), ("bot: yes", "yes"), ("one\ntwo\nuser: three", "one\ntwo"), ("[SYSTEM] a [SYSTEM] b", "a [SYSTEM] b"),
])
def test_strip_artifacts(spark, text, want):
    assert one(spark, text, R.strip_artifacts) == want


def test_names(spark):
    assert one(spark, "[a]: b : c: d: e", R.normalize_reply) == "d: e"
    assert one(spark, " 방 1/2__x. ", R.file_slug) == "방_1_2_x"
    assert one(spark, "방", R.tag_slug) == "archive"
    assert [one(spark, x, R.mode) for x in ("1:1", " Single ", None)] == ["one_on_one", "one_on_one", "group"]
    assert [one(spark, x, R.role) for x in (" AI ", "me", None, "kim")] == ["bot", "user", "user", "user"]


def test_echo(spark):
    pairs = [("abcdefghij", "abcdefghix"), ("abcdefghijklmnopqrst", "abcdefghijklmnopqrsx"), ("abcdefgh", "abcdefgh"), ("abcdefghijkl", "abcdefghijklmno"), ("short", "short"), ("abcdefghijkl", None), (None, None), ("qwertyuiop", "asdfghjkl")]

    def want(a, b):
        if not a or not b or min(len(a), len(b)) < 8:
            return False
        return a == b or len(a) >= 12 and (a in b or b in a) or SequenceMatcher(None, a, b).ratio() >= 0.9

    rows = spark.createDataFrame(pairs, "a string, b string").select("a", "b", R.echoes("a", "b").alias("e")).collect()
    assert {(r.a, r.b): r.e for r in rows} == {p: want(*p) for p in pairs}


def test_echo_of_edited_texts(spark):
    """Texts of all alphabets with edits, held against the ratio itself: the bounds decide only what it decides."""
    rng, pairs = random.Random(4), []
    for k in range(1500):
        letters = ["ab", "abcdefgh", "abcdefghijklmnopqrstuvwxyz0123456789", "가나다라마바사아자차카타파하힣각"][k % 4]
        own = [rng.choice(letters) for _ in range(rng.randrange(8, 60 if k % 5 else 400))]
        last = list(own)
        for _ in range(rng.randrange(0, 2 + len(own) // rng.choice((4, 8, 16, 40)))):
            at = rng.randrange(len(last) + 1)
            last[at : at + rng.randrange(2)] = [rng.choice(letters)] * rng.randrange(2)
        pairs.append(("".join(own), "".join(last)))
    pairs += [(a, c) for (a, _), (_, c) in zip(pairs, pairs[4:], strict=False)]

    def alike(a, b):
        return SequenceMatcher(None, a, b).ratio() >= 0.9

    def same(a, b):
        return a == b or len(a) >= 12 and (a in b or b in a)

    frame = spark.createDataFrame(pairs, "a string, b string")
    rows = frame.select("a", "b", R.echoes("a", "b").alias("e"), R.echo_undecided("a", "b").alias("u")).collect()
    want = [min(len(r.a), len(r.b)) >= 8 and (same(r.a, r.b) or alike(r.a, r.b)) for r in rows]
    assert [r.e for r in rows] == want
    assert any(r.u and r.e for r in rows) and sum(w for w in want) > 300


def test_echo_pairs_that_reach_python(spark):
    """Of the turns of the tables, one in seven needs a matching of blocks at most: long ones of the same letters."""
    bots = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").where("role = 'assistant'")
    last = F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn"))
    n, open_ = bots.withColumn("last", last).agg(F.count("last"), F.sum(R.echo_undecided("text", F.col("last")).cast("int"))).first()
    assert n > 0 and open_ <= n / 7


def test_scored(spark):
    rows = [("fine reply here", None), ("", None), ("a", None), ("haha haha haha haha haha", None), ("the same reply", "the same reply")]
    got = dialogue.scored(spark.createDataFrame(rows, "text string, last string"), "text", "last").collect()
    assert [r.score for r in got] == [100, -40, 60, 70, 70]
    assert got[3].reply == "haha haha"


def test_vocabulary(spark):
    v = Vocabulary({"kim": "<|spk:kim|>"})
    texts = ["", "a<|eos|>é", "<|spk:kim|>", "plain", None, "<|pad|><|pad|>"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", v.encode("t").alias("ids"), v.count("t").alias("n")).withColumn("back", v.decode(F.col("ids"))).collect()
    assert [r.back for r in rows] == [t or "" for t in texts]
    assert [len(r.ids) for r in rows] == [r.n for r in rows]
    assert rows[1].ids == [v.offset + 97, 2, *(v.offset + b for b in "é".encode())]
    assert v.size == 5 + 256
    bad = spark.range(1).select(v.decode(F.array(F.lit(v.offset + 0xFF), F.lit(9999), F.lit(-1), F.lit(1))).alias("t")).first().t
    assert bad == "�<|bos|>"
    assert spark.range(1).select(v.stop_ids(F.lit("kim")).alias("x")).first().x == [2, 1]


def test_rooms(spark):
    text = "우리 방 카카오톡 대화\n저장한 날짜 : 2024. 3. 5. 14:02\n\n2024. 3. 5. 9:01, kim : hi\n2024. 3. 5. 9:02, lee : bye\nkim님이 나갔습니다.\n"
    texts = spark.createDataFrame([("a.txt", text), ("b.txt", ""), ("c.txt", "kim: yes\nlee: no")], "source_file string, text string")
    got = {r.source_file: r for r in rooms.metadata(texts).collect()}
    assert tuple(got["a.txt"])[1:] == ("우리 방", "2024. 3. 5. 14:02", "2024-03", 6, 2)
    assert tuple(got["b.txt"])[1:] == ("b", "unknown", "unknown-date", 0, 0)
    last = {r.source_file: (r.ts, r.speaker, r.text) for r in rooms.last_message(texts, "lee").collect()}
    assert last == {"a.txt": ("2024. 3. 5. 9:01", "kim", "hi"), "c.txt": (None, "kim", "yes")}


def test_datasets(spark, tmp_path):
    datasets.write_document(spark.range(1).selectExpr("id", "'가' AS name"), str(tmp_path / "d.json"))
    assert datasets.read_document(spark, str(tmp_path / "d.json")).first().name == "가"


def test_fallback_rate(spark):
    rows = spark.createDataFrame([("r", i, 0.1) for i in range(200)] + [("s", i, 0.9) for i in range(5)], "room string, seq bigint, confidence double")
    got = streams.fallback_rate(rows, "room", target=0.25).collect()
    assert 0.15 <= sum(r.fallback for r in got if r.room == "r") / 200 <= 0.3
    assert not any(r.fallback for r in got if r.room == "s")


def test_config(tmp_path):
    (tmp_path / "c.yaml").write_text('{"a": {"x": "${N:3}"}, "p": "${NONE}"}')
    base = {"a": {"x": 1, "y": 2}, "b": [1]}
    assert config.load(str(tmp_path / "c.yaml"), base, {}) == {"a": {"x": 3, "y": 2}, "b": [1], "p": ""}
    assert config.load(str(tmp_path / "none.yaml"), base, {}) == base
    env = {"PALAVER_CFG__TRAIN__A__X": "5", "PALAVER_CFG__GEN__A__X": "6", "PALAVER_CFG__Q": "true"}
    assert config.overridden(base, "train", env=env) == {"a": {"x": 5, "y": 2}, "b": [1], "q": True}
    (tmp_path / ".env").write_text("﻿A='1'\n# no\nB = two\nbad\n", encoding="utf-8")
    assert config.dotenv(str(tmp_path / ".env")) == {"A": "1", "B": "two"}
    assert [config.chosen(-1, 4, 9), config.chosen(None, None, 9, 10), config.chosen(0, 4, 9, 1)] == [4, 10, 1]
    with pytest.raises(ValueError, match="at least"):
        config.require("usable", 3, 200)


def test_cli(capsys):
    assert cli.main(["list"]) == 0
    assert "strip_artifacts" in capsys.readouterr().out


def test_parse_errors_of_dropped_files(spark):
    from palaver.sources import chat

    rows = [("good", "2024. 1. 2. 3:04, a : x"), ("bad", "2024. 1. 2. 3:04, a : x\n2024. 13. 2. 3:04, a : y\n2024. 14. 2. 3:04, a : z"), ("system", "2024. 1. 2. 3:04, a : x\n2024. 13. 2. 3:04: a left"), ("null", None)]
    texts = spark.createDataFrame(rows, "source_file string, text string")
    bad = {"bad": "bad time: 2024. 13. 2. 3:04", "null": "cannot be decoded"}
    for system, errors in ((False, bad), (True, bad | {"system": "bad time: 2024. 13. 2. 3:04"})):
        assert {r.source_file: r.reason for r in chat.parse_errors(texts, system).collect()} == errors
        assert {r.source_file for r in chat.messages(texts, system).collect()} == {r[0] for r in rows} - errors.keys()


def test_vocabulary_runs_without_python_workers(spark):
    """Ids and texts against plain Python, on broken bytes too, in plans that have no Python."""
    import random

    rng, v = random.Random(6), Vocabulary({"a": "<|spk:a|>", "é": "<|spk:é|>"})
    rows = [(k, [rng.choice([*range(v.offset), *(v.offset + b for b in (0x41, 0x3C, 0x7C, 0xC3, 0xA9, 0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0x98, 0x80, 0xED, 0xA0, 0xC0, 0xF5, 0xFF)), -1, v.size, v.size + 9]) for _ in range(rng.randrange(12))]) for k in range(3000)]
    rows += [(3000, None), (3001, [v.offset + b for b in range(256)])]

    def text_of(ids):
        out, held = [], bytearray()
        for i in ids or ():
            if 0 <= i < v.offset:
                out += [held.decode(errors="replace"), v.specials[i]]
                held = bytearray()
            elif 0 <= i - v.offset < 256:
                held.append(i - v.offset)
        return "".join([*out, held.decode(errors="replace")])

    def ids_of(text):
        import re

        split = re.compile("(" + "|".join(re.escape(t) for t in sorted(v.ids, key=len, reverse=True)) + ")")
        return [i for part in split.split(text) if part for i in ([v.ids[part]] if part in v.ids else [v.offset + b for b in part.encode()])]

    df = spark.createDataFrame(rows, "k int, ids array<int>")
    decoded = df.select("k", v.decode(F.col("ids")).alias("t"))
    texts = {r.k: r.t for r in decoded.collect()}
    assert texts == {k: text_of(ids) for k, ids in rows}
    some = [(k, t + "<<|bos|><|bos<|spk:é|>|>Ã<|") for k, t in texts.items()]
    encoded = spark.createDataFrame(some, "k int, t string").select("k", v.encode("t").alias("ids"))
    assert {r.k: r.ids for r in encoded.collect()} == {k: ids_of(t) for k, t in some}
    assert spark.range(1).select(Vocabulary({"a": "A"}).encode(F.lit("AB<|eos|>")).alias("ids")).first().ids == [4, 5 + 66, 2]
    for plan in (spark.range(1).select(v.encode(F.col("id").cast("string"))), spark.range(1).select(v.decode(F.array(F.col("id").cast("int"))))):
        assert "Python" not in plan._jdf.queryExecution().toString()
