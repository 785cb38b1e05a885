"""Turns, text functions in the order of their steps, streams with state, and files against plain Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from palaver.functions import text as T
from palaver.functions import replies, turns
from palaver.operators import messages, rooms
from palaver.plans import config
from palaver.sources import chat
from palaver.streaming import bridge
from palaver.streaming import dedup as streams


def one(spark, text, f):
    return spark.createDataFrame([(text,)], "t string").select(f("t")).first()[0]


@pytest.mark.parametrize(("text", "want"), [
    (None, ""), ("a\x0bb", "ab"), ("a\tb", "a\tb"), ("a\t\tb", "a b"), ("\n a \r\n\r\n b", "a b"), ("a ​ b", "a b"), ("x\x7f\x00y", "xy"), ("a \x1f b", "a b"),
])
def test_sanitize(spark, text, want):
    assert one(spark, text, lambda c: T.sanitize_text(c, 200)) == want


@pytest.mark.parametrize(("text", "want"), [("a \n\n\n\n b  c", "a\n\nb c"), (" x\t\ny ", "x\ny")])
def test_sanitize_lines(spark, text, want):
    assert one(spark, text, lambda c: T.sanitize_text(c, lines=True)) == want


@pytest.mark.parametrize(("text", "want"), [("\n- one\n- two", "one\ntwo"), ("요약 : a  b,", "a b"), ("  ", ""), ("정리 : x", "x")])
def test_soften_summary(spark, text, want):
    assert one(spark, text, T.soften_summary) == want


def test_repetitive_keeps_case(spark):
    from collections import Counter

    def plain(text):
        compact = re.sub(r"\s+", "", text)
        tokens = text.split()
        if re.search(r"(.{2,16})(?:\1){2,}", compact):
            return True
        if len(tokens) < 10:
            return False
        top = lambda n: max(Counter(zip(*(tokens[k:] for k in range(n)))).values())
        return len(set(tokens)) / len(tokens) < 0.55 or any(len(tokens) >= 3 * n and top(n) >= 3 and top(n) >= int((len(tokens) - n + 1) * 0.5) for n in (2, 3))

    rng = random.Random(3)
    texts = ["Go go GO gO Oh oh OH oH x y", "go go go go oh oh oh oh x y", "", "a b c"] + [" ".join(rng.choice("abcdefghijkl") for _ in range(rng.randrange(1, 40))) for _ in range(200)]
    got = {r.t: r.x for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.is_repetitive("t").alias("x")).collect()}
    assert got == {t: plain(t) for t in texts}
    long = " ".join(f"w{k % 700}" for k in range(20_000))
    assert one(spark, long, lambda c: T.top_ngram(T.words(c), 2)) == max(29, 20_000 // 700)


def test_mentions_and_repetition(spark):
    text = "@a hi @b , @c: x"
    assert [one(spark, text, lambda c, n=n: T.trim_mentions(c, n)) for n in (-1, 0, 1, 9)] == [text, "hi, : x", "@a hi, : x", "@a hi @b, @c: x"]
    assert one(spark, "ha ha ha ha soooooooo", T.soften_repetition) == "ha ha sooo"


@pytest.mark.parametrize(("text", "want"), [
    (None, ""), ("<|bos|><|spk:kim|> hi <|eos|>x", "hi"), ("kim: hi\nkim: again", "hi"), ("hi\n lee_k] yo", "hi"), ("[kim] : {Lee K} : hi", "hi"), ("<SPK_kim>: hi\n SPK kim x", "hi"),
    ("<B> hi <U> no", "hi"), ("<U>hi", "hi"), ("kimono\nkimono", "kimono\nkimono"), ("hi<|spk:other|>x", "hi"), ("hi 【kim】", "hi 【kim】"), ("hi\n《kim》x", "hi"),
])
def test_reply_text(spark, text, want):
    assert one(spark, text, lambda c: turns.reply_text(c, ("kim", "lee_k"), lines=True)) == want


def test_speakers_and_stages(spark):
    user, bot = turns.speakers_of(F.lit(None).cast("string"), F.lit("nobody"), ("a", "b", "c"), user="c", bot="b")
    assert tuple(spark.range(1).select(user, bot).first()) == ("c", "b")
    user, bot = turns.speakers_of(F.lit(" b "), F.lit(""), ("a", "b"))
    assert tuple(spark.range(1).select(user, bot).first()) == ("b", "a")
    with pytest.raises(ValueError, match="no speakers"):
        turns.speakers_of(F.lit(""), F.lit(""), ())


def test_speaker_tokens_anywhere(spark):
    texts = ["<|bos|><|spk:a|> hi <|spk:b c|>there<|spk:|> <|eos|>", "<|spk:x|><|eos|> <|pad|>user: you", "a <|spk:q|>", None]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in frame.select(turns.strip_speaker("t", ("user",))).collect()] == ["hi there<|spk:|> <|eos|>", "you", "a ", ""]


def test_snapshots_files_and_inline(spark, tmp_path):
    text = "2024년 5월 1일 수요일\n[Alice] [오전 9:05] hello\ncontinued\n2024년 13월 1일\n[Bob] [오후 12:10] hi\n"
    rows = chat.snapshots(spark.createDataFrame([("s", text)], "source_file string, text string")).orderBy("seq").collect()
    assert [(str(r.day), r.ampm, r.hm, r.speaker, r.text) for r in rows] == [("2024-05-01", "오전", "9:05", "Alice", "hello\ncontinued"), ("None", "오후", "12:10", "Bob", "hi")]
    assert rows[0].uid != rows[1].uid and len(rows[0].uid) == 40
    for name, data in (("b.txt", "﻿가".encode()), ("a.txt", "가".encode("cp949")), ("c.txt", "plain".encode())):
        (tmp_path / name).write_bytes(data)
    got = chat.files(spark, str(tmp_path / "*.txt")).collect()
    assert {r.source_file: r.text for r in got} == {"a.txt": "가", "b.txt": "가", "c.txt": "plain"}
    with pytest.raises(Exception, match="no file matches|PATH_NOT_FOUND"):
        chat.files(spark, str(tmp_path / "*.none"))
    assert [tuple(x) for x in one(spark, "alice:hi||bob:hello: again", chat.inline)] == [("alice", "hi"), ("bob", "hello: again")]


def test_room_stream(spark, tmp_path):
    """Two snapshots: the first fills the memory, the second gives limited replies."""
    schema = "room string, seq bigint, uid string, at double, wants_reply boolean"
    source = tmp_path / "in"
    first = [("r", 1, "a", 0.0, True), ("r", 2, "b", 1.0, True)]
    second = [("r", 3, "b", 10.0, True), ("r", 4, "c", 20.0, True), ("r", 5, "d", 21.0, True), ("r", 6, "e", 60.0, True), ("r", 7, "f", 61.0, False)]
    for rows in (first, second):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(schema).parquet(str(source))
        out = streams.run_available(bridge.actions(stream, per_batch=3), str(tmp_path / "out"), str(tmp_path / "state"))
    assert {r.uid: r.action for r in out.collect()} == {"a": "context", "b": "context", "c": "reply", "d": "limited", "e": "reply", "f": "context"}


def test_rate_limit_and_memory(spark):
    rng = random.Random(2)
    rows = [("r", k, float(t), str(rng.randrange(160))) for k, t in enumerate(sorted(rng.randrange(9000) for _ in range(400)))]
    frame = spark.createDataFrame(rows, "room string, seq bigint, at double, uid string")
    sends, want = [], {}
    for _, k, at, _ in rows:
        sends = [x for x in sends if at - x < 3600]
        want[k] = len(sends) < 5 and (not sends or at - sends[-1] >= 12)
        sends += [at] if want[k] else []
    assert {r.seq: r.sent for r in streams.rate_limited(frame, "room", per_hour=5).collect()} == want
    seen, kept = [], []
    for _, k, _, uid in rows:
        if uid not in seen:
            kept.append(k)
            seen = [*seen, uid][-100:]
    assert sorted(r.seq for r in streams.bounded_seen(frame, "room", "uid", 100).collect()) == kept


def test_poll(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "in"))
    seen = []
    n = streams.poll(spark.readStream.schema("id bigint").parquet(str(tmp_path / "in")), lambda rows, k: seen.append(rows.count()), str(tmp_path / "state"), every=0.3, stop=lambda: bool(seen))
    assert n == 1 and seen == [3]


def test_cascade_of_nothing_and_options(spark):
    rows = spark.createDataFrame([(1, None), (2, "@a @b @c hello there"), (3, "ok")], "k int, text string")
    assert {r.k: r.reason for r in messages.cascade(rows).collect()} == {1: "empty_after_clean", 2: "mention_artifact", 3: "low_signal"}
    got = {r.k: (r.text, r.reason) for r in messages.cascade(rows, without_mentions=True, checks=("short_message",)).collect()}
    assert got == {1: ("", "short_message"), 2: ("hello there", None), 3: ("ok", None)}


def test_layers():
    assert config.stacked([config.layer_of({"a": {"x": 1}, "b": 2}), config.layer_of({"a": 3, "b": {"y": 4}})]) == {"a": 3, "b": {"y": 4}}
    assert config.stacked([config.layer_of({"a": {"x": 1}}), config.layer_of({"a": {}})]) == {"a": {"x": 1}}
    assert config.with_run_name("runs/{run_name}/x", "r1") == "runs/r1/x"
    assert [config.context_tokens(*x) for x in ((None, 100, 64), (10, 100, 64), (0, 100, 64))] == [64, 10, 64]


def test_workers_without_the_package(tmp_path):
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = f"""
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
from palaver.plans import further, more, registry
for name in ("self_echo", "encode_decode", "rate_limited_sends", "context_example_ids"):
    assert registry.QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
print("all ran")
"""
    (tmp_path / "driver.py").write_text(script)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    said = subprocess.run([sys.executable, str(tmp_path / "driver.py")], cwd=tmp_path, capture_output=True, text=True, env=env, timeout=300)
    assert "all ran" in said.stdout, said.stderr[-2000:]


def test_white_space_of_patterns_and_trims(spark):
    same = [c for c in map(chr, range(0x10000)) if not 0xD800 <= ord(c) < 0xE000]
    assert {c for c in same if re.match(T.WS, c)} == set(T.WS_CHARS)
    texts = ["", " ", "　a b\x85", "\r\n\r\ra\r", "a​​ b\x0b", "\xa0 x ", "a\x1c\n", None, "x" * 9 + " \t" * 9 + "y", "a\n\n\n\n​\nb"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.orderBy("i").select(T.strip(T.text_of("t")), T.line_feeds(T.text_of("t")), T.compact("t"), T.truncate("t", 12), T.clean_message("t")).collect()
    for text, row in zip(texts, got):
        text = text or ""
        feeds = re.sub("\r\n?", "\n", text)
        cut = text[:12].rstrip(T.WS_CHARS) if len(text) > 12 else text
        cleaned = re.sub("\n{3,}", "\n\n", feeds.strip(T.WS_CHARS).replace("​", ""))
        assert list(row) == [text.strip(T.WS_CHARS), feeds, re.sub(T.WS, "", text), cut, cleaned]


def test_seeds_and_runs(spark):
    rows = spark.createDataFrame([("r", i, s) for i, s in enumerate(["a", "b", "bot", "x", "bot", "x"])] + [("s", 0, "bot"), ("s", 1, None)], "room string, seq int, who string")
    slots = lambda **k: {(r.room, r.seq): r.slot for r in rooms.seeds(rows, "room", "seq", "who", ignore=("x",), bot="bot", **k).collect()}
    assert slots(last=5) == {("r", 1): "reply", ("r", 2): "bot", ("r", 4): "bot", ("s", 0): "bot", ("s", 1): "reply"}
    assert slots(last=1) == {("s", 1): "reply"} and slots(last=0) == {}
    assert set(slots(reply=False).values()) == {"user", "bot"}
    runs = spark.createDataFrame([("g", "a", 1, "p"), ("g", "b_cpt", 2, "q"), ("g", "b", 3, None), ("g", "c", 4, "s"), ("g", "d", 9, "")], "g string, run string, modified int, adapter string")
    served = lambda name: rooms.run_to_serve(runs, "g", F.lit(name)).first().run
    assert [served(n) for n in ("a", "b", "b_cpt", "none")] == ["a", "b_cpt", "b_cpt", "c"]


def test_fallback_text(spark):
    df = spark.range(3000).select(replies.fallback_text(F.col("id").cast("string"), ("x", "y", "z")).alias("t"), replies.fallback_text("id", ()).alias("none"))
    counts = {r.t: r["count"] for r in df.groupBy("t").count().collect()}
    assert set(counts) == {"x", "y", "z"} and min(counts.values()) > 850
    assert df.where("none is not null").count() == 0
