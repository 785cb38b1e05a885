"""Collocations against plain Python and against the SQL."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np

from palaver.llm import phrases
from palaver.llm.oracles import PHRASES
from palaver.llm.queries import op12_phrases

FOLDER = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=30, most=2000):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 5):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        often, held = {p: a for p, a in f.items() if a >= least}, set()
        for p, a in often.items():
            for k in range(2, len(p)):
                held |= {p[i : i + k] for i in range(len(p) - k + 1) if 100 * a >= 80 * f[p[i : i + k]]}
        found = []
        for p, a in often.items():
            if len(p) > 1 and p not in held:
                score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:most], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_query(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("lang", "text").collect()
    got = rows_of(op12_phrases(spark, FOLDER))
    assert got == brute([tuple(r) for r in docs])
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    assert sorted(con.sql(f"SELECT lang, rank, phrase, a, l, r, n, score FROM ({PHRASES})").fetchall()) == got and got


def odd_rows(seed):
    rng = random.Random(seed)
    words = ["a", "B", "cé", "über", "中", "x y", "ÀB", "(q)", "'t", "😀"]
    rows = []
    for _ in range(400):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", " \t ", ".", ", ", "\n", "\x0b", "\r\n", " ; "]) for _ in range(rng.randrange(30)))
        rows.append((rng.choice(["en", "de", None, "und", "", "tab\tlang"]), text))
    return [*rows, (None, None), ("en", ""), ("en", " \t "), ("en", "..."), ("only", "one"), ("en", "a B a B " * 5_000), *[("de", "the same Line, again the same line")] * 90]


def test_odd_rows_and_ties(spark):
    rows = odd_rows(1)
    frame = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "lang string, text string, rank int, a int, phrase string")
    assert rows_of(phrases.collocations(frame)) == brute(rows)
    assert rows_of(phrases.collocations(frame, least=3, most=7)) == brute(rows, 3, 7)


def test_a_full_filter_changes_no_count(spark):
    rows = odd_rows(2)
    frame = spark.createDataFrame(rows, "lang string, text string")
    found = phrases.pieces(frame)
    want = sorted(tuple(r) for r in phrases.counts(found, 30, phrases.may_be_frequent(found, 30)).collect())
    small = phrases.may_be_frequent(found, 2, bits=2048)
    assert sorted(tuple(r) for r in phrases.counts(found, 30, small).collect()) == want
    small.held[:] = 255
    assert small(np.arange(1000, dtype=np.uint64) << np.uint64(33)).all()
    assert sorted(tuple(r) for r in phrases.counts(found, 30, small).collect()) == want


def test_empty(spark):
    assert rows_of(phrases.collocations(spark.createDataFrame([], "lang string, text string"))) == []
    assert rows_of(phrases.collocations(spark.createDataFrame([("en", "a b")], "lang string, text string"))) == []


def test_exact_beyond_64_bits(spark, monkeypatch):
    huge = 6 * 10**18

    def fixed(rows, least, passes):
        kind = "lang string, words int, phrase string, f bigint"
        return spark.createDataFrame([("en", 0, "", huge), ("en", 1, "a", huge + 1), ("en", 1, "b", huge), ("en", 2, "a b", huge - 7)], kind)

    monkeypatch.setattr(phrases, "counts", fixed)
    got = rows_of(phrases.collocations(spark.createDataFrame([("en", "a b")], "lang string, text string")))
    assert got == [("en", 1, "a b", huge - 7, huge + 1, huge, huge, 2_000_000 * (huge - 7) // (2 * huge + 1))]
