"""The registered queries and their operators against brute force, on the small tables and on edge cases."""

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import brute

FOLDER = "/root/testdata/sf0.001"
ODD = [(0, None), (1, ""), (2, " \n"), (3, "one"), (4, "one"), (5, "Ünï çode 𝔘 x"), (7, "a b c d"), (8, "A B c d"), (9, "a b c d e"), (12, "x" * 5000), (13, "w " * 4000), (14, None), (20, "a b c d e f g h i j k l m n o p"), (21, "a b c d e f g h i j k l m n o p q"), (22, "z a b c d e f g h i j k l m n o p q")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def odd(spark, extra=""):
    return spark.createDataFrame(ODD, "doc_id bigint, text string")


def pairs(df):
    return [(r[0], r[1]) for r in df.select("doc_id", "text").collect()]


def tables(spark, docs):
    none = odd(spark).limit(0)
    clash = odd(spark).selectExpr("doc_id", "text", "1 as n", "'x' as token", "'y' as id", "2 as hits", "3 as shard")
    return {"small": docs, "odd": odd(spark), "empty": none, "clash": clash}


@pytest.mark.parametrize("which", ["small", "odd", "empty", "clash"])
def test_contamination(spark, docs, which):
    from palaver.llm import decontaminate

    table = tables(spark, docs)[which]
    items = [(r[0], r[1]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    if which != "small":
        items = [(7, "b c d"), (8, None), (9, "a b c d e f g h i j k l m n o"), (10, "Ünï çODE"), (11, ""), (70, "B, c; d")]
    frame = spark.createDataFrame(items, "item_id bigint, text string")
    want = brute.contamination(pairs(table), items)
    rows = table
    got = {r[0]: tuple(r)[1:6] for r in decontaminate.digest(decontaminate.scan(rows.select("doc_id", "text"), frame)).collect()}
    assert got == want
    blocks = {r[0]: tuple(r)[1:6] for r in decontaminate.digest(decontaminate.scan(rows, frame, item_bytes=40)).collect()} if which == "odd" else want
    assert blocks == want
    kept = decontaminate.remove(rows, frame)
    assert kept.columns == rows.columns and {r.doc_id for r in kept.collect()} == {k for k, v in want.items() if not v[4]}
    if which == "odd":
        cutout = {r.doc_id: r.text for r in decontaminate.remove(rows, frame, mode="spans").collect()}
        assert cutout[7] == "a " and cutout[5] == " 𝔘 x" and cutout[13] == "w " * 4000


@pytest.mark.parametrize("which", ["small", "odd", "empty", "clash"])
def test_secrets(spark, docs, which):
    from palaver.llm import secrets

    table, names = tables(spark, docs)[which], ("assign", "access", "hex")
    text = dict(pairs(table))
    for r in secrets.digest(table).collect():
        want = brute.secrets(text[r.doc_id])
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == x for _, x, _ in want) for k in range(3)]
        line = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in want)
        assert r.base_sha256 == brute.sha(line)
        assert set(filter(None, line.split(","))) <= set(r.spans.split(","))


def test_secret_scanner_random():
    import pyarrow as pa

    from palaver.llm.kernel import string_bytes
    from palaver.llm.secrets import Scanner, _points

    scanner, rng = Scanner(), random.Random(5)
    parts = ["token", "secret", "api_key", "apikey", "passwd", "PASSWORD", "=", ":", " ", "'", '"', "AKIA", "ABCDEFGHIJ0123456789", "deadbeef", "0123456789abcdef", "x", "é", "-", "\n", ",", "secre", "a1b2c3d4e5f6", "_.", "T", "AK", "ghp_", "eyJ"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(3000)] + ["a" * 300_000 + "0123456789abcdef" * 3]
    data, off = string_bytes(pa.array(texts))
    found = scanner.scan(data, off)
    for i, text in enumerate(texts):
        got = [x for x in _points(data[off[i] : off[i + 1]], found.get(i, [])) if x[1] < 3]
        assert got == brute.secrets(text)


def test_redact(spark):
    from palaver.llm import secrets

    rows = [(1, 'é token="abcdefghijklmnop" end'), (2, None), (3, "clean"), (4, "0123456789abcdef0123"), (5, "secret=0123456789abcdef!")]
    got = dict(secrets.redact(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert got == {1: 'é <assign>" end', 2: None, 3: "clean", 4: "<hex>", 5: "<assign>!"}


def test_redact_many_secrets_in_one_text(spark):
    """Linear in the number of secrets: sixteen times as many take far less than 16 squared times as long."""
    import time

    from palaver.llm import secrets

    took = []
    for n in (1_000, 16_000):
        text = "".join(f"word {k} token=abcdefghijkl{k:06d} " for k in range(n))
        frame = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
        began = time.time()
        got = secrets.redact(frame).first().text
        took.append(time.time() - began)
        assert got.count("<assign>") == n and "abcdefghijkl" not in got and got.startswith("word 0 ")
    assert took[1] < 30 * max(took[0], 0.5)


@pytest.mark.parametrize("which", ["small", "odd", "empty", "clash"])
def test_fingerprints(spark, docs, which):
    from palaver.llm import fingerprint

    table = tables(spark, docs)[which]
    rows = sorted((k, t or "") for k, t in pairs(table))
    text, want, after = dict(rows), brute.edited(rows), dict(zip([k for k, _ in rows], rows[1:] + rows[:1]))
    got = {r.doc_id: r for r in fingerprint.digest(table).collect()}
    assert got.keys() == text.keys()
    errors = []
    for k, r in got.items():
        assert r.n_chars == len(text[k]) and r.edited_sha256 == brute.sha(want[k])
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if text[k].split() and text[k].isascii():
            errors.append((r.near_edited - brute.jaccard(text[k], want[k]), r.near_next - brute.jaccard(text[k], after[k][1])))
    by = defaultdict(set)
    for k, r in got.items():
        by[text[k]].add(r.fingerprint)
    assert all(len(x) == 1 for x in by.values())
    if which == "small":
        assert np.abs(np.array(errors)).mean() < 0.05 and np.abs(np.array(errors).mean(axis=0)).max() < 0.02


def test_fingerprint_plan_is_native(docs, spark, capsys):
    from palaver.llm import fingerprint, sharding

    for frame in (fingerprint.digest(docs), sharding.assign(docs)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("which", ["small", "odd", "empty", "clash"])
def test_sharding(spark, docs, which):
    from palaver.llm import sharding

    table = tables(spark, docs)[which]
    rows = pairs(table)
    got = {r.doc_id: r for r in sharding.assign(table).collect()}
    assert len(got) == len(rows)
    groups, slots, load = {}, defaultdict(list), Counter()
    for k, t in rows:
        r = got[k]
        assert r["size"] == len((t or "").encode()) + 1 and r.text_crc32 == brute.crc(t) and 0 <= r.shard < 16
        assert groups.setdefault(t or "", r.shard) == r.shard
        slots[r.shard].append(r.slot)
        load[r.shard] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    if rows:
        sizes, first = Counter(), {}
        for k, t in sorted(rows):
            first.setdefault(t or "", k)
            sizes[first[t or ""]] += len((t or "").encode()) + 1
        assert max(load.values()) == brute.minimax([sizes[k] for k in sorted(sizes)], 16)


@pytest.mark.parametrize("boundary", [None, 0, 13])
@pytest.mark.parametrize("which", ["small", "odd", "empty", "clash"])
def test_setjoin(spark, docs, which, boundary):
    from palaver.llm import setjoin

    table = tables(spark, docs)[which]
    got = {r[0]: (r[1], r[2]) for r in setjoin.link(table, boundary=boundary).collect()}
    assert got == brute.set_components(pairs(table))


@pytest.mark.parametrize("batch", [10_000, 7])
def test_setjoin_near_copies(spark, batch):
    from palaver.llm import setjoin

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    rng = random.Random(3)
    base = [f"w{rng.randrange(900)}" for _ in range(60)]
    rows = []
    for k in range(260):
        words = base[: rng.choice((5, 9, 14, 22, 60))]
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = f"v{rng.randrange(6)}"
        rows.append((k, " ".join(words + (["the same passage in many of them"] if k % 3 else []))))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = brute.set_components(rows)
    for options in ({}, {"boundary": 0}, {"boundary": 13}, {"split": 8, "block": 16}, {"boundary": 0, "split": 8, "block": 5, "most_bits": 8}):
        assert {r[0]: (r[1], r[2]) for r in setjoin.link(frame, **options).collect()} == want
    kept = {k for k, (_, c) in want.items() if k == c}
    for options in ({}, {"most_bits": 8}):
        assert {r[0] for r in setjoin.keep_one(frame, **options).select("doc_id").collect()} == kept


def test_setjoin_long_sets_of_unequal_sketches(spark):
    """Sketches of long sets differ in length where a power of two lies between their sizes."""
    from palaver.llm import setjoin

    words = [f"w{k}" for k in range(4600)]
    rows = [(size * 1000 + cut, " ".join(words[:size] if not cut else words[cut:size])) for size in (1000, 1100, 2000, 2200, 4000, 4500) for cut in (0, 60, 400)]
    rows.append((7, " ".join(words[:300] + words[900:3000])))
    lengths = {len(setjoin.sketch_of(s)) for s in setjoin.Sets(pa.array([r[1] for r in rows]), 4).each}
    assert len(lengths) > 2
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r[0]: (r[1], r[2]) for r in setjoin.link(frame).collect()} == brute.set_components(rows)


def test_setjoin_blocks_of_a_long_list(spark):
    """One list with members of other components throughout: pairs come from blocks, and only close ones."""
    from palaver.llm import setjoin

    passage = [f"p{k}" for k in range(60)]
    rng, rows = random.Random(8), []
    for k in range(400):
        own = [f"x{k}y{j}" for j in range(rng.randrange(0, 14))]
        rows.append((k, " ".join(passage[: rng.randrange(44, 61)] + own)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    want = brute.set_components(rows)
    for options in ({"split": 64, "block": 32}, {"frequent": 4, "split": 16, "block": 64}):
        assert {r[0]: (r[1], r[2]) for r in setjoin.link(frame, **options).collect()} == want


def test_setjoin_ids_that_repeat(spark):
    """An id in several texts is one document: it links what any of its texts links, and no row multiplies."""
    from palaver.llm import setjoin

    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    rows = [(1, a), (2, b), (5, a), (5, b), (6, a), (7, c), (7, None), (7, ""), (9, c), (9, c), (11, "alone one two three four"), (None, a), (None, None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = Counter(tuple(r) for r in setjoin.link(frame).select("doc_id", "n_shingles", "component_id").collect())
    n, group = {a: 57, b: 57, c: 57, None: 0, "": 0}, {1: 1, 2: 1, 5: 1, 6: 1, 7: 7, 9: 7, 11: 11, None: None}
    assert got == Counter((k, n.get(t, 2), group[k]) for k, t in rows)
    kept = Counter(r.doc_id for r in setjoin.keep_one(frame).collect())
    assert kept == Counter({1: 1, 7: 3, 11: 1, None: 2})


def test_setjoin_boundary_follows_counts():
    from palaver.llm.setjoin import boundary_of, subsets_of

    # few small sets among many large ones don't move it, long lists favour subsets
    assert boundary_of({}, 85, 1.0) == 0
    assert boundary_of({8: 100, 30: 100}, 85, 0.0) < 30
    assert boundary_of({8: 100, 30: 100}, 85, 11.0) >= boundary_of({8: 100, 30: 100}, 85, 0.0)
    assert boundary_of({8: 1}, 85, 11.0) >= 8 > 0 and subsets_of(8, 85) == sum((8, 1, 1))


def test_setjoin_order_of_frequent_shingles():
    from palaver.llm.setjoin import Order

    order = Order(np.array([50, 10, 40, 20, 30], np.uint64))
    assert order.rank.tolist() == [2, 4, 5, 3, 1]
    assert order.prefix(np.array([5, 10, 20, 30, 40, 50, 60], np.uint64), 5).tolist() == [5, 60, 50, 10, 40]


@pytest.mark.parametrize("which", ["small", "odd", "empty", "clash"])
def test_packing(spark, docs, which):
    import zlib

    import public_tokenizers
    from tokenizers import Tokenizer

    from palaver.llm import packing

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokens = Tokenizer.from_file(path)
    table = tables(spark, docs)[which]
    ids = {k: [*tokens.encode(t or "", add_special_tokens=False).ids, 2] for k, t in pairs(table)}
    got, room = packing.pack(table, path).collect(), 1024
    by, bins = defaultdict(list), defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
        bins[r.sequence_id].append((r.offset, r.length))
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes())
    assert by.keys() == ids.keys()
    for k, rows in by.items():
        rows.sort(key=lambda r: r.piece)
        assert [r.piece for r in rows] == list(range(len(rows))) and sum(r.length for r in rows) == len(ids[k])
        assert all(r.length == room for r in rows[1:]) and rows[0].length <= room
        assert [r.start for r in rows] == [sum(x.length for x in rows[:i]) for i in range(len(rows))]
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= room
    if got:
        assert len(bins) <= brute.bound([r.length for r in got], room) + 2


def test_packing_search_against_brute_force():
    from functools import cache

    from palaver.llm.packing import lower_bound, solve

    def best(lengths, room):
        @cache
        def go(left, free):
            if not left:
                return 0
            out = 99
            for i, bin_free in enumerate(free):
                if left[0] <= bin_free and bin_free not in free[:i]:
                    out = min(out, go(left[1:], tuple(sorted((*free[:i], bin_free - left[0], *free[i + 1 :])))))
            return min(out, 1 + go(left[1:], tuple(sorted((*free, room - left[0])))))

        return go(tuple(sorted(lengths, reverse=True)), ())

    rng = random.Random(2)
    for _ in range(60):
        lengths = [rng.randrange(1, 21) for _ in range(9)]
        counts = [lengths.count(s) for s in range(21)]
        found, _ = solve(counts, 20)
        assert lower_bound(counts, 20) <= best(lengths, 20) == sum(n for _, n in found)


def test_packing_search_of_long_fillings():
    from palaver.llm.packing import _best_fit, solve

    def counted(lengths, room):
        return [lengths.count(s) for s in range(room + 1)]

    def placed(patterns):
        return sorted(s for filling, times in patterns for s in filling * times)

    # 300 + 4 x 181 fills a sequence; best-fit decreasing takes 520
    lengths = [300] * 300 + [200] * 900 + [181] * 1200
    found, _ = solve(counted(lengths, 1024))
    assert placed(found) == sorted(lengths) and all(sum(filling) <= 1024 for filling, _ in found)
    assert sum(n for _, n in found) <= 480
    # sequences cut into five to seven pieces each, so that the best is known
    rng, better = random.Random(5), 0
    for _ in range(40):
        full = [sorted(rng.sample(range(1, 60), rng.randrange(4, 7))) for _ in range(6)]
        lengths = [b - a for cuts in full for a, b in zip([0, *cuts], [*cuts, 60], strict=True)]
        counts = counted(lengths, 60)
        found, least = solve(counts, 60)
        assert least
        assert placed(found) == sorted(lengths) and sum(n for _, n in found) == 6
        better += sum(n for _, n in _best_fit(counts, 60)) > 6
    assert better


def test_packing_beats_best_fit_on_documents():
    """The lengths of sf0.01's pieces: 962 sequences, as many as the bound, where best-fit decreasing takes 964."""
    import duckdb
    import public_tokenizers

    from palaver.llm.packing import Encoder, _best_fit, lower_bound, solve

    encode, counts = Encoder.of(public_tokenizers.path("byte_bpe_50k.json")), [0] * 1025
    for (text,) in duckdb.sql("SELECT text FROM '/root/testdata/sf0.01/documents.parquet'").fetchall():
        n = len(encode(text or "")) + 1
        counts[n % 1024 or 1024] += 1
        counts[1024] += (n - 1) // 1024
    found, least = solve(counts)
    assert least and sum(n for _, n in found) == lower_bound(counts, 1024) < sum(n for _, n in _best_fit(counts, 1024))


def test_encoder_special_tokens():
    import public_tokenizers
    from tokenizers import Tokenizer

    from palaver.llm.packing import Encoder

    path = public_tokenizers.path("byte_bpe_50k.json")
    encode, slow = Encoder.of(path), Tokenizer.from_file(path)
    for text in ("a <|endoftext|> b", "", "  　x", "don't  stop\n\n\n  x", "ΩΩΩ 日本 😀", "a" * 3000, " " * 2000):
        assert encode(text) == slow.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_warc(spark, tmp_path, compression):
    from pyspark.sql import functions as F

    from palaver.llm import warc

    long = "é" * 60
    rows = [(1, "http://a/", long), (2, "http://b/", long), (3, None, None), (4, "http://c/", ""), (5, "http://d/", "short"), (6, "http://d/", "short"), (7, "http://e/\r\nX: 1", "<p>\r\n\r\nWARC/1.1\r\n</p>" * 40), (8, "http://f/", "x" * 100_000), (9, "http://f/", long)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    path = str(tmp_path / "w")
    warc.register(spark)
    warc.records(pages).write.format("warc").option("compression", compression).mode("overwrite").save(path)
    want = brute.revisits([(k, t) for k, _, t in rows])
    cut = str(tmp_path / "cut")
    warc.records(pages).write.format("warc").option("compression", compression).option("split", "100").mode("overwrite").save(cut)
    for split, path in ((str(1 << 26), path), ("100", path), ("100", cut)):
        back = spark.read.format("warc").option("split", split).load(path)
        got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back.collect()}
        assert got == want and back.count() == len(rows)
    assert {r.page_id: r.payload for r in back.where("record_type = 'response'").collect()} == {k: t or "" for k, _, t in rows if want[k][2] == "response"}
    assert [r.refers_to for r in back.where((F.col("record_type") == "revisit") & F.col("page_id").isin(2, 5)).collect()] == [1]
    assert all(r.payload_sha256 == r.payload_digest for r in back.where("record_type = 'response'").collect())
    bare = spark.read.format("warc").option("payload", "false").load(path)
    assert bare.where("payload is not null").count() == 0
    assert spark.read.format("warc").option("split", "100").load(cut).rdd.getNumPartitions() >= 5
    warc.write(pages.limit(0), str(tmp_path / "none"))
    assert warc.read(spark, str(tmp_path / "none")).count() == 0


def test_warc_of_other_programs(spark, tmp_path):
    """Ordinary gzip members, one a record, plain headers and random record ids."""
    import gzip
    import hashlib

    from palaver.llm import warc

    bodies = [b"<p>one</p>", "\u00e9".encode() * 70_000, b"", b"\r\n\r\nWARC/1.0\r\n"]
    record = lambda k, body: f"WARC/1.0\r\nWARC-Type: {'warcinfo' if k == 2 else 'response'}\r\nWARC-Record-ID: <urn:uuid:0000-{k}>\r\nWARC-Target-URI: http://x/{k}\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(record(k, b)) for k, b in enumerate(bodies)))
    (tmp_path / "b.warc").write_bytes(b"".join(record(k, b) for k, b in enumerate(bodies)))
    for path in ("", "a.warc.gz", "b.warc"):
        back = warc.read(spark, str(tmp_path / path) if path else str(tmp_path))
        rows = back.collect()
        assert len(rows) == (8 if not path else 4)
        for r in rows:
            k = int(r.record_id[-2])
            assert (r.page_id, r.url, r.payload_bytes, r.payload_digest) == (None, f"http://x/{k}", len(bodies[k]), None)
            assert r.payload == bodies[k].decode() and r.payload_sha256 == hashlib.sha256(bodies[k]).hexdigest()
        assert back.where("record_type = 'warcinfo'").count() == len(rows) // 4


def test_words_longer_than_a_chunk():
    import pyarrow as pa

    from palaver.llm import kernel

    texts = ["b" * (3 * kernel.CHUNK + 7), "b" * (3 * kernel.CHUNK + 7) + " c", "b", "", None]
    words = kernel.Words(*kernel.string_bytes(pa.array(texts)))
    assert words.counts().tolist() == [1, 2, 1, 0, 0]
    assert words.hashes[0] == words.hashes[1] and words.hashes[0] != words.hashes[3]
