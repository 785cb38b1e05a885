"""Files of token ids: the code of ascending numbers, round trips, shares, predicates, odd tables."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from palaver.llm import idfiles
from palaver.llm.queries import op13_token_ids

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=900) | st.lists(st.integers(0, 40), max_size=900), st.data())
def test_code(values, data):
    values.sort()
    code = idfiles.EliasFano.of(np.array(values, np.uint64))
    assert code.select(0, len(values)).tolist() == values
    a = data.draw(st.integers(0, len(values)))
    b = data.draw(st.integers(a, len(values)))
    assert code.select(a, b).tolist() == values[a:b]
    x = data.draw(st.sampled_from(values) if values else st.just(3))
    assert code.before(x) == sum(v < x for v in values)


def test_space():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 2000, 50_000)).astype(np.uint64)
    code = idfiles.EliasFano.of(ends)
    bits = 8 * (code.low.nbytes + code.high.nbytes + code.places.nbytes) / len(ends)
    assert bits < np.log2(int(ends[-1]) / len(ends)) + 2.2


def expected(rows):
    """Rows of (doc_id, text), by tokenizers itself, in order of id."""
    from tokenizers import Tokenizer

    own, at, out = Tokenizer.from_file(PATH), 0, []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*own.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((key, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def digest(df):
    return [tuple(r) for r in df.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")).orderBy("start").collect()]


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = sorted((tuple(r) for r in op13_token_ids(spark, folder).collect()), key=lambda r: r[1])
    assert got == expected([(r.doc_id, r.text) for r in docs])


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    rng = np.random.default_rng(3)
    rows = [(int(k), " ".join(f"w{x}" for x in rng.integers(0, 99, int(rng.integers(0, 60))))) for k in rng.permutation(700) * 7 - 900]
    rows += [(-(2**63), "first"), (2**63 - 1, "last"), (10**12, None), (10**12 + 1, ""), (10**12 + 2, "word <|endoftext|> " * 20_000)]
    frame = spark.createDataFrame([(k, t, 1, 2) for k, t in rows], "doc_id bigint, text string, start int, ids int")
    path = str(tmp_path_factory.mktemp("ids"))
    idfiles.write_texts(frame, PATH, path, part_bytes=20_000)
    return rows, path


def test_round_trip_in_small_shares(spark, odd):
    rows, path = odd
    want = expected(rows)
    assert digest(idfiles.read(spark, path)) == want
    few = idfiles.read(spark, path, split=2_000)
    assert few.rdd.getNumPartitions() > 20
    assert digest(few) == want
    lean = idfiles.read(spark, path, ids=False).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens) for r in lean] == [w[:3] for w in want] and {r.ids for r in lean} == {None}


@pytest.mark.parametrize("where", ["doc_id = 10", "doc_id IN (10, 17, 18, -900)", "doc_id > 5 AND doc_id <= 200", "doc_id < -800 OR doc_id = 3", "doc_id IS NOT NULL AND doc_id >= 4000", "doc_id > 9223372036854775806", "doc_id = 5 AND doc_id = 12", "n_tokens > 50"])
def test_predicates(spark, odd, where):
    rows, path = odd
    got = digest(idfiles.read(spark, path, split=5_000).where(where))
    # a filter that can't be pushed down
    assert got == digest(idfiles.read(spark, path).where(where.replace("doc_id", "(doc_id + 0 * start)")))


def test_predicate_leaves_parts_out(odd):
    _, path = odd
    reader = idfiles.IdReader({"path": path})
    whole = len(reader.partitions())
    from pyspark.sql.datasource import EqualTo

    assert list(reader.pushFilters([EqualTo(("doc_id",), 10)])) == []
    assert len(reader.partitions()) == 1 < whole


def test_ids_that_repeat_and_null(spark, tmp_path):
    rows = [(None, "no id"), (None, None), (5, "b"), (5, "a"), (5, "a"), (4, "x y z")] + [(7, f"text {i % 40}") for i in range(300)]
    path = str(tmp_path)
    idfiles.write_texts(spark.createDataFrame(rows, "doc_id bigint, text string"), PATH, path)
    got = digest(idfiles.read(spark, path))
    want = expected(rows)
    assert [g[0] for g in got] == [w[0] for w in want]
    assert sorted((g[0] or -1, g[2], g[3]) for g in got) == sorted((w[0] or -1, w[2], w[3]) for w in want)
    assert [g[1] for g in got] == [0, *np.cumsum([g[2] for g in got])[:-1].tolist()]
    assert digest(idfiles.read(spark, path).where("doc_id IS NULL")) == [g for g in got if g[0] is None]


def test_empty_and_written_again(spark, tmp_path):
    path = str(tmp_path)
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id bigint, text string")
    idfiles.write_texts(rows, PATH, path)
    (tmp_path / "part-of-a-lost-attempt.ids").write_bytes(b"junk")
    idfiles.write_texts(rows, PATH, path)
    listed = {p["name"] for p in idfiles.read_list(path, idfiles.LIST)}
    assert {f.name for f in tmp_path.iterdir() if f.name.startswith("part-")} == listed
    assert len(digest(idfiles.read(spark, path))) == 2
    idfiles.write_texts(rows.limit(0), PATH, path)
    assert digest(idfiles.read(spark, path)) == [] and [f.name for f in tmp_path.iterdir()] == [idfiles.LIST]


def test_unsorted_rows_and_wide_ids(spark, tmp_path):
    def pack(*ids):
        return bytearray(np.array(ids, "<u4").tobytes())

    rows = spark.createDataFrame([(2, pack(70_000, 1)), (3, pack(5))], "doc_id bigint, ids binary").coalesce(1)
    idfiles.write(rows, str(tmp_path), width=4)
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in idfiles.read(spark, str(tmp_path)).orderBy("start").collect()] == [[70_000, 1], [5]]
    with pytest.raises(Exception, match="width"):
        idfiles.write(rows, str(tmp_path))
    with pytest.raises(Exception, match="sorted"):
        idfiles.write(rows.orderBy(F.desc("doc_id")).coalesce(1), str(tmp_path), width=4)
