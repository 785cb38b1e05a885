"""Collocations: phrases of two to four words that occur more often than their parts make likely.

Texts fall into pieces at punctuation and line ends, pieces into words at blanks.  Equal pieces of a language become one
row with a multiplicity, so that repeated lines and whole copies are counted once with a weight.

Words and word pairs are hashed and summed first: each task adds up its own, sends the sums to the bucket of the hash as
packed arrays, and duckdb sums a bucket out of core, within MEMORY and a folder to spill to.  A hash that sums to less than
`least` rules its phrase out; the others become a filter of FILTER_BITS bits, whatever the input is.  A phrase
can reach `least` only if all its words and word pairs pass, so only such phrases are then counted, by their words and
not by hashes: again each task sums its own, and duckdb sums each bucket of phrases.  Hashes that meet, or a filter that
fills up, cost work and change no count.

A phrase's parts lie in other buckets than the phrase: every cut sends a request for each part to the part's bucket, and the
answers meet again at the phrase.  Requests for a part that very many phrases share are answered by broadcast.

Null and empty texts have no words; a null `lang` is `und`; texts of any length are read whole (a piece is held by one task);
repeated rows count as often as they are there; equal scores stand by count, then by the phrase's bytes; an empty table
gives no rows; other columns aren't read.
"""

from __future__ import annotations

import shutil
import tempfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.llm.common import Scratch, Shared, attach, delete, partitions, ranked
from palaver.llm.kernel import Q, mix, string_bytes

LEAST, MOST, LONGEST = 30, 2000, 4
#: Bytes of text that a task counts at a time, bits of the filter and its segments, what duckdb may hold.
CHUNK_BYTES, FILTER_BITS, SEGMENTS, MEMORY = 6 << 20, 1 << 27, 256, "200MB"
#: Sums that a task keeps until they are summed again and, if they are still more than half as many, handed on.
HELD = 1 << 21
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ\t", "abcdefghijklmnopqrstuvwxyz "
END = "[.,;:!?\\x0A-\\x0D]"


def pieces(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The distinct pieces of each language with their multiplicities."""
    folded = F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, LOWER)
    rows = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.explode(F.split(folded, END)).alias("piece"))
    return rows.select("lang", F.trim("piece").alias("piece")).where("piece <> ''").groupBy("lang", "piece").agg(F.count(F.lit(1)).alias("weight"))


def summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys and the sums of their weights."""
    if not len(keys):
        return keys, weights
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(weights[order], first)


class Chunk:
    """The words of some pieces as exact numbers: `word` is the same for the same word of the same language."""

    def __init__(self, table: pa.Table):
        data, off = string_bytes(table["piece"])
        inside = data != 0x20
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        edges = off[1:-1]
        begins[edges], ends[edges - 1] = inside[edges], inside[edges - 1]
        starts = np.flatnonzero(begins)
        sizes = np.flatnonzero(ends) + 1 - starts
        buffers = [None, pa.py_buffer(np.concatenate(([0], np.cumsum(sizes)))), pa.py_buffer(data[inside])]
        coded = pa.Array.from_buffers(pa.large_string(), len(starts), buffers).dictionary_encode()
        langs = table["lang"].combine_chunks().dictionary_encode()
        self.texts, self.langs = coded.dictionary, langs.dictionary
        first = np.searchsorted(starts, off)
        self.piece = np.repeat(np.arange(table.num_rows, dtype=np.int32), np.diff(first))
        self.lang = langs.indices.to_numpy()[self.piece]
        self.text = coded.indices.to_numpy()
        self.weight = table["weight"].to_numpy()[self.piece]
        self.range = max(1, len(self.texts) * len(self.langs))
        self.word = self.lang.astype(np.int64) * len(self.texts) + self.text
        self.pair = self.piece[1:] == self.piece[:-1]

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of each word and of each word and the next; equal in all tasks."""
        import pandas as pd

        texts, langs = (pd.util.hash_array(d.to_numpy(zero_copy_only=False), categorize=False) for d in (self.texts, self.langs))
        one = mix(texts[self.text] + mix(langs)[self.lang])
        return one, mix(one[:-1] * np.uint64(Q) + one[1:])

    def phrase(self, words: list[np.ndarray]) -> pa.Array:
        columns = [self.texts.take(pa.array(w % max(1, len(self.texts)))) for w in words]
        return pc.binary_join_element_wise(*columns, pa.scalar(" ", self.texts.type)) if len(columns) > 1 else columns[0]


def chunks(batches):
    """Batches put together to about CHUNK_BYTES of text."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column("piece").nbytes
        if size >= CHUNK_BYTES:
            yield Chunk(pa.Table.from_batches(held).combine_chunks())
            held, size = [], 0
    if size:
        yield Chunk(pa.Table.from_batches(held).combine_chunks())


def duck(rows: pa.RecordBatchReader, query: str, schema: pa.Schema):
    """Batches of a query over `rows`, by a duckdb of this task that spills to a folder of its own."""
    import duckdb

    folder = tempfile.mkdtemp(prefix="phrases-")
    try:
        with duckdb.connect(config={"memory_limit": MEMORY, "threads": 1, "temp_directory": folder, "preserve_insertion_order": False}) as con:
            con.register("rows", rows)
            for batch in con.sql(query).to_arrow_reader(1 << 16):
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(batch.columns, schema, strict=True)], schema=schema)
    finally:
        shutil.rmtree(folder, ignore_errors=True)


def places(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The segment of each key in the filter, and three places of it there, one below the other."""
    size = np.uint64(bits // SEGMENTS)
    a, b = mix(key), mix(key + np.uint64(Q))
    return (a >> np.uint64(56)).astype(np.int64) * SEGMENTS >> 8, np.stack([a % size, b % size, (b >> np.uint64(32)) % size])


class Filter:
    """Which hashes may be frequent: the segments of the bits, one below the other."""

    def __init__(self, bits: int, buckets: int, segments: dict[int, bytes]):
        self.bits, self.buckets = bits, buckets
        self.held = np.zeros((SEGMENTS, bits // SEGMENTS // 8), np.uint8)
        for k, data in segments.items():
            self.held[k] = np.frombuffer(data, np.uint8)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        bucket, local = bucketed(hashes, self.buckets)
        segment, at = places(bucket.astype(np.uint64) << np.uint64(32) | local, self.bits)
        found = np.ones(len(hashes), bool)
        for row in at:
            found &= (self.held[segment, row >> np.uint64(3)] >> (row & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return found


def bucketed(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each hash, and the 32 bits that tell hashes of a bucket apart."""
    return ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64), hashes & np.uint64(0xFFFFFFFF)


def may_be_frequent(rows: DataFrame, least: int, bits: int = FILTER_BITS) -> Filter:
    """The filter of the words and word pairs whose hashes sum to `least` or more."""
    n = partitions(rows.sparkSession)

    def hashed(batches):
        for chunk in chunks(batches):
            one, two = chunk.hashes()
            for hashes, weights in ((one, chunk.weight), (two[chunk.pair], chunk.weight[1:][chunk.pair])):
                keys, sums = summed(hashes, weights)
                bucket, local = bucketed(keys, n)
                order = np.argsort(bucket, kind="stable")
                cuts = np.searchsorted(bucket[order], np.arange(n + 1))
                local, sums = local[order].astype("<u4"), sums[order].astype("<i8")
                for k in np.flatnonzero(np.diff(cuts)):
                    part = slice(cuts[k], cuts[k + 1])
                    yield pa.RecordBatch.from_pydict({"bucket": pa.array([k], pa.int32()), "hashes": [local[part].tobytes()], "sums": [sums[part].tobytes()]})

    def frequent(batches):
        schema = pa.schema([("bucket", pa.int32()), ("hash", pa.uint32()), ("n", pa.int64())])

        def unpacked():
            for batch in batches:
                for bucket, hashes, sums in zip(*batch.columns, strict=True):
                    hashes, sums = np.frombuffer(hashes.as_buffer(), "<u4"), np.frombuffer(sums.as_buffer(), "<i8")
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(hashes), bucket.as_py(), np.int32)), pa.array(hashes), pa.array(sums)], schema=schema)

        query = f"SELECT bucket, hash FROM rows GROUP BY ALL HAVING sum(n) >= {least}"
        for found in duck(pa.RecordBatchReader.from_batches(schema, unpacked()), query, pa.schema([("bucket", pa.uint64()), ("hash", pa.uint64())])):
            bucket, local = (c.to_numpy() for c in found.columns)
            segment, at = places(bucket << np.uint64(32) | local, bits)
            order = np.argsort(segment, kind="stable")
            cuts = np.searchsorted(segment[order], np.arange(SEGMENTS + 1))
            for k in np.flatnonzero(np.diff(cuts)):
                own = at[:, order[cuts[k] : cuts[k + 1]]].ravel().astype("<u4").tobytes()
                yield pa.RecordBatch.from_pydict({"segment": pa.array([k], pa.int32()), "at": [own]})

    def joined(batches):
        own = {}
        for batch in batches:
            for segment, at in zip(*batch.columns, strict=True):
                bit = own.setdefault(segment.as_py(), np.zeros(bits // SEGMENTS, bool))
                bit[np.frombuffer(at.as_buffer(), "<u4")] = True
        for segment, bit in own.items():
            yield pa.RecordBatch.from_pydict({"segment": pa.array([segment], pa.int32()), "bits": [np.packbits(bit, bitorder="little").tobytes()]})

    found = rows.mapInArrow(hashed, "bucket int, hashes binary, sums binary").repartition(n, "bucket").mapInArrow(frequent, "segment int, at binary")
    # bits / 8 bytes in all, whatever the input
    segments = found.repartition(min(n, SEGMENTS), "segment").mapInArrow(joined, "segment int, bits binary").collect()
    return Filter(bits, n, {r.segment: bytes(r.bits) for r in segments})


def counts(rows: DataFrame, least: int, passes: Filter) -> DataFrame:
    """`lang`, `words` (their number), `phrase` and its count `f`, of all that occur `least` times; of 0 words, all word occurrences."""
    shared = Shared(rows.sparkSession, passes)
    schema = pa.schema([("lang", pa.string()), ("words", pa.int32()), ("phrase", pa.string()), ("f", pa.int64())])

    def found(c: Chunk):
        """Tables of the sums of a chunk's phrases that may be frequent, and of all its words."""
        one, two = (shared.value(h) for h in c.hashes())
        two &= c.pair & one[:-1] & one[1:]
        n = max(1, len(c.texts))

        def made(words, sums):
            lang = c.langs.take(pa.array(words[0] // n)).cast(pa.string())
            return pa.Table.from_arrays([lang, pa.array(np.full(len(sums), len(words), np.int32)), c.phrase(words).cast(pa.string()), pa.array(sums)], schema=schema)

        lang, every = summed(c.lang, c.weight)
        none = [pa.array(np.zeros(len(lang), np.int32)), pa.array([""] * len(lang), pa.string())]
        yield pa.Table.from_arrays([c.langs.take(pa.array(lang)).cast(pa.string()), *none, pa.array(every)], schema=schema)
        keys, sums = summed(c.word[one], c.weight[one])
        yield made([keys], sums)
        at = np.flatnonzero(two)
        pairs, which = np.unique(c.word[at] * c.range + c.word[at + 1], return_inverse=True)
        first, second = pairs // c.range, pairs % c.range
        own = np.full(len(c.word) + 2, -1)
        own[at] = which
        yield made([first, second], summed(which, c.weight[at])[1])
        at = at[own[at + 1] >= 0]
        keys, sums = summed(own[at] * c.range + c.word[at + 2], c.weight[at])
        yield made([first[keys // c.range], second[keys // c.range], keys % c.range], sums)
        at = at[own[at + 2] >= 0]
        keys, sums = summed(own[at] * len(pairs) + own[at + 2], c.weight[at])
        a, b = (keys // len(pairs), keys % len(pairs)) if len(pairs) else (keys, keys)
        yield made([first[a], second[a], first[b], second[b]], sums)

    def met(batches):
        held, size = [], 0

        def again():
            sums = pa.concat_tables(held).group_by(["lang", "words", "phrase"]).aggregate([("f", "sum")])
            return sums.select(["lang", "words", "phrase", "f_sum"]).rename_columns(schema.names)

        for c in chunks(batches):
            for sums in found(c):
                held.append(sums)
                size += sums.num_rows
            if size > HELD:
                held = [again()]
                if held[0].num_rows > HELD // 2:
                    yield from held[0].to_batches(1 << 16)
                    held = []
                size = sum(t.num_rows for t in held)
        if held:
            yield from again().to_batches(1 << 16)

    def whole(batches):
        query = f"SELECT lang, words, phrase, CAST(sum(f) AS BIGINT) FROM rows GROUP BY ALL HAVING sum(f) >= {least} OR words = 0"
        yield from duck(pa.RecordBatchReader.from_batches(schema, typed(batches, schema)), query, schema)

    kind = "lang string, words int, phrase string, f bigint"
    return rows.mapInArrow(met, kind).repartition(partitions(rows.sparkSession), "lang", "words", "phrase").mapInArrow(whole, kind)


def typed(batches, schema: pa.Schema):
    """The batches under a given schema."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(batch.columns, schema, strict=True)], schema=schema)


def collocations(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, most: int = MOST, scale: int = 2_000_000, within: tuple[int, int] = (80, 100)) -> DataFrame:
    """The first `most` phrases of each language by score.

    `a` is a phrase's count, `l` and `r` those of its parts at the cut of the lowest score floor(scale * a / (l + r)), and `n`
    the language's number of words.  A phrase goes if a longer one that holds it has at least within[0] / within[1] of its count.
    """
    scratch = Scratch(docs.sparkSession)
    rows = scratch.store(pieces(docs, text_col=text_col, lang_col=lang_col), "pieces")
    found = scratch.store(counts(rows, least, may_be_frequent(rows, least)), "counts")
    delete(docs.sparkSession, f"{scratch.folder}/pieces")
    own = found.where("words >= 2")
    big = "decimal(38,0)"

    words = F.split("phrase", " ")
    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    cuts = own.select("lang", "phrase", "f", "words", cut)
    part = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.slice(words, F.lit(1), F.col("k")).alias("w")), F.struct(F.lit(1).alias("side"), F.slice(words, F.col("k") + 1, F.col("words") - F.col("k")).alias("w"))))
    # a phrase has no tab, so its key is its own
    key = F.concat_ws("\t", "lang", F.array_join("part.w", " "))
    requests = cuts.select("lang", "phrase", "f", "k", part.alias("part")).select("lang", "phrase", "f", "k", "part.side", key.alias("key"))
    asked = requests.groupBy("key").agg(F.count(F.lit(1)).alias("_n"))
    table = found.where("words > 0").select(F.concat_ws("\t", "lang", "phrase").alias("key"), F.col("f").alias("answer")).join(asked, "key")
    answered = attach(requests, table, "key", ["answer"], requests.count(), F.col("phrase"))
    sides = [F.max(F.when((F.col("k") == k) & (F.col("side") == s), F.col("answer"))).alias(f"{'lr'[s]}{k}") for k in range(1, LONGEST) for s in (0, 1)]
    met = answered.groupBy("lang", "phrase", F.col("f").alias("a")).agg(*sides)

    def scored(k: int):
        both = F.col(f"l{k}").cast(big) + F.col(f"r{k}").cast(big)
        score = F.expr(f"CAST(a AS DECIMAL(19,0)) * {scale}BD div (CAST(l{k} AS DECIMAL(19,0)) + CAST(r{k} AS DECIMAL(19,0)))")
        return F.when(both.isNotNull(), F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))

    met = met.select("lang", "phrase", "a", F.least(*(scored(k) for k in range(1, LONGEST))).alias("_at"))
    spans = [(at, size) for size in range(2, LONGEST) for at in range(1, LONGEST - size + 2)]
    inner = F.explode(F.array(*(F.when(F.col("words") > size, F.when(F.col("words") >= at + size - 1, F.array_join(F.slice(words, at, size), " "))) for at, size in spans))).alias("phrase")
    longer = own.where("words > 2").select("lang", "f", inner).where("phrase IS NOT NULL").groupBy("lang", "phrase").agg(F.max("f").alias("_longer"))
    held = F.coalesce(F.col("_longer").cast(big) * within[1] >= F.col("a").cast(big) * within[0], F.lit(False))
    kept = met.join(longer, ["lang", "phrase"], "left").where(~held)
    kept = kept.select("lang", "phrase", "a", "_at.l", "_at.r", "_at.score", (-F.col("_at.score")).alias("_score"), (-F.col("a")).alias("_a"))
    best = ranked(kept, ["lang"], ["_score", "_a", "phrase"], "_rank", few=False).where(F.col("_rank") < most)
    totals = found.where("words = 0").select("lang", F.col("f").alias("n"))
    return best.join(totals, "lang").select("lang", (F.col("_rank") + 1).alias("rank"), "phrase", "a", "l", "r", "n", "score")
