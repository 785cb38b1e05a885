"""Benchmark decontamination by a broadcast set of normalised n-grams.

Words are maximal runs of digits, ASCII letters and non-ASCII characters, A-Z folded.  Every run of
`n` words of a test item is a window; an item of fewer words is one window.  A document word inside
an occurrence of a window is hit.  Candidates come from 64-bit window hashes and each is verified
on its words.

Edge cases: null and empty texts have no words and are never contaminated; texts of any length are read
whole; rows that repeat are judged one by one; items of equal windows are all found; an empty item table hits
nothing; an empty document table gives no rows; columns of the documents are kept as they are, but one that is
named as the result (`into`) is replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.llm.common import Shared, cut
from palaver.llm.kernel import Q, Words, mix, slices, string_bytes

#: Text bytes of test items that one broadcast index may come from; more items take more passes.
ITEM_BYTES = 16 << 20


class NgramIndex:
    """Windows of the test items in plain arrays: for each length, sorted hashes with the place of the window in the items' words.

    Windows of equal words stand together as one, with the list of their items.
    """

    def __init__(self, items: list[tuple[str, str]], n: int):
        words = Words(*string_bytes(pa.array([t for _, t in items], pa.string())))
        self.n, self.items = n, [i for i, _ in items]
        # the words of all items with one blank between two
        sizes = words.ends - words.starts
        self.text = words.texts(0, len(sizes))
        self.starts = np.concatenate(([0], np.cumsum(sizes + 1)))
        counts, self.tables, self.seen = words.counts(), {}, {}
        for size in sorted(set(np.minimum(counts[counts > 0], n).tolist())):
            own = np.flatnonzero(counts >= n) if size == n else np.flatnonzero(counts == size)
            made = counts[own] - size + 1
            which = np.repeat(own, made)
            at = words.first[which] + np.arange(len(which)) - np.repeat(np.cumsum(made) - made, made)
            value = np.zeros(len(at), np.uint64)
            for k in range(size):
                value = value * np.uint64(Q) + words.hashes[at + k]
            self.tables[size] = self._grouped(mix(value), at, which, size)
            self.seen[size] = np.zeros(1 << 22, bool)
            self.seen[size][self.tables[size][0] >> np.uint64(42)] = True

    def window(self, at: int, size: int) -> bytes:
        return self.text[self.starts[at] : self.starts[at + size] - 1]

    def _grouped(self, hashes, at, item, size):
        """Hash, place, and items of each distinct window, in order of hash."""
        order = np.lexsort((at, hashes))
        edges = np.flatnonzero(np.concatenate(([True], np.diff(hashes[order]) != 0)))
        keys, places, lists = [], [], []
        for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(order)], strict=True):
            own: dict[bytes, list] = {}
            for i in order[a:b].tolist():
                own.setdefault(self.window(int(at[i]), size), [int(at[i]), set()])[1].add(int(item[i]))
            for place, found in own.values():
                keys.append(int(hashes[order[a]])), places.append(place), lists.append(sorted(found))
        ends = np.concatenate(([0], np.cumsum([len(x) for x in lists], dtype=np.int64)))
        return np.array(keys, np.uint64), np.array(places, np.int64), ends, np.array([k for x in lists for k in x], np.int32)

    def find(self, words: Words) -> tuple[np.ndarray, dict[int, set[int]]]:
        """Which words are hit, and the items found in each text."""
        hit, items, rolled = np.zeros(len(words.hashes), bool), {}, words.hashes.copy()
        for size in range(1, max(self.tables, default=0) + 1):
            if size > 1:
                rolled = rolled[: max(0, len(words.hashes) - size + 1)]
                rolled = rolled * np.uint64(Q) + words.hashes[size - 1 : size - 1 + len(rolled)]
            if size not in self.tables:
                continue
            keys, places, ends, lists = self.tables[size]
            mixed = mix(rolled)
            at = np.flatnonzero(self.seen[size][mixed >> np.uint64(42)])
            first, last = np.searchsorted(keys, mixed[at]), np.searchsorted(keys, mixed[at], "right")
            doc = words.doc_of(at)
            known = (last > first) & (at + size <= words.first[doc + 1])
            for i, d, a, b in zip(at[known].tolist(), doc[known].tolist(), first[known].tolist(), last[known].tolist(), strict=True):
                own = words.texts(i, size)
                for k in range(a, b):  # more than one only where hashes coincide
                    if self.window(int(places[k]), size) == own:
                        hit[i : i + size] = True
                        items.setdefault(d, set()).update(lists[ends[k] : ends[k + 1]].tolist())
        return hit, items


def _blocks(items: DataFrame, item_col: str, text_col: str, limit: int):
    """The items in lists of at most `limit` text bytes (at least one item each)."""
    block, size = [], 0
    for row in items.select(F.col(item_col).cast("string"), F.coalesce(F.col(text_col), F.lit(""))).toLocalIterator():
        own = len(row[1].encode())
        if block and size + own > limit:
            yield block
            block, size = [], 0
        block.append((str(row[0]), row[1]))
        size += own
    yield block


RUNS = "array<struct<first:bigint,last:bigint,start:bigint,stop:bigint>>"
RESULT = f"struct<n_words:bigint,hits:{RUNS},items:array<string>>"


def scan(docs: DataFrame, items: DataFrame, *, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", n: int = 13, item_bytes: int = ITEM_BYTES, into: str = "contamination") -> DataFrame:
    """The documents with a struct `into`: `n_words`, `hits` (runs of hit words: first, end, and their bytes from, to), `items`.

    The index that is broadcast comes from at most `item_bytes` of item text.  A larger test set takes a pass for
    each block of items: the first one's rows are stored once, the other passes read that copy and give only the
    rows with hits, which are merged and joined to it.
    """
    session = docs.sparkSession
    blocks = _blocks(items, item_col, item_text, item_bytes)
    kept = docs.drop(into)
    index = Shared(session, NgramIndex(next(blocks), n))
    out = kept.mapInArrow(_scanner(index, text_col, into), kept.withColumn(into, F.lit(None).cast(RESULT)).schema)
    more = None
    for block in blocks:
        if more is None:
            out = cut(out.withColumn("_row", F.monotonically_increasing_id()))
        index = Shared(session, NgramIndex(block, n))
        rows = out.select("_row", F.col(text_col).alias("_text"))
        found = rows.mapInArrow(_scanner(index, "_text", "_found"), rows.withColumn("_found", F.lit(None).cast(RESULT)).schema)
        found = found.where(F.size("_found.hits") > 0).select("_row", "_found.hits", "_found.items")
        more = found if more is None else more.union(found)
    if more is None:
        return out
    each = cut(more).groupBy("_row").agg(F.flatten(F.collect_list("hits")).alias("_hits"), F.flatten(F.collect_list("items")).alias("_items"))
    hits = F.coalesce(_merged(F.concat(f"{into}.hits", F.coalesce("_hits", F.array().cast(RUNS)))), F.array().cast(RUNS))
    names = F.array_sort(F.array_distinct(F.concat(f"{into}.items", F.coalesce("_items", F.array().cast("array<string>")))))
    whole = F.struct(F.col(f"{into}.n_words").alias("n_words"), hits.alias("hits"), names.alias("items"))
    return out.join(each, "_row", "left").withColumn(into, whole).drop("_row", "_hits", "_items")


def _merged(runs):
    """Runs that overlap or touch as one."""

    def step(done, h):
        last = F.try_element_at(done, F.lit(-1))
        both = F.struct(last["first"].alias("first"), F.greatest(last["last"], h["last"]).alias("last"), last["start"].alias("start"), F.greatest(last["stop"], h["stop"]).alias("stop"))
        grown = F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(both))
        return F.when((F.size(done) > 0) & (last["last"] >= h["first"]), grown).otherwise(F.concat(done, F.array(h)))

    return F.aggregate(F.array_sort(runs), F.array().cast(RUNS), step)


def _scanner(index, text_col: str, into: str):
    run_type = pa.list_(pa.struct([(x, pa.int64()) for x in ("first", "last", "start", "stop")]))

    def run(batches):
        for whole in batches:
            for batch in slices(whole, text_col):
                data, at = string_bytes(batch.column(text_col))
                words = Words(data, at)
                hit, items = index.value.find(words)
                spans, known = [[] for _ in range(batch.num_rows)], [[] for _ in range(batch.num_rows)]
                for d, found in items.items():
                    base = int(words.first[d])
                    step = np.diff(np.concatenate(([False], hit[base : words.first[d + 1]], [False])).astype(np.int8))
                    for a, b in zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist(), strict=True):
                        spans[d].append({"first": a, "last": b, "start": int(words.starts[base + a] - at[d]), "stop": int(words.ends[base + b - 1] - at[d])})
                    known[d] = sorted({index.value.items[k] for k in found})
                new = pa.StructArray.from_arrays([pa.array(words.counts(), pa.int64()), pa.array(spans, run_type), pa.array(known, pa.list_(pa.string()))], names=["n_words", "hits", "items"])
                yield pa.RecordBatch.from_arrays([*batch.columns, new], names=[*batch.schema.names, into])

    return run


def n_hit(into: str = "contamination"):
    """Hit words of a scanned document."""
    return F.aggregate(f"{into}.hits", F.lit(0).cast("bigint"), lambda a, h: a + h["last"] - h["first"])


def contaminated(share: int = 20, into: str = "contamination"):
    """True when a `share`-th part of the words, at least, is hit."""
    return (n_hit(into) > 0) & (share * n_hit(into) >= F.col(f"{into}.n_words"))


def digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row a document with counts and the digest of the items found in it."""
    return scanned.select(
        id_col, "contamination.n_words", n_hit().alias("n_hit"), F.size("contamination.items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("contamination.items")), 256).alias("items_sha256"), contaminated().alias("contaminated"),
    )


def remove(docs: DataFrame, items: DataFrame, *, mode: str = "documents", text_col: str = "text", **options) -> DataFrame:
    """The documents without contaminated ones (`mode="documents"`) or with their hit spans cut out (`"spans"`)."""
    # columns under names of our own, as the documents may have one that scan() adds
    names = [f"_c{i}" for i in range(len(docs.columns))]
    columns, text_col = docs.columns, names[docs.columns.index(text_col)]
    scanned = scan(docs.toDF(*names), items, text_col=text_col, **options)
    if mode == "documents":
        return scanned.where(~contaminated()).select(*names).toDF(*columns)
    raw, hits = F.encode(F.coalesce(F.col(text_col), F.lit("")), "utf-8"), F.col("contamination.hits")
    upto = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(hits, i - 1)["stop"]).cast("int")
    kept = F.transform(hits, lambda h, i: F.decode(raw.substr(upto(i) + 1, (h["start"] - upto(i)).cast("int")), "utf-8"))
    rest = F.decode(raw.substr(F.element_at(hits, -1)["stop"].cast("int") + 1, F.length(raw)), "utf-8")
    left = F.when((F.size(hits) > 0) & contaminated(), F.concat(F.array_join(kept, ""), rest)).otherwise(F.col(text_col))
    return scanned.withColumn(text_col, left).select(*names).toDF(*columns)


def sha_of(items: list[str]) -> str:
    """The digest of a list of item ids, as `digest` has it."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
