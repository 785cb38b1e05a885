"""One-permutation MinHash fingerprints, in DataFrame functions only.

The hashes of a text's word shingles are binned once by their top bits; a bin keeps its smallest
hash.  An empty bin takes over the value of another one by optimal densification: every bin has its own
pseudo-random order of all bins, by a hash of bin and attempt, and probes them until one has a value.  The lowest bits of every bin, packed as
hexadecimal digits, are the fingerprint.  Two fingerprints agree by chance in a share of 2^-bits of
the bins; the likeness corrects that bias and lies between 0 and 1.

Binning uses one sort: a sentinel for every bin, larger than all its hashes, is sorted among them,
and the first entry of each bin is kept, which gives exactly one entry a bin.

Null and empty texts have no shingles; their fingerprint is all ones, like only to its equals.  A text
of fewer words than a shingle is one shingle; a text of any length is read whole.  Equal texts have equal
fingerprints, so repeated rows do.  Ids may be any numbers, hashes included; an empty table gives no rows; other
columns aren't read by `digest`, and `fingerprints` replaces a column of the name it gives.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palaver.llm.common import cut, partitions

BINS, BITS, WORDS = 128, 8, 5
#: Bounds of blocks are searched in arrays of about so many.
GRID = 512
LOW = (1 << 56) - 1
TRIES = 6


def let(value: Column, body) -> Column:
    """`body(value)` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _probes() -> Column:
    """For every bin in turn, all bins in an order of its own: by a hash of the bin and the attempt."""
    rows = []
    for j in range(BINS):
        weight = {k: hashlib.blake2b(f"{j}/{k}".encode(), digest_size=8).digest() for k in range(BINS)}
        rows += sorted(weight, key=weight.get)
    # a literal once the plan is folded
    return F.split(F.lit(",".join(map(str, rows))), ",").cast("array<int>")


def shingle_hashes(text: Column, n: int = WORDS) -> Column:
    words = F.array_remove(F.split(F.lower(text), r"\s+"), "")

    def of(w: Column) -> Column:
        runs = F.transform(F.slice(w, 1, F.greatest(F.size(w) - (n - 1), F.lit(0))), lambda x, i: F.xxhash64(x, *(F.get(w, i + k) for k in range(1, n))))
        return F.when(F.size(w) >= n, runs).when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<bigint>"))

    return let(words, of)


def codes(text: Column, n: int = WORDS) -> Column:
    """The fingerprint as an array of BINS numbers below 2^BITS."""
    sentinels = F.array(*(F.lit((k << 56) | LOW) for k in range(BINS)))
    placed = F.sort_array(F.concat(F.transform(shingle_hashes(text, n), lambda h: F.shiftrightunsigned(h, 1)), sentinels))
    bin_of = lambda x: F.shiftright(x, 56)
    smallest = let(placed, lambda s: F.filter(s, lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(s, i - 1)))))
    known = lambda x: F.when(x.bitwiseAND(F.lit(LOW)) != F.lit(LOW), x)

    def fill(dense: Column) -> Column:
        probes = _probes()

        def one(x: Column, j: Column) -> Column:
            asked = lambda t: known(F.get(dense, F.get(probes, j * BINS + t)))
            rest = F.filter(F.transform(F.sequence(F.lit(TRIES), F.lit(BINS - 1)), asked), lambda y: y.isNotNull())
            return F.coalesce(known(x), *(asked(F.lit(t)) for t in range(TRIES)), F.get(rest, F.lit(0)), x).bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")

        return F.transform(dense, one)

    return let(smallest, fill)


def packed(code: Column) -> Column:
    """The codes as a string of two hexadecimal digits each."""
    digits = F.array(*(F.lit(f"{k:02x}") for k in range(1 << BITS)))
    return F.array_join(F.transform(code, lambda c: F.get(digits, c)), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two texts' shingle sets, from their codes."""
    chance = 1 / (1 << BITS)
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)) / F.lit(float(BINS))
    return F.greatest(F.lit(0.0), (same - F.lit(chance)) / F.lit(1 - chance))


def fingerprints(docs: DataFrame, *, text_col: str = "text", into: str = "fingerprint", n: int = WORDS) -> DataFrame:
    """The documents with their fingerprint."""
    return docs.withColumn(into, packed(codes(F.coalesce(F.col(text_col), F.lit("")), n)))


def _blocks(docs: DataFrame, id_col: str, rows: int) -> list:
    """The first ids, ascending, of blocks of about `rows` documents and of at most about GRID * GRID blocks; null is in the first."""
    ids = docs.select(F.col(id_col).alias("_id"))
    parts = partitions(docs.sparkSession)
    laid = cut(ids.repartitionByRange(parts, "_id").sortWithinPartitions("_id").withColumn("_at", F.monotonically_increasing_id()))
    step = max(rows, -(-laid.count() // (GRID * GRID)))
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return [r[0] for r in laid.where((place % step == 0) & F.col("_id").isNotNull()).select("_id").distinct().orderBy("_id").collect()]


def _block_of(docs: DataFrame, id_col: str, firsts: list) -> DataFrame:
    """With `_block`, the number of the block that holds the id, and `_head`, whether the id is the block's first.

    The search has two steps, each over an array of at most GRID ids or a few more: which run of blocks, then which of its blocks.
    """
    key, run = F.col(id_col), max(1, -(-len(firsts) // GRID))
    runs = [firsts[a : a + run] for a in range(0, len(firsts), run)]
    upto = lambda ids: F.greatest(F.size(F.filter(ids, lambda x: x <= key)) - 1, F.lit(0))
    kind = docs.schema[id_col].dataType.simpleString()
    starts = F.split(F.lit(",".join(str(r[0]) for r in runs)), ",").cast(f"array<{kind}>")
    table = docs.sparkSession.createDataFrame(list(enumerate(runs)), f"_run int, _ids array<{kind}>")
    # null compares with nothing: block 0
    placed = docs.withColumn("_run", F.when(key.isNull(), 0).otherwise(upto(starts))).join(F.broadcast(table), "_run")
    placed = placed.withColumn("_in", F.when(key.isNull(), 0).otherwise(upto(F.col("_ids"))))
    head = key.eqNullSafe(F.get("_ids", F.col("_in"))) | key.isNull()
    return placed.withColumns({"_block": (F.col("_run") * run + F.col("_in")).cast("bigint"), "_head": head}).drop("_run", "_in", "_ids")


def with_next(docs: DataFrame, id_col: str, text_col: str, rows: int = 512) -> DataFrame:
    """The documents (id and text) with `_codes`, and `next_text` and `next_codes` of the one next in ascending order; the last has the first's.

    The texts are shuffled once, by blocks of neighbouring ids; a block also gets a copy of the first document of
    the block after it.  Rows of one id are in the order of their texts, null ids come first.
    """
    docs = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    firsts = _blocks(docs, "_id", rows)
    if not firsts:
        firsts = [0]
    own = _block_of(docs, "_id", firsts)
    last = len(firsts) - 1
    tails = own.where("_head").withColumn("_block", F.when(F.col("_block") == 0, last).otherwise(F.col("_block") - 1))
    both = own.withColumn("_tail", F.lit(False)).unionByName(tails.withColumn("_tail", F.lit(True))).drop("_head")
    both = both.repartition(partitions(docs.sparkSession), "_block").withColumn("_codes", codes(F.col("_text")))
    window = Window.partitionBy("_block").orderBy("_tail", "_id", "_text")
    out = both.withColumns({"next_text": F.lead("_text").over(window), "next_codes": F.lead("_codes").over(window)}).where(~F.col("_tail"))
    return out.drop("_block", "_tail").withColumnsRenamed({"_id": id_col, "_text": text_col})


def digest(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: its fingerprint, that of its edited text, and likenesses."""
    rows = with_next(docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("text")), id_col, "text").withColumnRenamed("_codes", "codes")
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    rows = rows.select(id_col, n.cast("bigint").alias("n_chars"), "codes", "next_codes", F.concat(F.col("text").substr(F.lit(1), n - cut), F.col("next_text").substr(F.lit(1), cut)).alias("edited"))
    rows = rows.withColumn("edited_codes", codes(F.col("edited")))
    return rows.select(
        id_col, "n_chars", F.sha2("edited", 256).alias("edited_sha256"), packed(F.col("codes")).alias("fingerprint"), packed(F.col("edited_codes")).alias("edited_fingerprint"),
        likeness(F.col("codes"), F.col("edited_codes")).alias("near_edited"), likeness(F.col("codes"), F.col("next_codes")).alias("near_next"),
    )
