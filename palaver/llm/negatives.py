"""Hard negatives of anchors: exact integer products, bit-plane by bit-plane, most significant first.

Components become integers floor(scale * x).  Rows are stored in blocks of bit-planes (two's complement): plane k of a block
has bit k of every component of its rows.  Anchors keep whole integers.  A product is the sum of the anchor's products
with the planes, so after the planes down to k a score is known up to what planes k - 1 to 0 can add: between
(2^k - 1) times the sum of the anchor's negative components and the same with its positive ones.  With every plane that
interval halves; a pair goes as soon as its interval can't reach the scores that are still looked for.  When few
pairs of a block are left, only those get the remaining planes.

First each anchor's positives, its best rows of the same label, are found, then for each positive the best rows of other
labels within a band of its score.  What is looked for are scores above the worst of the best found so far (by a task, and
before by a first look at a few blocks, which only sets these floors), so a task hands on few rows.  Anchors go through
all blocks in portions of at most PORTION bytes, which are broadcast; the driver holds one portion and its floors at a time.

Rows with a null id, label or vector, or a null or non-finite component, take no part.  A shorter vector counts as filled
up with zeros, an empty one has score 0 with all.  Equal scores stand by smaller id.  Rows are told apart by their
place, so a copy of an anchor, even of its id, is another row, and an anchor that is there twice is answered twice.  An
anchor without positives, or a positive without rows in its band, gives no rows; an empty table gives none.  Other columns
aren't read.  Products must stay below 2^53, otherwise an error says so.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palaver.llm.common import Scratch, Shared, partitions, ranked, settings

SCALE, POSITIVES, NEGATIVES, BAND = 256, 5, 3, (50, 95, 100)
#: Rows and components of a block; bytes of the anchors that go through the blocks at a time, and how many are multiplied at once.
BLOCK, COMPONENTS, PORTION, TILE = 2048, 1 << 22, 32 << 20, 256
#: One block of so many is looked at first; dense products end when one pair of so many is left.
FIRST_LOOK, SPARSE = 16, 16
BLOCKS = "block bigint, n int, dim int, bits int, ids binary, labels binary, anchors binary, planes binary"
LOWEST = -(2**62)


def _block(ids, labels, anchors, vectors) -> dict:
    """One block of quantised rows, padded to the longest vector."""
    n, dim = len(ids), max(1, max(map(len, vectors)))
    whole = np.zeros((dim, -(-n // 8) * 8), np.int64)
    for k, v in enumerate(vectors):
        whole[: len(v), k] = v
    top = max(int(whole.max()), ~int(whole.min()))
    bits = top.bit_length() + 1
    planes = np.packbits(whole[None] >> np.arange(bits)[:, None, None] & 1, axis=2, bitorder="little")
    packed = [np.array(x, t).tobytes() for x, t in ((ids, "<i8"), (labels, "<i8"), (anchors, np.uint8))]
    return {"n": n, "dim": dim, "bits": bits, "ids": packed[0], "labels": packed[1], "anchors": packed[2], "planes": planes.tobytes()}


def blocks(rows: DataFrame, anchor: Column, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | Column = "label", scale: float = SCALE) -> DataFrame:
    """The rows that take part, in blocks of bit-planes."""
    label = F.col(label_col) if isinstance(label_col, str) else label_col
    own = rows.select(F.col(id_col).cast("bigint").alias("id"), label.cast("bigint").alias("label"), F.col(vector_col).cast("array<double>").alias("v"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    schema = [("n", pa.int32()), ("dim", pa.int32()), ("bits", pa.int32()), *((k, pa.binary()) for k in ("ids", "labels", "anchors", "planes"))]

    def run(batches):
        held, size = ([], [], [], []), 0

        def flush():
            return pa.RecordBatch.from_pylist([_block(*held)], pa.schema(schema))

        for batch in batches:
            ids, labels, vectors, flags = batch.columns
            off = vectors.offsets.to_numpy()
            x = np.floor(vectors.values.to_numpy(zero_copy_only=False).astype(np.float64) * scale)
            with np.errstate(invalid="ignore"):
                wide = np.isfinite(x) & (np.abs(x) >= 2.0**31)
            bad = np.concatenate(([0], np.cumsum(~np.isfinite(x))))
            valid = ~np.asarray(pa.compute.is_null(vectors)) & ~np.asarray(pa.compute.is_null(ids)) & ~np.asarray(pa.compute.is_null(labels)) & (bad[off[1:]] == bad[off[:-1]])
            for k in np.flatnonzero(valid):
                v = slice(off[k], off[k + 1])
                if wide[v].any():
                    raise ValueError("a component times the scale needs more than 32 bits")
                for column, value in zip(held, (ids[k].as_py(), labels[k].as_py(), flags[k].as_py(), x[v].astype(np.int64)), strict=True):
                    column.append(value)
                size = max(size, v.stop - v.start)
                if len(held[0]) == BLOCK or len(held[0]) * size >= COMPONENTS:
                    yield flush()
                    held, size = ([], [], [], []), 0
        if held[0]:
            yield flush()

    made = own.mapInArrow(run, BLOCKS.removeprefix("block bigint, "))
    return made.select(F.monotonically_increasing_id().alias("block"), "*")


class Planes:
    """A block: ids, labels, and its bit-planes as matrices of 0 and 1."""

    def __init__(self, row):
        self.first, self.n, self.dim, self.bits = row["block"] << 16, row["n"], row["dim"], row["bits"]
        self.ids, self.labels = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8")
        self.anchors = np.frombuffer(row["anchors"], np.uint8).astype(bool)
        packed = np.frombuffer(row["planes"], np.uint8).reshape(self.bits, self.dim, -1)
        self.planes = np.unpackbits(packed, axis=2, bitorder="little")[:, :, : self.n]

    def whole(self, which) -> np.ndarray:
        """The integers of some rows, one row below the other."""
        weights = 1 << np.arange(self.bits, dtype=np.int64)
        weights[-1] = -weights[-1]
        return np.tensordot(weights, self.planes[:, :, which].astype(np.int64), 1).T


def anchors_of(stored: DataFrame) -> DataFrame:
    """The rows that are anchors: their place, id, label and integers."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = Planes(row)
                at = np.flatnonzero(block.anchors)
                values = [v.astype("<i4").tobytes() for v in block.whole(at)]
                yield pa.RecordBatch.from_pydict({"row": pa.array(at + block.first), "id": pa.array(block.ids[at]), "label": pa.array(block.labels[at]), "v": pa.array(values, pa.binary())})

    return stored.mapInArrow(run, "row bigint, id bigint, label bigint, v binary")


class Portion:
    """Some anchors by label: places, labels and integers."""

    def __init__(self, rows, bits: int):
        self.rows = np.array([r["row"] for r in rows], np.int64)
        self.labels = np.array([r["label"] for r in rows], np.int64)
        vectors = [np.frombuffer(r["v"], "<i4") for r in rows]
        self.values = np.zeros((len(rows), max(map(len, vectors))), np.int32)
        for k, v in enumerate(vectors):
            self.values[k, : len(v)] = v
        # no product, of whole rows or of planes, is larger
        size = int(np.abs(self.values.astype(np.int64)).sum(axis=1).max()) << (bits - 1)
        if size >= 1 << 53:
            raise ValueError("products need more than 53 bits: use a smaller scale")
        self.kind = np.float32 if size < 1 << 24 else np.float64


class Best:
    """The best scores of every slot so far, ties by smaller id, and the score that a newcomer must reach."""

    def __init__(self, slots: int, most: int, floor: np.ndarray):
        self.score, self.id = np.full((slots, most), LOWEST), np.zeros((slots, most), np.int64)
        self.floor = floor.copy()

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        touched = np.unique(slot)
        most = self.score.shape[1]
        slot = np.concatenate([slot, np.repeat(touched, most)])
        score = np.concatenate([score, self.score[touched].ravel()])
        ids = np.concatenate([ids, self.id[touched].ravel()])
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        first = np.flatnonzero(np.concatenate(([True], slot[1:] != slot[:-1])))
        rank = np.arange(len(slot)) - np.repeat(first, np.diff(np.append(first, len(slot))))
        keep = rank < most
        self.score[slot[keep], rank[keep]], self.id[slot[keep], rank[keep]] = score[keep], ids[keep]
        self.floor[touched] = np.maximum(self.floor[touched], self.score[touched, -1])

    def batch(self, bands: int) -> pa.RecordBatch:
        slot, rank = np.nonzero(self.score > LOWEST)
        return pa.RecordBatch.from_pydict({"anchor": slot // bands, "band": slot % bands, "score": self.score[slot, rank], "id": self.id[slot, rank]})


def pairs(values: np.ndarray, block: Planes, columns: np.ndarray, alive: np.ndarray, wanted):
    """Tile rows, columns and whole scores of the pairs that `wanted(low, high, rows)` kept to the end."""
    kind, dim = values.dtype, min(values.shape[1], block.dim)
    planes, values = block.planes[:, :dim, columns], values[:, :dim]
    least, most = np.minimum(values, 0).sum(axis=1), np.maximum(values, 0).sum(axis=1)
    partial = (values @ planes[-1].astype(kind)) * kind.type(-(2 ** (block.bits - 1)))
    k, rows = block.bits - 1, np.arange(len(values))[:, None]
    while k:
        if np.count_nonzero(alive) * SPARSE <= alive.size:
            break
        k -= 1
        partial += (values @ planes[k].astype(kind)) * kind.type(2**k)
        rest = kind.type(2**k - 1)
        alive &= wanted(partial + rest * least[:, None], partial + rest * most[:, None], rows)
    i, j = np.nonzero(alive)
    score = partial[i, j]
    while k and len(i):
        k -= 1
        plane = planes[k].T.astype(kind)
        for at in range(0, len(i), 1 << 15):
            part = slice(at, at + (1 << 15))
            score[part] += np.einsum("pd,pd->p", values[i[part]], plane[j[part]]) * kind.type(2**k)
        rest = kind.type(2**k - 1)
        keep = wanted(score + rest * least[i], score + rest * most[i], i)
        i, j, score = i[keep], j[keep], score[keep]
    return i, j, score.astype(np.int64)


def _positives(portion: Portion, block: Planes, best: Best) -> None:
    """Rows of the anchors' own labels, the anchors themselves left out."""
    most = best.score.shape[1]
    for at in range(0, len(portion.rows), TILE):
        tile = slice(at, at + TILE)
        labels = portion.labels[tile]
        columns = np.flatnonzero(np.isin(block.labels, labels))
        if not len(columns):
            continue
        alive = labels[:, None] == block.labels[columns]
        alive &= portion.rows[tile][:, None] != block.first + columns
        mates, floor = alive.copy(), best.floor[tile].astype(np.float64)

        def wanted(low, high, rows, mates=mates, floor=floor):
            if low.ndim == 2 and low.shape[1] > most:
                # as many rows are sure to reach the least of the best lower ends
                sure = np.partition(np.where(mates, low, -np.inf), -most, axis=1)[:, -most]
                np.maximum(floor, sure, out=floor)
            return high >= floor[rows]

        i, j, score = pairs(portion.values[tile].astype(portion.kind), block, columns, alive, wanted)
        best.add(i + at, score, block.ids[columns[j]])


def _negatives(portion: Portion, block: Planes, best: Best, low_end: np.ndarray, high_end: np.ndarray) -> None:
    """Rows of other labels, for each band of each anchor."""
    bands = low_end.shape[1]
    for at in range(0, len(portion.rows), TILE):
        tile = slice(at, at + TILE)
        floor = np.maximum(best.floor.reshape(-1, bands)[tile], low_end[tile]).astype(np.float64)
        upper = high_end[tile].astype(np.float64)
        # a band without scores asks for nothing
        open_ = low_end[tile] <= high_end[tile]
        lowest, highest = np.where(open_, floor, np.inf).min(axis=1), np.where(open_, upper, -np.inf).max(axis=1)
        columns = np.arange(block.n)
        alive = portion.labels[tile][:, None] != block.labels
        alive[~open_.any(axis=1)] = False

        def wanted(low, high, rows, lowest=lowest, highest=highest, floor=floor, upper=upper):
            keep = (high >= lowest[rows]) & (low <= highest[rows])
            if low.ndim == 1:
                keep &= ((high[:, None] >= floor[rows]) & (low[:, None] <= upper[rows])).any(axis=1)
            return keep

        i, j, score = pairs(portion.values[tile].astype(portion.kind), block, columns, alive, wanted)
        fits = (score[:, None] >= floor[i]) & (score[:, None] <= upper[i])
        pair, band = np.nonzero(fits)
        best.add((i[pair] + at) * bands + band, score[pair], block.ids[j[pair]])


def _search(stored: DataFrame, shared: Shared, step, most: int, bands: int) -> DataFrame:
    """`anchor`, `band`, `rank`, `score`, `id`: the best rows of all blocks for each slot of a portion."""

    def run(batches):
        portion, floor, *more = shared.value
        best = Best(len(portion.rows) * bands, most, floor)
        for batch in batches:
            for k in range(batch.num_rows):
                step(portion, Planes(batch.slice(k, 1).to_pylist()[0]), best, *more)
        yield best.batch(bands)

    found = stored.mapInArrow(run, "anchor bigint, band bigint, score bigint, id bigint")
    order = Window.partitionBy("anchor", "band").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _floors(first: DataFrame, shared: Shared, step, most: int, bands: int, slots: int) -> np.ndarray:
    """What the first look finds: the score of the last of the best for each slot that has as many."""
    floor = np.full(slots, LOWEST)
    for r in _search(first, shared, step, most, bands).where(F.col("rank") == most).select("anchor", "band", "score").collect():
        floor[r.anchor * bands + r.band] = r.score
    return floor


def mine(
    rows: DataFrame, anchor: Column, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | Column = "label", scale: float = SCALE,
    positives: int = POSITIVES, negatives: int = NEGATIVES, band: tuple[int, int, int] = BAND, portion_bytes: int = PORTION,
) -> DataFrame:
    """For each row that `anchor` picks and each of its first `positives` rows of the same label: the first `negatives` rows of other labels.

    Only those count whose score s satisfies band[0] * p <= band[2] * s <= band[1] * p, p being the positive's score.
    """
    # every search runs in here: a block is a row, and few of them go to a worker at a time
    with settings(rows.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": 32}):
        return _mine(rows.sparkSession, blocks(rows, anchor, id_col=id_col, vector_col=vector_col, label_col=label_col, scale=scale), positives, negatives, band, portion_bytes)


def _mine(session, made: DataFrame, positives: int, negatives: int, band: tuple[int, int, int], portion_bytes: int) -> DataFrame:
    scratch = Scratch(session)
    stored = scratch.store(made.repartition(partitions(session)), "blocks")
    first = stored.where(F.pmod(F.xxhash64("block"), F.lit(FIRST_LOOK)) == 0)
    whole = scratch.store(ranked(anchors_of(stored), [], ["label", "row"], "_rank"), "anchors")
    total, width = whole.agg(F.count(F.lit(1)), F.max(F.length("v"))).first()
    bits = stored.agg(F.max("bits")).first()[0]
    size = max(1, portion_bytes // (width or 1))
    done = []
    for at in range(0, total, size):
        chosen = whole.where((F.col("_rank") >= at) & (F.col("_rank") < at + size)).orderBy("_rank").collect()
        portion = Portion(chosen, bits)
        n = len(chosen)
        floor = _floors(first, Shared(session, (portion, np.full(n, LOWEST))), _positives, positives, 1, n)
        near = scratch.store(_search(stored, Shared(session, (portion, floor)), _positives, positives, 1), f"positives-{at}")
        # a band for each positive; those of missing ones are empty
        low, high = np.ones((n, positives), np.int64), np.zeros((n, positives), np.int64)
        for r in near.select("anchor", "rank", "score").collect():
            low[r.anchor, r["rank"] - 1], high[r.anchor, r["rank"] - 1] = -(-band[0] * r.score // band[2]), band[1] * r.score // band[2]
        more, slots = (low, high), n * positives
        floor = _floors(first, Shared(session, (portion, np.full(slots, LOWEST), *more)), _negatives, negatives, positives, slots)
        far = _search(stored, Shared(session, (portion, floor, *more)), _negatives, negatives, positives)
        own = whole.select((F.col("_rank") - at).alias("anchor"), F.col("id").alias("anchor_id"))
        pairs_ = near.select("anchor", (F.col("rank") - 1).alias("band"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        out = far.join(pairs_, ["anchor", "band"]).join(own, "anchor")
        done.append(scratch.store(out.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")), f"found-{at}"))
    if not done:
        return session.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    return session.read.schema(done[0].schema).parquet(*(f"{scratch.folder}/found-{at}" for at in range(0, total, size)))
