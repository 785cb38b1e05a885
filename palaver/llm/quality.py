"""Quality by weak labels: heuristic labellers, their accuracies by expectation maximisation, a hashed scorer.

Each labeller votes good (1), bad (-1) or abstains (0) on counts of a text.  The vote patterns of all
documents are counted (3 to the number of labellers is the most there can be); on the driver, EM fits
a two-class model in which every labeller that doesn't abstain has its own accuracy a class.  The patterns' posteriors
are the labels of a logistic scorer on hashed features, fitted on at most `sample` documents taken by hash of the
id; every document is scored.  What the driver holds of the sample is at most `sample` times SPACE numbers, whatever
the texts' length.

Texts of fewer than FEW words get no vote from the labellers on repetition and sentences, as a few words show
neither.  Null and empty texts have no words, which is bad, and few letters; an empty table has no rows; without
variety among the patterns the posterior is the majority's; repeated rows are scored one by one; texts of any length
are measured whole.  A column that is named as the result (`into`) is replaced, others are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.llm.common import Shared
from palaver.llm.kernel import ALNUM, Words, mix, slices, string_bytes
from palaver.llm.toxicity import sigmoid

SAMPLE, SPACE = 6_000, 1 << 13
#: Words of the segments in which distinct ones are counted.
SEGMENT = 100
#: Texts of fewer words get no vote on repetition and sentences.
FEW = 20
SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
PROSE = np.isin(np.arange(256), [ord(c) for c in ".,;:!?'\"-()"])
UPPER = np.isin(np.arange(256), range(65, 91))
LATIN = UPPER | np.isin(np.arange(256), range(97, 123))
STOPS = np.isin(np.arange(256), [ord(c) for c in ".!?"])
#: Name, lower and upper bound of good, lower and upper bound beyond which it is bad.
LABELLERS = (
    ("symbols", 0.0, 0.02, -1.0, 0.06),
    ("distinct", 0.30, 1.0, 0.12, 2.0),
    ("common", 0.0, 0.12, -1.0, 0.25),
    ("sentence", 3.0, 40.0, 1.8, 90.0),
    ("words", 30.0, 1e12, 1.0, 1e13),
    ("short", 0.12, 0.70, 0.04, 0.95),
    ("lines", 0.8, 1.0, 0.4, 2.0),
    ("letters", 0.70, 1.0, 0.5, 2.0),
    ("marks", 0.0, 0.05, -1.0, 0.4),
    ("runs", 0.0, 0.02, -1.0, 0.2),
    ("shout", 0.0, 0.15, -1.0, 0.4),
    ("again", 0.0, 0.02, -1.0, 0.1),
)


def measures(column) -> tuple[np.ndarray, Words]:
    """The labellers' measures, a column each, for every text."""
    data, off = string_bytes(column)
    words = Words(data, off)
    n, counts = np.maximum(1, np.diff(off)), words.counts()
    per = lambda table: _sums(table[data], off)
    odd = (~ALNUM & ~SPACES & ~PROSE)[data]
    marks = _sums(odd, off)
    same = np.concatenate(([False], words.hashes[1:] == words.hashes[:-1]))[: len(words.hashes)]
    of_word = words.doc_of(np.arange(len(words.hashes)))
    again = np.bincount(of_word, same, len(off) - 1) / np.maximum(1, counts)
    doubled = (~ALNUM & ~SPACES)[data] & np.concatenate(([False], data[1:] == data[:-1]))[: len(odd)]
    sizes = words.ends - words.starts
    # distinct words of each segment: a share that doesn't depend on the text's length
    segment = np.cumsum(np.concatenate(([0], -(-counts // SEGMENT))))[of_word] + (np.arange(len(of_word)) - words.first[of_word]) // SEGMENT
    order = np.lexsort((words.hashes, segment))
    fresh = np.concatenate(([True], (np.diff(segment[order]) != 0) | (np.diff(words.hashes[order]) != 0)))[: len(order)]
    distinct = np.bincount(of_word[order], fresh, len(off) - 1) / np.maximum(1, counts)
    common, lines = np.zeros(len(off) - 1), np.ones(len(off) - 1)
    line_at = np.flatnonzero(data == 10)
    for d in range(len(off) - 1):
        own = words.hashes[words.first[d] : words.first[d + 1]]
        if len(own):
            _, repeats = np.unique(own, return_counts=True)
            common[d] = repeats.max() / len(own)
        a, b = np.searchsorted(line_at, off[d : d + 2])
        if b - a >= 2:
            parts = [x for x in data[off[d] : off[d + 1]].tobytes().split(b"\n") if x.strip()]
            lines[d] = len(set(parts)) / max(1, len(parts))
    short = np.bincount(of_word, sizes <= 3, len(off) - 1) / np.maximum(1, counts) if len(sizes) else np.zeros(len(off) - 1)
    columns = [marks / n, distinct, common, counts / np.maximum(1, per(STOPS)), counts, short, lines, per(ALNUM) / n, marks / np.maximum(1, counts), _sums(doubled, off) / np.maximum(1, counts), per(UPPER) / np.maximum(1, per(LATIN)), again]
    out = np.column_stack(columns).astype(float)
    # what a few words show says nothing: the labellers on repetition and sentences abstain
    out[np.ix_(counts < FEW, [1, 2, 3, 5, 6, 11])] = np.nan
    return out, words


def _sums(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[off[1:]] - total[off[:-1]]


def votes(values: np.ndarray) -> np.ndarray:
    out = np.zeros(values.shape, np.int8)
    for k, (_, low, high, least, most) in enumerate(LABELLERS):
        out[(values[:, k] >= low) & (values[:, k] <= high), k] = 1
        out[(values[:, k] < least) | (values[:, k] > most), k] = -1
    return out


def pattern(v: np.ndarray) -> np.ndarray:
    """A vote row as one number in base 3."""
    return (v.astype(np.int64) + 1) @ (3 ** np.arange(v.shape[1]))


def unpack(numbers: np.ndarray, n: int = len(LABELLERS)) -> np.ndarray:
    return (numbers[:, None] // 3 ** np.arange(n)) % 3 - 1


def expectation_maximisation(v: np.ndarray, n: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of good for each vote pattern (`v`, seen `n` times), and the labellers' vote distributions [class, labeller, vote + 1]; abstaining says nothing."""
    total = v.sum(axis=1)
    good = np.clip(0.5 + 0.5 * np.tanh(total), 0.02, 0.98)
    chance = np.zeros((2, v.shape[1], 3))
    for _ in range(rounds):
        for c, own in enumerate((1 - good, good)):
            weight = own * n
            for k in range(v.shape[1]):
                seen = np.bincount(v[:, k] + 1, weight, 3) + 1.0
                chance[c, k] = seen / (seen[0] + seen[2])
                chance[c, k, 1] = 1.0
        prior = np.clip((good * n).sum() / max(1, n.sum()), 0.05, 0.95)
        at = np.arange(v.shape[1])
        odds = np.log(prior / (1 - prior)) + (np.log(chance[1][at, v + 1]) - np.log(chance[0][at, v + 1])).sum(axis=1)
        new = sigmoid(odds)
        if np.abs(new - good).max(initial=0) < 1e-7:
            break
        good = new
    return good, chance


def hashed(values: np.ndarray, words: Words, space: int = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and value of the scorer's features: words, and every measure in steps; rows have unit length in each part."""
    counts = words.counts()
    doc = np.repeat(np.arange(len(counts)), counts)
    pair, n = np.unique(doc * space + (words.hashes % np.uint64(space // 2)).astype(np.int64), return_counts=True)
    row, col, value = pair // space, pair % space, np.sqrt(n)
    norm = np.sqrt(np.bincount(row, value**2, len(counts)))
    steps = np.clip(np.floor(8 * np.log1p(np.maximum(np.nan_to_num(values), 0) * 10)), 0, 255).astype(np.uint64)
    extra = space // 2 + (mix(steps + np.arange(1, values.shape[1] + 1, dtype=np.uint64) * np.uint64(1009)) % np.uint64(space // 2)).astype(np.int64)
    rows2 = np.repeat(np.arange(len(counts)), values.shape[1])
    return np.concatenate([row, rows2]), np.concatenate([col, extra.reshape(-1)]), np.concatenate([value / np.maximum(norm[row], 1e-9), np.full(len(rows2), 1.0)])


def _labelled(docs: DataFrame) -> DataFrame:
    def run(batches):
        for whole in batches:
            for batch in slices(whole, "_text"):
                values, _ = measures(batch.column("_text"))
                yield pa.RecordBatch.from_arrays([pa.array(pattern(votes(values)))], names=["pattern"])

    return docs.select("_text").mapInArrow(run, "pattern bigint").groupBy("pattern").count()


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> dict:
    """The model: posterior by vote pattern, labellers' vote distributions, weights of the scorer."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    found = np.array([tuple(r) for r in _labelled(rows).collect()], np.int64).reshape(-1, 2)
    good, chance = expectation_maximisation(unpack(found[:, 0]), found[:, 1].astype(float))
    posterior = dict(zip(found[:, 0].tolist(), good.tolist(), strict=True))
    chosen = rows.select("_id").orderBy(F.xxhash64("_id"), "_id").limit(sample).distinct()

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "_text"):
                values, words = measures(batch.column("_text"))
                row, col, value = hashed(values, words)
                order = np.argsort(row, kind="stable")
                edges = pa.array(np.searchsorted(row[order], np.arange(batch.num_rows + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(pattern(votes(values))), pa.ListArray.from_arrays(edges, pa.array(col[order], pa.int32())), pa.ListArray.from_arrays(edges, pa.array(value[order], pa.float32()))], names=["pattern", "col", "value"])

    table = rows.join(F.broadcast(chosen), "_id").mapInArrow(run, "pattern bigint, col array<int>, value array<float>").toArrow()
    target = np.array([posterior.get(p, 0.5) for p in table["pattern"].to_pylist()])
    col, lists = table["col"].combine_chunks(), table["value"].combine_chunks()
    row = np.repeat(np.arange(len(target)), col.value_lengths().to_numpy()) if len(target) else np.zeros(0, int)
    col, value = (col.flatten().to_numpy(), lists.flatten().to_numpy()) if len(target) else (np.zeros(0, int), np.zeros(0))
    weights, bias = np.zeros(SPACE), 0.0
    square, n = np.full(SPACE, 1e-6), max(1, len(target))
    for _ in range(150):
        error = sigmoid(np.bincount(row, value * weights[col], len(target)) + bias) - target if len(target) else np.zeros(0)
        grad = np.bincount(col, value * error[row], SPACE) / n + 1e-5 * weights
        square += grad**2
        weights -= 0.3 * grad / np.sqrt(square)
        bias -= 1.0 * float(error.sum()) / n
    return {"posterior": posterior, "chance": chance, "weights": weights.astype(np.float32), "bias": bias}


def score(docs: DataFrame, model: dict, *, text_col: str = "text", into: str = "quality") -> DataFrame:
    """The documents with a struct: `posterior` of the labellers' votes, `score` of the scorer, `keep`."""
    shared = Shared(docs.sparkSession, model)
    schema = docs.drop(into).withColumn(into, F.lit(None).cast("struct<posterior:double,score:double,keep:boolean>")).schema

    def run(batches):
        m = shared.value
        for whole in batches:
            for batch in slices(whole, text_col):
                values, words = measures(batch.column(text_col))
                row, col, value = hashed(values, words)
                own = sigmoid(np.bincount(row, value * m["weights"][col], batch.num_rows) + m["bias"])
                good = np.array([m["posterior"].get(p, 0.5) for p in pattern(votes(values)).tolist()])
                names = [n for n in batch.schema.names if n != into]
                new = pa.StructArray.from_arrays([pa.array(good), pa.array(own), pa.array(own >= 0.5)], names=["posterior", "score", "keep"])
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), new], names=[*names, into])

    return docs.drop(into).mapInArrow(run, schema)
