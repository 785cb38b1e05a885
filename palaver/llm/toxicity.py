"""Toxicity as ordinal regression: one weight vector, ordered thresholds (cumulative logit link).

P(grade >= k) = sigmoid(w.x - t_k) with t_1 < t_2 < ...; the expected severity is the sum over k.  Features are
the words of a text and their beginnings, by 64-bit hash, each counted once a text; only those that speak
for toxic training texts carry a weight, so a text of any length gets no noise from its other words.

Labels of more than one grade are taken as they are.  Where they hold one bit, clean texts have grade 0 and a
toxic one has 1 plus the number of `STEPS` that its toxic sentences reach.  Which sentences are toxic is judged by
a model of that bit fitted on the other half of the sample, so no text has a part in its own grade.

Fit on at most `sample` labelled texts of each bit, taken by hash of the id.  Features are counted and chosen by a
grouped sum; the driver holds at most `most` features and, of a text of any length, those of them that occur in it.
Every text is scored.

Null and empty texts have no features and get the grade of the bare thresholds; without labels nothing is
rejected; repeated rows are scored one by one; a text whose features are unknown counts as empty; features that
speak as much are taken by hash; an empty table gives no rows.  A column that is named as the result (`into`) is
replaced, others are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palaver.llm.common import Shared, cut
from palaver.llm.kernel import Words, slices, string_bytes

SAMPLE, FEATURES = 5_000, 4_096
BEGINNINGS = (6, 8)
#: Toxic sentences of a text from which its grade is 2, 3.
STEPS = (2, 4)
SENTENCE = r"[.!?\n]+"


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def features(batch_column) -> tuple[np.ndarray, np.ndarray]:
    """Feature hashes of a batch and the text that each belongs to, with repeats."""
    words = Words(*string_bytes(batch_column))
    doc = np.repeat(np.arange(len(batch_column)), words.counts())
    kinds = [words.hashes, *(words.prefixes(n) for n in BEGINNINGS)]
    return np.concatenate(kinds), np.tile(doc, len(kinds))


@dataclass
class Model:
    """Sorted feature hashes with their weights, and the thresholds."""

    hashes: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def scores(self, column) -> np.ndarray:
        values, doc = features(column)
        out = np.zeros(len(column))
        if not len(self.hashes):
            return out
        seen = np.zeros(1 << 20, bool)
        seen[self.hashes >> np.uint64(44)] = True
        at = np.flatnonzero(seen[values >> np.uint64(44)])
        place = np.minimum(np.searchsorted(self.hashes, values[at]), len(self.hashes) - 1)
        known = self.hashes[place] == values[at]
        pair = np.unique(doc[at[known]] * len(self.hashes) + place[known])
        return out + np.bincount(pair // len(self.hashes), self.weights[pair % len(self.hashes)], len(column))

    def exceed(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..., a row a text."""
        return sigmoid(scores[:, None] - self.thresholds[None, :])


def ordinal_fit(rows: np.ndarray, cols: np.ndarray, n_cols: int, grades: np.ndarray, steps: int = 400, rate: float = 0.1, ridge: float = 0.02) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds that minimise the cumulative-link loss with a ridge, by Adam on all rows."""
    top = int(grades.max(initial=1)) or 1
    w, t = np.zeros(n_cols), np.concatenate(([1.0], np.zeros(top - 1)))  # thresholds: t_1, then log gaps
    moment, square, n = np.zeros(n_cols + top), np.zeros(n_cols + top), max(1, len(grades))
    for step in range(1, steps + 1):
        cuts = np.concatenate(([t[0]], t[0] + np.cumsum(np.exp(t[1:]))))
        score = np.bincount(rows, w[cols], len(grades))
        edge = np.concatenate([np.full((len(grades), 1), np.inf), score[:, None] - cuts, np.full((len(grades), 1), -np.inf)], axis=1)
        above = sigmoid(np.clip(edge, -40, 40))
        high, low = np.take_along_axis(above, grades[:, None], 1)[:, 0], np.take_along_axis(above, grades[:, None] + 1, 1)[:, 0]
        high[grades == 0], low[grades == top] = 1.0, 0.0
        p = np.maximum(high - low, 1e-12)
        # d log p / d score and, by threshold, d log p / d cut
        slope_high, slope_low = high * (1 - high) / p, low * (1 - low) / p
        gs = slope_high - slope_low
        gc = np.zeros(top + 2)
        np.add.at(gc, grades, -slope_high)
        np.add.at(gc, grades + 1, slope_low)
        gc = gc[1 : top + 1]
        gt = np.concatenate(([gc.sum()], [np.exp(t[k]) * gc[k:].sum() for k in range(1, top)]))
        grad = np.concatenate([-np.bincount(cols, gs[rows], n_cols) / n + ridge * w / 10, -gt / n])
        moment, square = 0.9 * moment + 0.1 * grad, 0.999 * square + 0.001 * grad**2
        move = rate * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        w, t = w - move[:n_cols], t - move[n_cols:]
    return w, np.concatenate(([t[0]], t[0] + np.cumsum(np.exp(t[1:]))))


def _counts(rows: DataFrame) -> DataFrame:
    """`feature`, and in how many texts of each half and bit it occurs: `n00` (first half, clean) to `n11`."""

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "_text"):
                values, doc = features(batch.column("_text"))
                order = np.lexsort((doc, values))
                fresh = np.concatenate(([True], (np.diff(values[order]) != 0) | (np.diff(doc[order]) != 0)))[: len(order)]
                values, doc = values[order][fresh], doc[order][fresh]
                code = 2 * batch.column("_half").to_numpy() + (batch.column("_grade").to_numpy() > 0)
                uniq, inverse = np.unique(values, return_inverse=True)
                table = np.bincount(4 * inverse + code[doc], minlength=4 * len(uniq)).reshape(-1, 4)
                yield pa.RecordBatch.from_arrays([pa.array(uniq.view(np.int64)), *(pa.array(table[:, k], pa.int64()) for k in range(4))], names=["feature", "n00", "n01", "n10", "n11"])

    counted = rows.select("_grade", "_half", "_text").mapInArrow(run, "feature bigint, n00 bigint, n01 bigint, n10 bigint, n11 bigint")
    return counted.groupBy("feature").agg(*(F.sum(c).alias(c) for c in ("n00", "n01", "n10", "n11")))


def _telling(counts: DataFrame, hit: Column, miss: Column, toxic: int, clean: int, most: int) -> np.ndarray:
    """Sorted hashes of the features that speak most for toxic: seen in 3 texts or more, by the z of their log odds."""
    a, b = hit + F.lit(0.5), miss + F.lit(0.5)
    z = (F.log(a / F.lit(toxic + 1.0)) - F.log(b / F.lit(clean + 1.0))) / F.sqrt(1 / a + 1 / b)
    rows = counts.where((hit + miss >= 3) & (z > 2.5)).orderBy(z.desc(), "feature").limit(most).select("feature").collect()
    return np.sort(np.array([r[0] for r in rows], np.int64).view(np.uint64))


def _occurrences(rows: DataFrame, hashes: list[np.ndarray]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray, np.ndarray]:
    """For each list of hashes, text and place in the list of what occurs; the texts' grades and halves."""
    shared = Shared(rows.sparkSession, hashes)

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "_text"):
                values, doc = features(batch.column("_text"))
                found = []
                for own in shared.value:
                    place = np.minimum(np.searchsorted(own, values), max(0, len(own) - 1))
                    known = own[place] == values if len(own) else np.zeros(len(values), bool)
                    pair = np.unique(doc[known] * (1 << 32) + place[known])
                    edges = np.searchsorted(pair >> 32, np.arange(batch.num_rows + 1))
                    found.append(pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(pair & 0xFFFFFFFF, pa.int32())))
                yield pa.RecordBatch.from_arrays([batch.column("_grade"), batch.column("_half"), *found], names=["grade", "half", "f0", "f1", "f2"])

    table = rows.select("_grade", "_half", "_text").mapInArrow(run, "grade int, half int, f0 array<int>, f1 array<int>, f2 array<int>").toArrow()
    grades, halves, out = table["grade"].to_numpy(), table["half"].to_numpy(), []
    for name in ("f0", "f1", "f2"):
        lists = table[name].combine_chunks()
        text = np.repeat(np.arange(len(grades)), lists.value_lengths().to_numpy()) if len(grades) else np.zeros(0, int)
        out.append((text, lists.flatten().to_numpy() if len(grades) else np.zeros(0, int)))
    return out, grades.astype(np.int64), halves.astype(np.int64)


def _extents(rows: DataFrame, models: list[Model]) -> np.ndarray:
    """How many sentences of each text the other half's model takes for toxic, in the order of the rows."""
    shared = Shared(rows.sparkSession, models)

    def run(batches):
        import re

        for whole in batches:
            for batch in slices(whole, "_text"):
                out = np.zeros(batch.num_rows, np.int64)
                for d, (half, grade, text) in enumerate(zip(batch.column("_half").to_pylist(), batch.column("_grade").to_pylist(), batch.column("_text"), strict=True)):
                    if grade:
                        model = shared.value[1 - half]
                        parts = pa.array(re.split(SENTENCE, text.as_py() or ""), pa.string())
                        out[d] = (model.exceed(model.scores(parts))[:, 0] >= 0.5).sum()
                yield pa.RecordBatch.from_arrays([pa.array(out)], names=["n"])

    return rows.select("_grade", "_half", "_text").mapInArrow(run, "n bigint").toArrow()["n"].to_numpy()


BLIND = Model(np.zeros(0, np.uint64), np.zeros(0), np.array([30.0, 31.0, 32.0]))


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE, most: int = FEATURES) -> Model:
    """The model from at most `sample` labelled texts without and with a grade, and at most `most` features."""
    grade = F.col(label_col).cast("int")
    named = labels.select(F.col(id_col).alias("_id"), grade.alias("_grade")).where("_grade is not null")
    chosen = [named.where(test).orderBy(F.xxhash64("_id"), "_id").limit(sample) for test in ("_grade <= 0", "_grade > 0")]
    chosen = chosen[0].union(chosen[1]).withColumn("_half", F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(2)).cast("int"))
    rows = cut(docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")).join(F.broadcast(chosen), "_id").drop("_id"))
    counts = cut(_counts(rows))
    n = {(r[0], r[1]): r[2] for r in rows.groupBy("_half", (F.col("_grade") > 0).cast("int").alias("bit")).count().collect()}
    n = {(h, b): n.get((h, b), 0) for h in (0, 1) for b in (0, 1)}
    c = {x: F.col(x) for x in ("n00", "n01", "n10", "n11")}
    hashes = [
        _telling(counts, c["n01"], c["n00"], n[0, 1], n[0, 0], most), _telling(counts, c["n11"], c["n10"], n[1, 1], n[1, 0], most),
        _telling(counts, c["n01"] + c["n11"], c["n00"] + c["n10"], n[0, 1] + n[1, 1], n[0, 0] + n[1, 0], most),
    ]
    if not len(hashes[2]):
        return BLIND
    found, grades, halves = _occurrences(rows, hashes)
    grades = np.maximum(grades, 0)
    if grades.max(initial=0) == 1:
        models = []
        for half in (0, 1):
            text, place = found[half]
            own = np.flatnonzero(halves == half)
            at = np.full(len(grades), -1)
            at[own] = np.arange(len(own))
            keep = at[text] >= 0
            models.append(Model(hashes[half], *ordinal_fit(at[text[keep]], place[keep], len(hashes[half]), grades[own])) if len(hashes[half]) else BLIND)
        extent = _extents(rows, models)
        grades = np.where(grades > 0, 1 + sum((extent >= s).astype(np.int64) for s in STEPS), 0)
    return Model(hashes[2], *ordinal_fit(*found[2], len(hashes[2]), grades))


def score(docs: DataFrame, model: Model, *, text_col: str = "text", into: str = "toxicity") -> DataFrame:
    """The documents with a struct: expected `severity`, `grade` (likeliest) and `p_toxic` = P(grade >= 1)."""
    shared = Shared(docs.sparkSession, model)
    kind = "struct<severity:double,grade:int,p_toxic:double>"
    schema = docs.drop(into).withColumn(into, F.lit(None).cast(kind)).schema

    def run(batches):
        for whole in batches:
            for batch in slices(whole, text_col):
                above = shared.value.exceed(shared.value.scores(batch.column(text_col)))
                each = -np.diff(np.concatenate([np.ones((len(above), 1)), above, np.zeros((len(above), 1))], axis=1), axis=1)
                names = [n for n in batch.schema.names if n != into]
                new = pa.StructArray.from_arrays([pa.array(above.sum(axis=1)), pa.array(each.argmax(axis=1), pa.int32()), pa.array(above[:, 0])], names=["severity", "grade", "p_toxic"])
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), new], names=[*names, into])

    return docs.drop(into).mapInArrow(run, schema)


def reject(docs: DataFrame, model: Model, *, text_col: str = "text", limit: float = 0.5) -> DataFrame:
    """The documents whose P(grade >= 1) is below the limit."""
    return score(docs, model, text_col=text_col, into="_toxicity").where(F.col("_toxicity.p_toxic") < limit).select(*docs.columns)
