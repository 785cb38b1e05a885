"""Language identification by Bayesian evidence fusion.

For every text: log likelihoods of its bytes under one trigram model a language, tempered to at most
`EVIDENCE` trigrams; the language that its markup declares, under a confusion table; the suffix of its address;
and a prior by host.  Host priors are smoothed towards the address suffix's, those towards the corpus's, by
pseudo-counts.  All of these tables are grouped sums of the text-only posteriors over all rows, and a row
takes its own share out of its host's and suffix's sums, so no text is its own evidence.

The trigram models are fitted on at most `sample` texts of each language that a labelled table declares, taken by hash
of the id; every declared language has a model, however rare it is, in whatever case it is written; blank codes declare
nothing, and texts under three bytes add nothing to their language's model.  Null and empty texts have no likelihood and follow
markup and address; null declarations, hosts and suffixes give no evidence; an empty table has no rows; repeated rows are
judged one by one, each with the other's evidence for its host; texts of any length are read whole; of languages that are
equally likely the first by its code is taken.  `evidence` and `fuse` replace columns of the names that they add (`like`,
`language`, `confidence`, `text_language`) and keep the others.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palaver.llm.common import Shared, attach, cut
from palaver.llm.kernel import LOWER, slices, string_bytes

SPACE, SAMPLE, EVIDENCE = 1 << 15, 400, 60.0
HOST, SUFFIX, DECLARED = 5.0, 20.0, 1.0
#: The model takes 128 kB a language; more codes than this, 512 MB, are refused.
LANGUAGES = 4_096
#: What isn't prose in a page: comments, scripts, styles, tags, entities.
OPENING = re.compile(r"<!--|<(script|style)\b|<|&#?\w+;", re.IGNORECASE)
CLOSING = {"script": re.compile(r"</script\s*>", re.IGNORECASE), "style": re.compile(r"</style\s*>", re.IGNORECASE), "<!--": re.compile("-->"), "<": re.compile(">")}
DECLARES = r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})"


def visible(html: str | None) -> str:
    """The page without markup, in one pass: the next end of each kind is looked for once, however many beginnings lack one."""
    html, out, at = html or "", [], 0
    ends: dict[str, tuple[int, int]] = {}

    def end(kind: str, start: int) -> int:
        """Where the first end of this kind after `start` stops; -1 if there is none."""
        found, stop = ends.get(kind, (-1, -1))
        if found < start and stop != 0:
            m = CLOSING[kind].search(html, start)
            found, stop = ends[kind] = (m.start(), m.end()) if m else (len(html), 0)
        return stop or -1

    while m := OPENING.search(html, at):
        stop = m.end()
        if m[0][0] == "<":
            kind = (m[1] or m[0]).lower()
            stop = end(kind, m.end())
            if stop < 0 and kind != "<":  # unclosed: no more than a tag
                stop = end("<", m.start() + 1)
        if stop < 0:
            out.append(html[at : m.start() + 1])
            at = m.start() + 1
        else:
            out += [html[at : m.start()], " "]
            at = stop
    return "".join([*out, html[at:]])


def trigrams(column) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte trigrams of a batch, A-Z folded and other than letters as spaces, and each text's first one."""
    data, off = string_bytes(column)
    data = LOWER[data].astype(np.uint32)
    data[(data < 0x61) | (data > 0x7A) & (data < 0x80)] = 32
    grams = np.zeros(max(0, len(data) - 2), np.uint32)
    if len(grams):
        grams = (data[:-2] * np.uint32(0x9E3779B1) + data[1:-1] * np.uint32(0x85EBCA6B) + data[2:] * np.uint32(0xC2B2AE35)) >> np.uint32(17)
    return grams, off


class Trigrams:
    """Log probabilities [language, hashed trigram]."""

    def __init__(self, languages: list[str], table: np.ndarray):
        self.languages, self.table = languages, table

    def likelihoods(self, column) -> tuple[np.ndarray, np.ndarray]:
        """Sum of log probabilities [text, language] and the number of trigrams."""
        grams, off = trigrams(column)
        ends = np.minimum(np.maximum(off[1:] - 2, off[:-1]), len(grams))
        starts = np.minimum(off[:-1], ends)
        out = np.zeros((len(off) - 1, len(self.languages)))
        for k in range(len(self.languages)):
            total = np.concatenate(([0.0], np.cumsum(self.table[k][grams])))
            out[:, k] = total[ends] - total[starts]
        return out, ends - starts


def fit(labelled: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Trigrams:
    """Trigram models of all declared languages from at most `sample` texts each."""
    # codes as `of_documents` and `of_pages` give them
    code = F.lower(F.trim(F.col(lang_col)))
    named = labelled.where(code != "")
    languages = sorted(r[0] for r in named.select(code).distinct().limit(LANGUAGES + 1).collect())
    if len(languages) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} declared languages: the column isn't one of language codes")
    table = np.ones((max(1, len(languages)), SPACE))

    def run(batches):
        for batch in batches:
            sums = {}
            for language, text in zip(batch.column("_lang").to_pylist(), batch.column("_text"), strict=True):
                grams, off = trigrams(pa.array([text.as_py()], pa.string()))
                sums[language] = sums.get(language, 0) + np.bincount(grams, minlength=SPACE)
            for language, count in sums.items():
                used = np.flatnonzero(count)
                yield pa.RecordBatch.from_arrays([pa.array([language] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(count[used], pa.int64())], names=["lang", "gram", "n"])

    if languages:
        # each task passes on `sample` ids of a language at most
        order = Window.partitionBy("_lang").orderBy(F.xxhash64("_id"), "_id")
        chosen = named.select(F.col(id_col).alias("_id"), code.alias("_lang")).withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= sample).drop("_rank")
        texts = labelled.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")).join(F.broadcast(chosen.distinct()), "_id").select("_lang", "_text")
        counted = texts.mapInArrow(run, "lang string, gram int, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
        place = {x: k for k, x in enumerate(languages)}
        at = np.array([place[x] for x in counted["lang"].to_pylist()], int)
        np.add.at(table, (at, counted["gram"].to_numpy()), counted["n"].to_numpy())
    return Trigrams(languages or ["und"], np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32))


def evidence(rows: DataFrame, model: Trigrams, *, text_col: str, markup: bool) -> DataFrame:
    """The rows, without the text, with `like`: the tempered log likelihoods as an array of doubles."""
    shared, rows = Shared(rows.sparkSession, model), rows.drop("like")
    schema = rows.drop(text_col).withColumn("like", F.array(F.lit(0.0))).schema

    def run(batches):
        for whole in batches:
            for batch in slices(whole, text_col):
                column = batch.column(text_col)
                if markup:
                    column = pa.array([visible(x.as_py()) for x in column], pa.large_string())
                like, n = shared.value.likelihoods(column)
                like *= np.minimum(1.0, EVIDENCE / np.maximum(1, n))[:, None]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * like.shape[1], pa.int32()), pa.array(like.reshape(-1)))
                names = [x for x in batch.schema.names if x != text_col]
                yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), lists], names=[*names, "like"])

    return rows.mapInArrow(run, schema)


def softmax(logs: np.ndarray) -> np.ndarray:
    powers = np.exp(logs - logs.max(axis=1, keepdims=True))
    return powers / powers.sum(axis=1, keepdims=True)


def _matrix(column, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Lists of `k` numbers as rows, zeros for null lists, and which are not null."""
    there = column.is_valid().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), k))
    out[there] = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
    return out, there


def _parts(batches, k: int):
    """The batches in parts of about a million numbers an array."""
    step = max(1, (1 << 20) // k)
    for batch in batches:
        for a in range(0, batch.num_rows, step):
            yield batch.slice(a, step)


def fuse(rows: DataFrame, languages: list[str]) -> DataFrame:
    """Rows of (`host`, `suffix`, `declared`, `like`, ...) with `language`, `confidence` and `text_language`."""
    k, rows = len(languages), rows.drop("own", "seen", "language", "confidence", "text_language")

    def read(batches):
        for batch in _parts(batches, k):
            like = _matrix(batch.column("like"), k)[0]
            own = pa.ListArray.from_arrays(pa.array(np.arange(len(like) + 1) * k, pa.int32()), pa.array(softmax(like).reshape(-1)))
            seen = pa.array((like.max(axis=1) < 0).astype(float))
            yield pa.RecordBatch.from_arrays([*batch.columns, own, seen], names=[*batch.schema.names, "own", "seen"])

    alone = rows.mapInArrow(read, rows.withColumns({"own": F.array(F.lit(0.0)), "seen": F.lit(0.0)}).schema)
    rows = cut(alone)

    def sums(key: str, name: str, of: DataFrame) -> DataFrame:
        # by place in the array, so that the plan doesn't grow with the languages
        each = of.where(F.col(key).isNotNull() & (F.col("seen") > 0)).select(key, F.posexplode("own").alias("at", "p")).groupBy(key, "at").agg(F.sum("p").alias("p"), F.count(F.lit(1)).alias("n"))
        packed = each.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("at", "p"))).alias("all"), F.max("n").alias("_n"))
        return packed.select(key, F.transform("all", lambda x: x["p"]).alias(name), "_n")

    hosts, suffixes = sums("host", "by_host", rows), sums("suffix", "by_suffix", rows)
    shares = np.ones(k)
    for at, p in rows.where("seen > 0").select(F.posexplode("own").alias("at", "p")).groupBy("at").agg(F.sum("p")).collect():
        shares[at] += p
    # P(declared | language): soft counts by declared value, only declarations that name a language of the model
    place = {x: i for i, x in enumerate(languages)}
    known = rows.sparkSession.createDataFrame([(x,) for x in languages], "declared string")
    table = np.full((k, k), DECLARED)
    for declared, all_, _ in sums("declared", "by_declared", rows.join(F.broadcast(known), "declared", "left_semi")).collect():
        table[place[declared]] += np.array(all_)
    table = np.log(table / table.sum(axis=0, keepdims=True))
    shared = Shared(rows.sparkSession, (shares / shares.sum(), table))
    # a host or a suffix may have any share of the rows
    total = rows.count()
    joined = attach(rows, hosts, "host", ["by_host"], total, F.xxhash64("like"))
    joined = attach(joined, suffixes, "suffix", ["by_suffix"], total, F.xxhash64("like"))
    kept = [x for x in joined.columns if x not in ("like", "own", "seen", "by_host", "by_suffix")]
    none = F.lit(None).cast("string")
    schema = joined.select(*kept).withColumns({"language": none, "confidence": F.lit(None).cast("double"), "text_language": none}).schema

    def judge(batches):
        world, table = shared.value
        names = np.array(languages, object)
        for batch in _parts(batches, k):
            like, own = _matrix(batch.column("like"), k)[0], _matrix(batch.column("own"), k)[0]
            seen = batch.column("seen").to_numpy() > 0
            share = own * seen[:, None]

            def others(name):
                sums, there = _matrix(batch.column(name), k)
                return np.maximum(0.0, sums - share) * there[:, None]

            smooth = lambda counts, prior, weight: (counts + weight * prior) / (counts.sum(axis=1, keepdims=True) + weight)
            prior = smooth(others("by_host"), smooth(others("by_suffix"), world, SUFFIX), HOST)
            logs = like + np.log(prior)
            said = np.array([place.get(x, -1) for x in batch.column("declared").to_pylist()], int)
            logs[said >= 0] += table[said[said >= 0]]
            posterior = softmax(logs)
            text = pa.array(names[own.argmax(axis=1)], pa.string(), mask=~seen)
            new = [pa.array(names[posterior.argmax(axis=1)], pa.string()), pa.array(posterior.max(axis=1)), text]
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in kept), *new], names=[*kept, "language", "confidence", "text_language"])

    return joined.mapInArrow(judge, schema)


def of_pages(pages: DataFrame) -> DataFrame:
    """`page_id`, `text` (html) and the evidence columns of web pages; the suffix is the address's last label with its first folder if that is a language code."""
    host = F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/@]*@)?([^/:?#]+)", 1))
    folder = F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/]+/([a-zA-Z]{2})(?:/|$)", 1))
    label = F.element_at(F.split(host, r"\."), -1)
    clean = lambda c: F.when(F.length(c) > 0, c)
    return pages.select("page_id", clean(host).alias("host"), clean(F.concat_ws("/", clean(label), clean(folder))).alias("suffix"), clean(F.lower(F.regexp_extract("html", DECLARES, 1))).alias("declared"), F.col("html").alias("text"))


def of_documents(docs: DataFrame) -> DataFrame:
    """The same for plain documents: their source stands for the host, their declared language for the markup."""
    return docs.select("doc_id", F.col("source").alias("host"), F.lit(None).cast("string").alias("suffix"), F.when(F.trim("lang") != "", F.lower(F.trim("lang"))).alias("declared"), "text")
