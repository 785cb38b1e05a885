"""From raw messages to training files: one plan of cleaning, dedup, merge, sessions and split, read by two kinds of examples."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.functions import text as T
from palaver.operators import messages as M
from palaver.sources import datasets

KEYS = ["source_file", "session_index"]
#: Every message stands in one session; both kinds of examples are ordered by these.
ORDER = ["start_ts", *KEYS]


@dataclass(frozen=True)
class Settings:
    """What a run can choose; defaults are those of the configured workload."""

    system: str
    task: str
    share: float = 0.02
    shuffled: bool = False
    seed: int = 42
    gap: float = 180.0
    merged: bool = True
    merge_gap: float = 2.0
    merge_longest: int = 320
    turns: int = 8
    least_turns: int = 2
    stride: int = 1
    shortest: int = 2
    shortest_target: int = 8
    longest: int = 320
    numbers: bool = False
    urls: bool = True
    media: bool = True
    bullets: int = 1
    mentions: int = 0
    without_mentions: bool = False
    checks: tuple[str, ...] = M.CHECKS
    window: int = 64
    window_stride: int = 16
    least_messages: int = 10
    shortest_chunk: int = 120
    longest_chunk: int = 2200
    cap: int = 0


def settings_of(tree: dict) -> Settings:
    """Settings from a configuration's tree of the same names; `system` and `task` must have text."""
    known = {f.name for f in fields(Settings)}
    if unknown := sorted(set(tree) - known):
        raise ValueError(f"unknown settings {unknown}")
    own = {k: tuple(v) if isinstance(v, list) else v for k, v in tree.items()}
    made = Settings(**{"system": "", "task": ""} | own)
    if not made.system.strip() or not made.task.strip():
        raise ValueError("system and task must be configured")
    return made


def judged(raw: DataFrame, s: Settings) -> DataFrame:
    """Cleaned messages with the `reason` that drops them, null if they stay."""
    return M.cascade(raw, shortest=s.shortest, longest=s.longest, bullets=s.bullets, mentions=s.mentions, without_mentions=s.without_mentions, checks=s.checks, urls=s.urls, numbers=s.numbers, media=s.media)


def distinct(kept: DataFrame) -> DataFrame:
    """The first of equal messages of a file, speaker and minute."""
    return M.dedup(kept.withColumn("_minute", F.date_trunc("minute", "ts")), ["source_file", "_minute", "speaker", "text"]).drop("_minute")


def laid_out(kept: DataFrame, s: Settings) -> DataFrame:
    """Messages with their session, its start and its split."""
    own = kept.select("source_file", "seq", "ts", "speaker", "text")
    rows = M.sessions(M.merge(own, s.merge_gap, s.merge_longest) if s.merged else own, s.gap)
    splits = M.shuffled_split(rows, s.share, s.seed) if s.shuffled else M.session_split(rows, s.share)
    return rows.join(splits.select(*KEYS, "start_ts", "split"), KEYS)


def _minute(c: str):
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm")


def examples(laid: DataFrame, s: Settings) -> DataFrame:
    """Targets with prompt, response and meta, and the reason that drops one."""
    rows = M.contexts(laid, KEYS, turns=s.turns, least=s.least_turns, stride=s.stride, shortest=s.shortest_target)
    meta = F.struct("split", "source_file", F.col("speaker").alias("target_speaker"), _minute("ts").alias("target_timestamp"), F.size("context").alias("context_turns"))
    return rows.select("split", *ORDER, F.col("pos").alias("place"), T.prompt(F.col("context"), s.system.strip(), s.task.strip()).alias("prompt"), "response", meta.alias("meta"), "reason")


def chunks(laid: DataFrame, s: Settings) -> DataFrame:
    """Windows of sessions as one text, and the reason that drops one."""
    rows = M.chunks(laid, [*KEYS, "split", "start_ts"], window=s.window, stride=s.window_stride, least=s.least_messages, shortest=s.shortest_chunk, longest=s.longest_chunk, times=True)
    meta = F.struct("split", "source_file", _minute("first_ts").alias("start_timestamp"), _minute("last_ts").alias("end_timestamp"), "message_count")
    return rows.select("split", *ORDER, F.col("start").alias("place"), "text", meta.alias("meta"), "reason")


def write(spark: SparkSession, raw: DataFrame, s: Settings, out: str) -> DataFrame:
    """Writes `out`/{train,val,cpt_train,cpt_val} as JSON lines and returns what was counted: `stage`, `what`, `n`.

    Messages with their verdicts, the kept ones and the laid out ones are tables below `out`, so no step is computed twice.
    Counts of examples are of all targets; with a `cap` they stop where it is reached.
    """

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{out}/stages/{name}")
        return spark.read.schema(df.schema).parquet(f"{out}/stages/{name}")

    all_rows = stored(judged(raw, s), "judged")
    kept = stored(distinct(all_rows.where("reason is null")), "kept")
    laid = stored(laid_out(kept, s), "messages")
    n = lambda df: df.agg(F.count(F.lit(1)).alias("n"))
    fewer = lambda a, b: n(a).union(n(b).select(-F.col("n"))).agg(F.sum("n").alias("n"))
    by = lambda df, stage, what: df.select(F.lit(stage).alias("stage"), what.alias("what"), "n")
    first = all_rows.where("reason is null")
    counted = [
        by(n(all_rows), "messages", F.lit("parsed")),
        by(all_rows.where("reason is not null").groupBy("reason").agg(F.count(F.lit(1)).alias("n")), "messages", F.col("reason")),
        by(fewer(first, kept), "messages", F.lit("deduplicated")),
        by(fewer(kept, laid), "messages", F.lit("merged_into_previous")),
        by(n(laid), "messages", F.lit("usable")),
        by(laid.select(*KEYS, "split").distinct().groupBy("split").agg(F.count(F.lit(1)).alias("n")), "sessions", F.col("split")),
    ]
    for kind, made in (("", examples(laid, s)), ("cpt_", chunks(laid, s))):
        made = stored(made, f"{kind}examples")
        for split in ("train", "val"):
            own = made.where(F.col("split") == split)
            good = own.where("reason is null")
            order = [*ORDER, "place"]
            rows = M.capped(good, order, s.cap) if s.cap > 0 else good
            datasets.write_lines(rows, f"{out}/{kind}{split}", order, keep=[c for c in ("prompt", "response", "text", "meta") if c in made.columns])
            counts = M.counted_to_cap(own, order, s.cap) if s.cap > 0 else own.groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))
            counted.append(by(counts, f"{kind}{split}", F.col("reason")))
    whole = counted[0]
    for one in counted[1:]:
        whole = whole.union(one)
    return stored(whole.coalesce(1), "counts")
