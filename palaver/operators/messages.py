"""Message tables: drop cascade, dedup, merge, sessions, split, examples.

A message table has `source_file`, `seq`, `ts`, `speaker`, `text`; order is (`ts`, `seq`) within a file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palaver.functions import text as T
from palaver.operators.ordered import merge  # noqa: F401


#: The tests of the cascade, in their order.
CHECKS = ("empty_after_clean", "short_message", "low_signal", "summary_artifact", "mention_artifact")


def cascade(df: DataFrame, column: str = "text", *, shortest: int = 2, longest: int = 320, bullets: int = 1, mentions: int = 2, without_mentions: bool = False, checks: tuple[str, ...] = CHECKS, **clean) -> DataFrame:
    """With the text cleaned and cut, and `reason`: the first of the `checks` that drops it, null if it stays.

    `without_mentions` takes mentions out before the text is judged.  Each step is a column of its own, as the next ones read it more than once.
    """
    out = df.withColumn("_full", T.clean_message(column, **clean)).withColumn("_cut", T.truncate("_full", longest))
    if without_mentions:
        out = out.withColumn("_cut", F.when(T.count_mentions("_cut") > 0, T.strip_mentions("_cut")).otherwise(F.col("_cut")))
    out = out.withColumn("_compact", T.compact("_cut"))
    tests = {
        "empty_after_clean": F.col("_full") == "", "short_message": F.length("_compact") < shortest, "low_signal": T.is_low(F.col("_compact")),
        "summary_artifact": T.is_summary_artifact("_cut", bullets), "mention_artifact": T.count_mentions("_cut") > mentions,
    }
    reason = F.coalesce(*(F.when(tests[c], c) for c in CHECKS if c in checks), F.lit(None).cast("string"))
    return out.withColumn("reason", reason).withColumn(column, F.col("_cut")).drop("_full", "_cut", "_compact")


def dedup(df: DataFrame, keys: list[str]) -> DataFrame:
    """The row of the smallest `seq` of each key."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy("seq"))).where("_n = 1").drop("_n")


def minutes_between(before: Column, after: Column) -> Column:
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    return (micros(after) - micros(before)) / F.lit(60_000_000.0)


def _starts_so_far(df: DataFrame, starts, into: str) -> DataFrame:
    """`into`: how many rows of the file, up to this one in order, start something: `starts(last, own)` of the row before and the row.

    `last` is null for a file's first row.  Files are dealt by days, so a large file is many tasks' work; across days only a
    row a file and day is read in order.  The key is a struct, which compares equal where a part is null.
    """
    own = F.struct("ts", *(c for c in ("speaker",) if c in df.columns))
    within = Window.partitionBy("_day").orderBy("ts", "seq")
    rows = df.withColumn("_day", F.struct("source_file", F.to_date("ts").alias("day"))).withColumn("_own", own).withColumn("_last", F.lag("_own").over(within))
    rows = rows.withColumn("_new", F.when(F.col("_last").isNull(), 0).otherwise(starts(F.col("_last"), F.col("_own")).cast("int")))
    rows = rows.withColumn("_so_far", F.sum("_new").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    place = F.struct("ts", "seq")
    days = rows.groupBy("_day").agg(F.min_by("_own", place).alias("_first"), F.max_by("_own", place).alias("_end"), F.sum("_new").alias("_n"))
    across = Window.partitionBy("_day.source_file").orderBy("_day.day")
    days = days.withColumn("_lead", starts(F.lag("_end").over(across), F.col("_first")).cast("int"))
    before = F.sum(F.col("_n") + F.col("_lead")).over(across.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")
    return rows.join(days.select("_day", before.alias("_before")), "_day").withColumn(into, F.col("_before") + F.col("_so_far")).drop("_day", "_own", "_last", "_new", "_so_far", "_before")


def sessions(df: DataFrame, gap: float = 180.0) -> DataFrame:
    """With `session_index` from 0: a new session after more than `gap` minutes."""
    late = lambda last, own: F.coalesce(minutes_between(last["ts"], own["ts"]) > gap, F.lit(False))
    return _starts_so_far(df, late, "session_index").withColumn("session_index", F.col("session_index").cast("bigint"))


def _before(df: DataFrame, part: Column, order: list, weight: Column, into: str) -> DataFrame:
    """`into`: the sum of `weight` over the rows before this one, by `part` and then `order`; `_total` over all rows.

    Rows are ordered within a part only; across parts one row a part is.
    """
    rows = df.withColumn("_part", F.struct(part.alias("of"))).withColumn("_w", weight)
    past = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("_part").agg(F.sum("_w").alias("_sum")).select("_part", F.coalesce(F.sum("_sum").over(past), F.lit(0)).alias("_past"), F.sum("_sum").over(Window.partitionBy()).alias("_total"))
    own = F.sum("_w").over(Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("_own", F.coalesce(own, F.lit(0))).join(parts, "_part")
    return rows.withColumn(into, F.col("_past") + F.col("_own")).drop("_part", "_w", "_own", "_past")


def _cut_by_share(each: DataFrame, share: float, part: Column, order: list) -> DataFrame:
    """With `split`: the last `share` of the rows is val, one at least; one row alone is val."""
    placed = _before(each, part, order, F.lit(1).cast("bigint"), "_place")
    cut = F.least(F.greatest(F.floor(F.col("_total") * F.lit(1.0 - share)), F.lit(1)), F.col("_total") - 1)
    return placed.withColumn("split", F.when(F.col("_place") < cut, "train").otherwise("val")).drop("_place", "_total")


def _each_session(df: DataFrame) -> DataFrame:
    return df.groupBy("source_file", "session_index").agg(F.min("ts").alias("start_ts"), F.count(F.lit(1)).alias("n_messages"))


def session_split(df: DataFrame, share: float = 0.02) -> DataFrame:
    """Sessions in order of time with their `split`: the last `share` of them is val, one at least.

    They are ordered within the hour of their start; a file starts one session an hour at most where its gap is an hour or more.
    """
    return _cut_by_share(_each_session(df), share, F.date_trunc("hour", "start_ts"), ["start_ts", "source_file", "session_index"])


def single_split(df: DataFrame, keys: list[str], share: float = 0.02) -> DataFrame:
    """Messages of groups that are one session each, with `split`: the last `share`, two on either side at least; under four all train."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    pos = F.row_number().over(Window.partitionBy(*keys).orderBy("ts", "seq"))
    cut = F.least(F.greatest(F.floor(n * F.lit(1.0 - share)), F.lit(2)), n - 2)
    return df.withColumn("split", F.when((n < 4) | (pos <= cut), "train").otherwise("val"))


def shuffled_split(df: DataFrame, share: float = 0.02, seed: int = 42) -> DataFrame:
    """As `session_split`, with the sessions in the order of a hash of their key and the seed, 65,536 parts of it."""
    key = F.xxhash64("source_file", "session_index", F.lit(seed))
    return _cut_by_share(_each_session(df), share, F.shiftright(key, 48), [key, "source_file", "session_index"])


def contexts(df: DataFrame, keys: list[str], *, turns: int = 8, least: int = 2, stride: int = 1, shortest: int = 2) -> DataFrame:
    """Every target with its context lines and the reason that drops it, if any."""
    order = Window.partitionBy(*keys).orderBy("ts", "seq")
    line = F.concat("speaker", F.lit(": "), T.one_line("text"))
    out = df.withColumns({"pos": F.row_number().over(order) - 1, "n": F.count(F.lit(1)).over(Window.partitionBy(*keys)), "context": F.collect_list(line).over(order.rowsBetween(-turns, -1)), "response": T.one_line("text")})
    out = out.where((F.col("pos") >= 1) & ((F.col("pos") - 1) % stride == 0) | (F.col("n") < 2) & (F.col("pos") == 0))
    reason = F.when(F.col("n") < 2, "short_session").when(T.compact_length("response") < shortest, "short_target").when(F.size("context") < least, "short_context")
    return out.withColumn("reason", reason)


def chunks(df: DataFrame, keys: list[str], *, window: int = 64, stride: int = 16, least: int = 10, shortest: int = 120, longest: int = 2200, times: bool = False) -> DataFrame:
    """Strided windows of a session's messages as one text, with the reason that drops a chunk and, if asked for, its `first_ts` and `last_ts`."""
    item = F.struct("ts", "seq", F.concat("speaker", F.lit(": "), T.one_line("text")).alias("line"))
    packed = df.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("all")).where(F.size("all") >= least)
    each = packed.withColumn("start", F.explode(F.sequence(F.lit(0), F.size("all") - 1, F.lit(stride)))).withColumn("part", F.slice("all", F.col("start") + 1, window)).where(F.size("part") >= least)
    text = T.truncate(T.strip(F.array_join(F.transform("part", lambda m: m["line"]), "\n")), longest)
    span = [F.element_at("part", k)["ts"].alias(name) for k, name in ((1, "first_ts"), (-1, "last_ts")) if times]
    return each.select(*keys, "start", F.size("part").alias("message_count"), text.alias("text"), F.when(T.compact_length(text) < shortest, "short_chunk").alias("reason"), *span)


def capped(df: DataFrame, order: list[str], most: int) -> DataFrame:
    """The first `most` rows: each task passes on so many at most."""
    return df.orderBy(*order).limit(most)


def counted_to_cap(df: DataFrame, order: list[str], most: int) -> DataFrame:
    """`reason`, `n` of the targets up to the `most`-th that stays (reason null: kept); those after it aren't counted."""
    last = df.where("reason is null").select(F.struct(*order).alias("_last")).orderBy("_last").limit(most).agg(F.max("_last").alias("_last"), F.count(F.lit(1)).alias("_n"))
    rows = df.join(F.broadcast(last), (F.col("_n") < most) | (F.struct(*order) <= F.col("_last")))
    return rows.groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def flat_order(df: DataFrame) -> DataFrame:
    """`place` of every message in the flat corpus: sessions by start, file and index, each in its own order.

    Across sessions, one row a session is placed within the hour of its start, and one row an hour.
    """
    order = ["start_ts", "source_file", "session_index"]
    before = _before(_each_session(df), F.date_trunc("hour", "start_ts"), order, F.col("n_messages"), "_first").select(F.struct("source_file", "session_index").alias("_key"), "_first")
    rows = df.withColumn("_key", F.struct("source_file", "session_index"))
    own = F.row_number().over(Window.partitionBy("_key").orderBy("ts", "seq")) - 1
    return rows.withColumn("_own", own).join(before, "_key").withColumn("place", F.col("_first") + F.col("_own")).drop("_own", "_first", "_key")
