"""Turns of a conversation: reply gate, history selection, scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palaver.functions import replies as R
from palaver.functions import text as T
from palaver.functions import turns as N


def reply_gate(df: DataFrame, *, last: int = 8, spacing: int = 4, most: int = 2, bot: str = "assistant") -> DataFrame:
    """`reply`: whether a bot may answer after this turn of a group chat."""
    order = Window.partitionBy("conv_id").orderBy("turn")
    is_bot = F.col("role") == bot
    pos = F.row_number().over(order)
    since = pos - F.max(F.when(is_bot, F.col("_pos"))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    recent = F.count_if(is_bot).over(order.rowsBetween(-(last - 1), 0))
    out = df.withColumn("_pos", pos)
    return out.withColumn("reply", ~is_bot & F.coalesce(since >= spacing, F.lit(True)) & (recent < most)).drop("_pos")


def history(df: DataFrame, *, last: int = 8, bots: int = 2, bot: str = "assistant") -> DataFrame:
    """The last turns of each conversation: at most `bots` of the bot, `last` in all."""
    back = Window.partitionBy("conv_id").orderBy(F.desc("turn"))
    seen = F.count_if(F.col("role") == bot).over(back.rowsBetween(Window.unboundedPreceding, 0))
    kept = df.withColumn("_bots", seen).where((F.col("role") != bot) | (F.col("_bots") <= bots)).drop("_bots")
    return kept.withColumn("_n", F.row_number().over(back)).where(F.col("_n") <= last).drop("_n")


def token_trim(df: DataFrame, tokens: Column, *, turns: int = 4, budget: int = 200) -> DataFrame:
    """The last 2 * turns turns; then the oldest two go as long as more than one is left and the budget is passed."""
    back = Window.partitionBy("conv_id").orderBy(F.desc("turn"))
    rows = df.withColumn("_back", F.row_number().over(back)).where(F.col("_back") <= 2 * turns).withColumn("_tokens", tokens)
    n = F.count(F.lit(1)).over(Window.partitionBy("conv_id"))
    suffix = F.sum("_tokens").over(back.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("_n", n).withColumn("_suffix", suffix)
    # what is left after k drops is a suffix of n - 2k turns: the largest that fits, or is one turn
    fits = ((F.col("_n") - F.col("_back")) % 2 == 0) & ((F.col("_suffix") <= budget) | (F.col("_back") <= 1))
    keep = F.coalesce(F.max(F.when(fits, F.col("_back"))).over(Window.partitionBy("conv_id")), F.lit(0))
    return rows.withColumn("_keep", keep).where(F.col("_back") <= F.col("_keep")).drop("_back", "_tokens", "_n", "_suffix", "_keep")


def self_echo(df: DataFrame, *, bot: str = "assistant") -> DataFrame:
    """`echo`: a bot turn equals, holds or is held by the bot's turn before."""
    bots = df.where(F.col("role") == bot).withColumn("_own", T.comparable("text"))
    last = F.lag("_own").over(Window.partitionBy("conv_id").orderBy("turn"))
    own = F.col("_own")
    test = (F.length(own) >= 8) & (F.length(last) >= 8) & ((own == last) | (F.length(own) >= 12) & (last.contains(own) | own.contains(last)))
    return bots.withColumn("echo", F.coalesce(test, F.lit(False))).drop("_own")


def score(text, echo=None) -> Column:
    """100 less 40 for a short, 25 for a summary-like, 30 for an echoing and 100 for an empty reply."""
    soft = F.when(T.looks_like_summary(text), T.soften_summary(text)).otherwise(T.text_of(text))
    points = F.lit(100) - F.when(F.length(F.replace(T.text_of(text), F.lit(" "), F.lit(""))) < 2, 40).otherwise(0) - F.when(T.looks_like_summary(text), 25).otherwise(0)
    return points - F.when(echo, 30).otherwise(0) - F.when(soft == "", 100).otherwise(0) if echo is not None else points - F.when(soft == "", 100).otherwise(0)


def scored(df: DataFrame, text: str, last: str, shortest: int = 2) -> DataFrame:
    """`score` and `reply`: points off for a short, summary-like, echoing, repetitive or empty reply, softened on the way.

    Each step is a column of its own, as the next one reads it more than once.
    """
    out = df.withColumn("_a", T.text_of(text)).withColumn("_summary", T.looks_like_summary("_a")).withColumn("_b", F.when(F.col("_summary"), T.soften_summary("_a")).otherwise(F.col("_a")))
    out = out.withColumns({"_echo": R.echoes("_b", last), "_again": T.is_repetitive("_b")}).withColumn("reply", F.when(F.col("_again"), T.soften_repetition("_b")).otherwise(F.col("_b")))
    off = lambda test, points: F.when(test, points).otherwise(0)
    short = F.length(F.replace("_a", F.lit(" "), F.lit(""))) < shortest
    points = F.lit(100) - off(short, 40) - off(F.col("_summary"), 25) - off(F.col("_echo"), 30) - off(F.col("_again"), 30) - off(F.col("reply") == "", 100)
    return out.withColumn("score", points).drop("_a", "_b", "_summary", "_echo", "_again")


def best(df: DataFrame, keys: list[str], enough: int = 100) -> DataFrame:
    """Of each request's trials up to the first that scores `enough`, the best, the earliest of equals."""
    order = Window.partitionBy(*keys).orderBy("trial")
    before = F.coalesce(F.max("score").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-(1 << 30)))
    return df.withColumn("_before", before).where(F.col("_before") < enough).groupBy(*keys).agg(F.max_by("trial", F.struct("score", -F.col("trial"))).alias("trial"), F.max("score").alias("score"))


def confidence(logs, least: int = 4) -> tuple[Column, Column]:
    """Mean log probability and its exponential within 0 and 1; (0, 1) for fewer than `least` tokens."""
    n = F.size(logs)
    mean = F.when(n >= least, F.aggregate(logs, F.lit(0.0), lambda a, x: a + x) / n).otherwise(F.lit(0.0))
    return mean, F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.exp(mean)))


def prepared(df: DataFrame, names, *, user: str = "", bot: str = "", anonymous: bool = False, turns: int = 4, budget: int = 200, tokens=None) -> DataFrame:
    """Turns as a dialogue: sanitised, empty ones dropped, of known speakers, trimmed to the last turns and the token budget.

    An unknown speaker counts as the user; `anonymous` dialogues know only the two roles.
    """
    none = F.lit(None).cast("string")
    own_user, own_bot = N.speakers_of(none, none, names, user, bot)
    side = F.when(R.role("role", bot) == "user", own_user).otherwise(own_bot)
    speaker = side if anonymous else F.when(F.col("role").isin(*names), F.col("role")).otherwise(own_user)
    rows = df.withColumn("text", T.sanitize_text("text")).where("text <> ''").withColumn("speaker", speaker)
    return token_trim(rows, F.octet_length("text") + 4 if tokens is None else tokens, turns=turns, budget=budget)
