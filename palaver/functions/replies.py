"""Functions on generated replies, names and roles, from column to column; null reads as empty."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from palaver.functions import text as T

# Markers of prompt sections and roles, prefixes of replies, names of roles and modes.
SECTIONS = ("[SYSTEM]", "[TASK]", "[DIALOGUE]", "[ANSWER]")
ROLES = ("user:", "assistant:", "bot:", "사용자:", "봇:")
PREFIXES = ("답변:", "출력:", "assistant:", "bot:", "AI:")
BOT_NAMES, USER_NAMES = ("bot", "assistant", "ai", "b"), ("user", "human", "u", "me")
ONE_ON_ONE = ("1to1", "1:1", "one_to_one", "one_on_one", "one-on-one", "single")
LEADING_SPEAKER = rf"^{T.WS}*(?:\[[^\]\n]{{1,24}}\]|[@A-Za-z0-9_.\-가-힣]{{1,24}}){T.WS}*:{T.WS}*"


def strip_artifacts(c) -> Column:
    """The part after the last answer marker, up to the next section or role marker, without reply prefixes."""
    out = T.strip(F.substring_index(T.strip(T.text_of(c)), "[ANSWER]", -1))
    for marker in SECTIONS:
        quoted = rf"\Q{marker}\E"
        # a marker at the start goes, one further on ends the text
        out = T.strip(F.regexp_replace(out, rf"(?s)^(?:{quoted}(.*)|(.+?){quoted}.*)$", "$1$2"))
    for marker in ROLES:
        out = T.strip(F.regexp_replace(out, rf"(?ius)^(?!{marker})(.+?){marker}.*$", "$1"))
    return F.regexp_replace(out, rf"(?iu)^(?:(?:{'|'.join(PREFIXES)}){T.WS}*)+", "")


def normalize_reply(c, tags: int = 3) -> Column:
    """One line without up to `tags` speaker tags at its start."""
    out = T.one_line(c)
    for _ in range(tags):
        out = F.regexp_replace(out, LEADING_SPEAKER, "")
    return T.strip(out)


def user_turn(speaker, text, prefix: bool = True) -> Column:
    return F.concat(T.text_of(speaker), F.lit(": "), T.text_of(text)) if prefix else T.text_of(text)


def _slug(c, keep: str, ends: str, empty: str) -> Column:
    out = F.regexp_replace(F.regexp_replace(T.strip(T.text_of(c)), rf"[^{keep}]+", "_"), "_+", "_")
    out = F.btrim(out, F.lit(ends))
    return F.when(out == "", empty).otherwise(out)


def file_slug(c) -> Column:
    """Letters and digits of any script, dots and hyphens; the rest as one underscore."""
    return _slug(c, r"\p{L}\p{N}_.\-", "_.", "unknown")


def tag_slug(c) -> Column:
    return _slug(c, r"A-Za-z0-9_.\-", "_.-", "archive")


def role(speaker, bot: str = "") -> Column:
    """bot or user: by the usual names first, then by the name of this dialogue's bot; everyone else is a user."""
    name = F.lower(T.strip(T.text_of(speaker)))
    return F.when(name.isin(*BOT_NAMES), "bot").when(name.isin(*USER_NAMES), "user").when(F.lit(bool(bot)) & (T.text_of(speaker) == bot), "bot").otherwise("user")


def mode(c) -> Column:
    return F.when(F.lower(T.strip(T.text_of(c))).isin(*ONE_ON_ONE), "one_on_one").otherwise("group")


@F.pandas_udf(BooleanType())
def _alike(a: pd.Series, b: pd.Series, least: pd.Series) -> pd.Series:
    return pd.Series([x is not None and y is not None and SequenceMatcher(None, x, y).ratio() >= r for x, y, r in zip(a, b, least, strict=True)])


def shared_characters(a: Column, b: Column) -> Column:
    """How many characters two texts share, each as often as both have it: no matching of blocks can be longer."""
    times = lambda text, c: F.length(text) - F.length(F.replace(text, c, F.lit("")))
    # the texts are part of the state: they are computed once, and no lambda lies in another
    state = lambda n, a, b: F.struct(n.alias("n"), a.alias("a"), b.alias("b"))
    met = F.array_intersect(F.split(a, ""), F.split(b, ""))
    add = lambda s, c: state(s["n"] + F.least(times(s["a"], c), times(s["b"], c)), s["a"], s["b"])
    return F.aggregate(met, state(F.lit(0), a, b), add, lambda s: s["n"])


def _echo_parts(text, last, similarity: float) -> tuple[Column, Column]:
    """Whether a reply equals, holds or is held by the last one; whether only a matching of blocks can tell if they are alike."""
    pair = F.element_at(F.transform(F.array(F.struct(T.comparable(text).alias("own"), T.comparable(last).alias("prev"))), lambda p: p), 1)
    own, prev = pair["own"], pair["prev"]
    size, other = F.length(own), F.length(prev)
    long = (size >= 8) & (other >= 8)
    same = long & ((own == prev) | ((size >= 12) & (prev.contains(own) | own.contains(prev))))
    # bounds: a ratio with more matched than there can be, so none that reaches the similarity is lost
    reaches = lambda matched: F.lit(2.0) * matched / (size + other) >= F.lit(similarity)
    open_ = F.when(long & ~same & reaches(F.least(size, other)), reaches(shared_characters(own, prev)))
    return F.coalesce(same, F.lit(False)), F.coalesce(open_, F.lit(False))


def echo_undecided(text, last, similarity: float = 0.9) -> Column:
    """Whether `echoes` has to match blocks for the pair."""
    return _echo_parts(text, last, similarity)[1]


def echoes(text, last, similarity: float = 0.9) -> Column:
    """Whether a reply repeats the bot's last one: equal, held by it, holding it, or alike by matching blocks.

    Only pairs that the native tests leave open, and whose lengths and characters leave room for the ratio, reach Python.
    """
    same, open_ = _echo_parts(text, last, similarity)
    return same | _alike(F.when(open_, T.comparable(text)), F.when(open_, T.comparable(last)), F.lit(similarity))


def fallback_text(key, texts) -> Column:
    """One of the `texts`, drawn evenly by a digest of the key, so that a task run again draws the same; null if there are none."""
    texts = list(texts)
    if not texts:
        return F.lit(None).cast("string")
    drawn = F.conv(F.substring(F.sha2(T.text_of(key), 256), 1, 8), 16, 10).cast("bigint")
    return F.element_at(F.array(*map(F.lit, texts)), (drawn % len(texts) + 1).cast("int"))
