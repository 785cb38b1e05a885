"""Turns in generated text: where the next one begins, whose name stands before it, and chat messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from palaver.functions import text as T

# The form of speaker tokens, brackets of names, colons, tags of the two sides.
SPEAKER_TOKEN = r"<\|spk:[^|>]+?\|>"
OPENS, CLOSES, COLON = r"[\[\(\<\{〈《【]", r"[\]\)\>\}〉》】]", r"[:：]"
TAGS = ("<U>", "<B>")


def _any(items) -> str:
    """Any of these strings, the longest first."""
    return "(?:" + "|".join(rf"\Q{x}\E" for x in sorted(set(items), key=lambda x: (-len(x), x)) if x) + ")"


def _spellings(names) -> list[str]:
    """Names as they are and with blanks for underscores."""
    return [y for x in names for y in ((x, x.strip().replace("_", " ")) if x.strip() else (x,)) if y]


def _named(names) -> str:
    """A name as a speaker mark: with a colon or a closing bracket, in brackets, or after SPK with or without angles."""
    w, name = f"{T.WS}*", _any(_spellings(names))
    spk = rf"SPK(?:[_\-]|{T.WS})*{name}{w}"
    return rf"(?iu:{name}{w}(?:{COLON}|{CLOSES}){w}|{OPENS}{w}{name}{w}{CLOSES}{w}{COLON}?{w}|<{w}{spk}>{w}{COLON}?{w}|{spk}{COLON}?{w})"


def cut_at_next_turn(c, names, fixed=("<|bos|>", "<|eos|>", "<|pad|>"), tags=TAGS) -> Column:
    """The text up to the next turn: a special or speaker token, a line that begins with a speaker mark, or a tag.

    Markers at the very beginning belong to this turn; a tag there isn't looked for again.
    """
    text = T.text_of(c)
    leading = F.length(F.regexp_extract(text, rf"^(?:{T.WS}|{_any(fixed)}|{SPEAKER_TOKEN})*", 0))
    starts = [_any(fixed[:2]), SPEAKER_TOKEN, *([rf"\n{T.WS}*{_named(names)}"] if names else [])]

    def cut(x: Column) -> Column:
        rest = x["text"].substr(x["lead"] + 1, F.length(x["text"]))
        at = lambda found, least: F.when(found > least, found)
        places = [at(F.regexp_instr(rest, F.lit("|".join(starts))), 0)]
        places += [at(F.instr(rest, mark), 1) for tag in tags if tag.strip() for mark in (f"\n{tag.strip()}", tag.strip())]
        first = F.array_min(F.array(*places))
        return F.when(first.isNull(), x["text"]).otherwise(x["text"].substr(F.lit(1), x["lead"] + first - 1))

    return T.let(F.struct(text.alias("text"), leading.alias("lead")), cut)


def strip_speaker(c, names, fixed=("<|bos|>", "<|eos|>", "<|pad|>"), tags=TAGS) -> Column:
    """Without speaker tokens, wherever they stand, and without the special tokens, speaker marks and then one of each tag at the beginning."""
    w = f"{T.WS}*"
    plain = F.regexp_replace(F.replace(T.text_of(c), F.lit("﻿"), F.lit("")), SPEAKER_TOKEN, "")
    out = F.regexp_replace(plain, rf"^(?:{T.WS}|{_any(fixed)})+", "")
    if names:
        out = F.regexp_replace(out, rf"^(?:{w}{_named(names)})+", "")
    for tag in tags:
        if tag.strip():
            out = F.regexp_replace(out, rf"^{w}\Q{tag.strip()}\E{w}", "")
    return F.regexp_replace(out, rf"^{T.WS}+", "")


def reply_text(c, names, most: int = 400, lines: bool = False) -> Column:
    """What to send of a generated text: this turn, without its speaker, sanitised."""
    return T.sanitize_text(strip_speaker(cut_at_next_turn(c, names), names), most, lines)


def chat_messages(turns, system: str, new=None, bot: str = "bot") -> Column:
    """Turns (structs of role and text) as messages of system, user and assistant, and the new user text last."""
    message = lambda role, content: F.struct(role.alias("role"), content.alias("content"))
    role = lambda t: F.when(t["role"] == bot, "assistant").otherwise("user")
    last = [F.array(message(F.lit("user"), T.text_of(new)))] if new is not None else []
    return F.concat(F.array(message(F.lit("system"), F.lit(system))), F.transform(turns, lambda t: message(role(t), T.text_of(t["text"]))), *last)


def speakers_of(given_user, given_bot, names, user: str = "", bot: str = "") -> tuple[Column, Column]:
    """User and bot of a dialogue: as given if known, else as configured if known, else the first name, and for the user the first that isn't the bot's."""
    if not names:
        raise ValueError("no speakers are known")
    names = list(names)
    standard_bot = bot if bot in names else names[0]
    standard_user = user if user in names else next((n for n in names if n != standard_bot), names[0])
    known = lambda c, standard: F.when(T.strip(T.text_of(c)).isin(*names), T.strip(T.text_of(c))).otherwise(standard)
    return known(given_user, standard_user), known(given_bot, standard_bot)


def first_of(*choices: Column) -> Column:
    """The first choice that is neither null nor blank, as paths of adapters and checkpoints are resolved."""
    return F.coalesce(*(F.when(T.strip(c) != "", c) for c in choices))


def next_stage(*, has_checkpoint, fresh, stopped, completed, adapter, cpt_first: bool = True, bootstrap: bool = True, skip: bool = True, complete: bool = True, need_adapter: bool = True, refuse_fresh: bool = True) -> Column:
    """What a two-stage training does next: abort, cpt, wait, or sft with or without an adapter to begin from.

    `stopped` and `completed` are null as long as the first stage hasn't run.
    """
    ran = F.coalesce(stopped, completed).isNotNull()
    first = F.lit(cpt_first) & ~(F.lit(skip) & has_checkpoint)
    begin = F.lit(bootstrap) & ~has_checkpoint
    return (
        F.when(has_checkpoint & F.lit(bootstrap and refuse_fresh) & fresh, "abort_fresh")
        .when(first & ~ran, "cpt").when(first & F.coalesce(stopped, F.lit(False)), "wait_stopped")
        .when(first & F.lit(complete) & ~F.coalesce(completed, F.lit(False)), "wait_incomplete")
        .when(begin & (adapter != ""), "sft_from_adapter").when(begin & F.lit(need_adapter), "abort_no_adapter").otherwise("sft")
    )
