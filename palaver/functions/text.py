"""Text functions from column to column; null reads as empty."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space that patterns, trimming and length counting share.
WS = r"[\t\n\x0B\f\r\x1c-\x20\x85\xa0  -     　]"
WS_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
# Patterns of masks, placeholders and markers.
URL = r"https?://[^\t\n\x0B\f\r\x1c-\x20\x85\xa0  -     　]+"
NUMBER = r"(?U)\b\d{3,}\b"
MEDIA = r"^(사진|동영상|음성메시지|파일|이모티콘)(:[^\n]*)?$"
MENTION = r"@[A-Za-z0-9_.\-가-힣]+"
BULLET = rf"(?dm)^{WS}*[·•\-]{WS}+"
KEYWORD = r"(?iu)(요약|정리|핵심|summary)"
LAUGH = r"^[ㅋㅎㅠㅜ]+$"
PUNCTUATION = r"^[\s~!?.…·,:;'\"()\[\]{}<>/\\\-_=+*^|`]+$"
SHORT_REPLIES = ("ㅇㅇ", "ㄱㄱ", "ㄴㄴ", "ok", "OK")
CONTROL = r"[\x00-\x08\x0b-\x1f\x7f]"
HEADINGS = rf"(?iu)(요약|정리|핵심){WS}*[:：]?"
NOT_COMPARED = r"[^A-Za-z0-9가-힣]+"
REPEATED_UNIT, REPEATED_SIGN = r"(.{2,16})(?:\1){2,}", r"(.)\1{5,}"


def let(value: Column, body) -> Column:
    """`body(value)` with the value computed once: inside a lambda an expression would run again for every item."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text_of(c) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WS_CHARS))


def line_feeds(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def mask_urls(c) -> Column:
    return F.regexp_replace(text_of(c), URL, "<URL>")


def mask_numbers(c) -> Column:
    return F.regexp_replace(text_of(c), NUMBER, "<NUM>")


def clean_message(c, urls: bool = True, numbers: bool = False, media: bool = False) -> Column:
    """Line ends, outer space, zero-width spaces and long gaps normalised; masks as asked for."""
    out = F.regexp_replace(F.replace(strip(line_feeds(text_of(c))), F.lit("\u200b"), F.lit("")), r"\n{3,}", "\n\n")
    out = mask_urls(out) if urls else out
    out = mask_numbers(out) if numbers else out
    return F.when(out.rlike(MEDIA), "").otherwise(out) if media else out


def compact(c) -> Column:
    return F.translate(text_of(c), WS_CHARS, "")


def compact_length(c) -> Column:
    return F.length(compact(c))


def truncate(c, most: int) -> Column:
    """Cut to `most` code points and right-trimmed, only if longer."""
    t = text_of(c)
    return F.when(F.length(t) > most, F.rtrim(t.substr(1, most), F.lit(WS_CHARS))).otherwise(t)


def one_line(c) -> Column:
    """Lines joined by a space, runs of blanks as one."""
    out = F.regexp_replace(line_feeds(text_of(c)), rf"{WS}*\n+{WS}*", " ")
    return strip(F.regexp_replace(out, r"[ \t]{2,}", " "))


def sanitize_line(c) -> Column:
    return strip(F.regexp_replace(F.translate(line_feeds(text_of(c)), " ", " "), "​", ""))


def one_line_response(c) -> Column:
    """Blank lines dropped and all white space as single blanks: the form that training responses take."""
    return strip(F.regexp_replace(sanitize_line(c), rf"{WS}+", " "))


def sanitize_text(c, most: int = 0, lines: bool = False) -> Column:
    """Without control characters, which go before lines are joined and blanks are collapsed; cut to `most`, if that isn't 0.

    `lines` keeps line ends, without blanks around them and two at most.
    """
    out = F.regexp_replace(F.translate(line_feeds(text_of(c)), "\u00a0\u200b", " "), CONTROL, "")
    if lines:
        out = F.regexp_replace(F.regexp_replace(out, r"[ \t]*\n[ \t]*", "\n"), r"\n{3,}", "\n\n")
    else:
        out = F.regexp_replace(out, rf"{WS}*\n+{WS}*", " ")
    out = strip(F.regexp_replace(out, r"[ \t]{2,}", " "))
    return truncate(out, most) if most > 0 else out


def count_mentions(c) -> Column:
    return F.regexp_count(text_of(c), F.lit(MENTION))


def tidy(c: Column) -> Column:
    out = F.regexp_replace(F.regexp_replace(c, r"[ \t]{2,}", " "), rf"{WS}*([,;:]){WS}*", "$1 ")
    return F.btrim(out, F.lit(" \t,;:"))


def strip_mentions(c) -> Column:
    return tidy(F.regexp_replace(text_of(c), MENTION, ""))


def trim_mentions(c, keep: int) -> Column:
    """All mentions but the first `keep` removed (none removed below 0)."""
    if keep < 0:
        return text_of(c)
    both = F.struct(F.split(text_of(c), MENTION, -1).alias("parts"), F.regexp_extract_all(text_of(c), F.lit(f"({MENTION})"), 1).alias("found"))
    mention = lambda x, i: F.when(i < keep, F.coalesce(F.get(x["found"], i), F.lit(""))).otherwise(F.lit(""))
    return tidy(let(both, lambda x: F.array_join(F.transform(x["parts"], lambda p, i: F.concat(p, mention(x, i))), "")))


def bullets(c) -> Column:
    return F.regexp_count(strip(line_feeds(text_of(c))), F.lit(BULLET))


def is_low_signal(c) -> Column:
    return is_low(compact(c))


def is_low(x: Column) -> Column:
    """The same of a text without white space."""
    return (x == "") | (F.upper(x) == "<URL>") | ((F.length(x) <= 8) & x.rlike(LAUGH)) | ((F.length(x) <= 10) & x.rlike(PUNCTUATION)) | x.isin(*SHORT_REPLIES)


def is_summary_artifact(c, least: int = 1) -> Column:
    n = bullets(c)
    return (n >= max(1, least)) | ((n > 0) & text_of(c).rlike(KEYWORD))


def looks_like_summary(c) -> Column:
    """The reply-side test: one bullet, or a keyword in a text of 20 characters or more."""
    x = strip(line_feeds(text_of(c)))
    return (F.regexp_count(x, F.lit(BULLET)) >= 1) | (x.rlike(KEYWORD) & (F.length(x) >= 20))


def soften_summary(c) -> Column:
    out = F.regexp_replace(F.regexp_replace(strip(text_of(c)), BULLET, ""), HEADINGS, "")
    return F.btrim(F.regexp_replace(out, r"[ \t]{2,}", " "), F.lit(" \t,;:"))


def comparable(c) -> Column:
    return F.regexp_replace(F.lower(text_of(c)), NOT_COMPARED, "")


def words(c) -> Column:
    return F.array_remove(F.split(text_of(c), rf"{WS}+"), "")


def run_capped(tokens: Column, most: int = 2) -> Column:
    """Tokens whose run of equal ones is at most `most` long so far."""
    # the array is bound to a variable: inside the filter, its expression would run again for every token
    same = lambda w, t, i: sum(((F.get(w, i - k) == t).cast("int") for k in range(1, most + 1)), F.lit(0)).eqNullSafe(most)
    return let(tokens, lambda w: F.filter(w, lambda t, i: (i < most) | ~same(w, t, i)))


def soften_repetition(c) -> Column:
    return strip(F.regexp_replace(F.array_join(run_capped(words(c)), " "), REPEATED_SIGN, "$1$1$1"))


def distinct_ratio(tokens: Column) -> Column:
    return F.size(F.array_distinct(tokens)) / F.greatest(F.size(tokens), F.lit(1))


def top_ngram(tokens: Column, n: int) -> Column:
    """How often the most frequent run of n tokens occurs: equal ones stand together once they are sorted."""
    places = F.sequence(F.lit(0), F.greatest(F.size(tokens) - n, F.lit(0)))
    grams = let(tokens, lambda w: F.when(F.size(w) >= n, F.transform(places, lambda i: F.array_join(F.slice(w, i + 1, n), "\x1f"))).otherwise(F.array().cast("array<string>")))
    start = F.struct(F.lit(None).cast("string").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("most"))

    def step(done, gram):
        run = F.when(gram.eqNullSafe(done["last"]), done["run"] + 1).otherwise(1)
        return F.struct(gram.alias("last"), run.alias("run"), F.greatest(done["most"], run).alias("most"))

    return F.aggregate(F.array_sort(grams), start, step, lambda done: done["most"])


def is_repetitive(c) -> Column:
    """A unit said three times in a row, few distinct words (in their case), or one dominant 2- or 3-gram."""

    def of(tokens: Column) -> Column:
        n = F.size(tokens)
        grams = [(n >= 3 * k) & let(top_ngram(tokens, k), lambda top: (top >= 3) & (top >= F.floor((n - k + 1) * F.lit(0.5)))) for k in (2, 3)]
        return (n >= 10) & ((distinct_ratio(tokens) < F.lit(0.55)) | grams[0] | grams[1])

    return compact(c).rlike(REPEATED_UNIT) | let(words(c), of)


def sanitize_speaker(c) -> Column:
    out = F.regexp_replace(strip(F.regexp_replace(text_of(c), r"[|<>\r\n\t]", "")), rf"{WS}+", "_")
    return F.when(out == "", "UNKNOWN").otherwise(out)


def to_24h(half, time) -> Column:
    """`half` is 오전 or 오후; `time` is h:mm."""
    hour, minute = F.split(time, ":")[0].cast("int"), F.split(time, ":")[1]
    hour = F.when((half == "오후") & (hour < 12), hour + 12).when((half == "오전") & (hour == 12), 0).otherwise(hour)
    return F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":"), F.lpad(minute, 2, "0"))


def message_uid(day, time, speaker, text) -> Column:
    flat = lambda c: strip(F.regexp_replace(text_of(c), rf"{WS}+", " "))
    return F.sha1(F.concat_ws("|", F.coalesce(day.cast("string"), F.lit("unknown-day")), time, flat(speaker), flat(text)))


def prompt(context: Column, system: str, task: str) -> Column:
    """Template over lines of "speaker: text"."""
    return F.concat(F.lit(f"[SYSTEM]\n{system.strip()}\n\n[TASK]\n{task.strip()}\n\n[DIALOGUE]\n"), F.array_join(context, "\n"), F.lit("\n\n[ANSWER]\n"))
