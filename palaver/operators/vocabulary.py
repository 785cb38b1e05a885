"""The byte vocabulary: special tokens first, then 256 bytes; ids, texts, prompts and example rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palaver.functions import text as T
from palaver.operators.tokens import BASE


class Vocabulary:
    """Ids of `BASE`, then of the sorted speaker tokens, then of the bytes."""

    def __init__(self, speakers: dict[str, str] | None = None):
        self.speakers = dict(speakers or {})
        self.specials = list(dict.fromkeys([*BASE, *sorted(set(self.speakers.values()))]))
        self.ids = {t: i for i, t in enumerate(self.specials)}
        self.offset = len(self.specials)
        self.size = self.offset + 256

    def token_of(self, speaker) -> Column:
        """The speaker's token, that of the unknown speaker if it has none."""
        pairs = [F.lit(x) for kv in self.speakers.items() for x in kv]
        known = F.try_element_at(F.create_map(*pairs), F.col(speaker) if isinstance(speaker, str) else speaker) if pairs else F.lit(None).cast("string")
        return F.coalesce(known, F.lit(BASE[3]))

    def encode(self, text) -> Column:
        """Ids of a text; special tokens written in it become their ids."""
        # pairs of hexadecimal digits are bytes; a match begins at a whole one, as all matches before it have whole ones
        code = {t.encode().hex().upper(): i for t, i in self.ids.items()}
        pairs = F.regexp_extract_all(F.hex(F.encode(T.text_of(text), "utf-8")), F.lit("|".join([*sorted(code, key=len, reverse=True), ".."])), 0)
        table = F.create_map(*(F.lit(x) for kv in code.items() for x in kv))
        shortest = min(map(len, code))  # a token of one byte goes before the byte

        def id_of(x):
            byte, own = F.conv(x, 16, 10).cast("int") + self.offset, F.try_element_at(table, x)
            return F.coalesce(own, byte) if shortest == 2 else F.when(F.length(x) == 2, byte).otherwise(own)

        return F.transform(pairs, id_of)

    def count(self, text) -> Column:
        """How many ids `encode` gives, without Python."""
        pattern = "|".join(rf"\Q{t}\E" for t in sorted(self.ids, key=len, reverse=True))
        return F.octet_length(F.regexp_replace(T.text_of(text), pattern, "")) + F.regexp_count(T.text_of(text), F.lit(pattern))

    def decode(self, ids) -> Column:
        """The text of ids; broken UTF-8 becomes replacement characters, ids out of range nothing."""
        table = F.array(*(F.lit(t.encode().hex()) for t in self.specials), *(F.lit(f"{b:02x}") for b in range(256)))
        data = F.unhex(F.array_join(F.transform(ids, lambda i: F.get(table, i)), ""))
        return F.coalesce(F.make_valid_utf8(data.cast("string")), F.lit(""))

    def stop_ids(self, own) -> Column:
        """Ids that end a turn: eos, bos and all speakers' tokens but one's own."""
        others = F.array(*(F.lit(t) for t in [BASE[2], BASE[1], *sorted(set(self.speakers.values()))]))
        table = F.create_map(*(F.lit(x) for kv in self.ids.items() for x in kv))
        return F.transform(F.array_except(others, F.array(self.token_of(own))), lambda t: F.element_at(table, t))

    def row(self, speaker, text) -> Column:
        """A turn as it is trained on: bos, speaker, text, eos and a line end."""
        return F.concat(F.lit(BASE[1]), self.token_of(speaker), T.text_of(text), F.lit(BASE[2] + "\n"))

    def prompt(self, turns, following) -> Column:
        """Turns (structs of speaker and text) as rows, then bos and the token of who speaks next."""
        rows = F.transform(turns, lambda t: self.row(t["speaker"], t["text"]))
        return F.concat(F.array_join(rows, ""), F.lit(BASE[1]), self.token_of(following))


def mask_of(before, target, full: bool = False) -> Column:
    """The loss mask of `before` + `target` ids: 0 and 1, or all 1."""
    return F.concat(F.array_repeat(F.lit(1 if full else 0), before), F.array_repeat(F.lit(1), target))


def aligned(ids, mask) -> Column:
    """The ids; an error where the mask has another length."""
    return F.when(F.size(ids) == F.size(mask), ids).otherwise(F.raise_error(F.lit("mask and ids differ in length")).cast("array<int>"))


def context_examples(df: DataFrame, keys: list[str], words: Vocabulary, *, turns: int = 16, least: int = 3, stride: int = 2, shortest: int = 2, full: bool = False) -> DataFrame:
    """Targets with `ids` of their context and themselves, and `mask`: 0 on the context, on the target as `mask_of` has it.

    The target's text counts as it stands; groups of one message give nothing and aren't counted.
    """
    order = Window.partitionBy(*keys).orderBy("ts", "seq")
    line = words.row(F.col("speaker"), "text")
    rows = df.withColumns({"pos": F.row_number().over(order) - 1, "_line": line}).withColumn("_before", F.collect_list("_line").over(order.rowsBetween(-turns, -1)))
    rows = rows.where((F.col("pos") >= 1) & ((F.col("pos") - 1) % max(1, stride) == 0) & (T.compact_length("text") >= shortest) & (F.size("_before") >= least))
    rows = rows.withColumn("_past", F.array_join("_before", ""))
    rows = rows.withColumns({"_ids": words.encode(F.concat("_past", "_line")), "_lead": words.count(F.concat(F.lit(BASE[1]), words.token_of(F.col("speaker")))), "_n": words.count("_line"), "_m": words.count("_past")})
    mask = F.concat(F.array_repeat(F.lit(0), F.col("_m")), mask_of(F.col("_lead"), F.col("_n") - F.col("_lead"), full))
    out = rows.withColumn("mask", mask).withColumn("ids", aligned(F.col("_ids"), F.col("mask")))
    return out.drop("_line", "_before", "_past", "_ids", "_lead", "_n", "_m")
