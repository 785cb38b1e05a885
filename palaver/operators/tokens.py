"""Byte tokens, loss masks and training rows as array algebra."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palaver.functions import text as T

# The special tokens of the byte vocabulary, ids from 0.
BASE = ("<|pad|>", "<|bos|>", "<|eos|>", "<|spk:UNKNOWN|>")


def speaker_tokens(df: DataFrame) -> DataFrame:
    """`speaker`, `token`: sanitised names, a number from _2 on for names that coincide."""
    names = df.select("speaker").distinct().withColumn("name", T.sanitize_speaker("speaker"))
    k = F.row_number().over(Window.partitionBy("name").orderBy("speaker"))
    return names.select("speaker", F.concat(F.lit("<|spk:"), "name", F.when(k > 1, F.concat(F.lit("_"), k.cast("string"))).otherwise(F.lit("")), F.lit("|>")).alias("token"))


def byte_ids(text, offset: int) -> Column:
    """Ids of a text's bytes."""
    pairs = F.regexp_extract_all(F.hex(F.encode(T.text_of(text), "utf-8")), F.lit(".."), 0)
    return F.transform(pairs, lambda x: F.conv(x, 16, 10).cast("int") + offset)


def row_counts(text) -> tuple[Column, Column]:
    """Tokens of a row before and in its target: bos and speaker; bytes, eos and the line end."""
    return F.lit(2), F.octet_length(T.text_of(text)) + 2


def sft_row(prompt_ids, response_ids, most: int, eos: int) -> dict[str, Column]:
    """The response stays whole (its end, if too long), the prompt loses its beginning; labels cover the response."""
    response = F.concat(response_ids, F.array(F.lit(eos)))
    kept = F.when(F.size(response) >= most, F.slice(response, -F.lit(most), most)).otherwise(response)
    room = F.greatest(F.lit(most) - F.size(response), F.lit(0))
    head = F.when(F.size(prompt_ids) > room, F.when(room > 0, F.slice(prompt_ids, F.size(prompt_ids) - room + 1, F.greatest(room, F.lit(1)))).otherwise(F.array().cast("array<int>"))).otherwise(prompt_ids)
    ids = F.concat(head, kept)
    return {"input_ids": ids, "labels": F.concat(F.array_repeat(F.lit(-100), F.size(head)), kept), "attention_mask": F.array_repeat(F.lit(1), F.size(ids))}


def cpt_row(ids, most: int, eos: int) -> dict[str, Column]:
    most = max(8, most)
    own = F.when(F.size(ids) == 0, F.array(F.lit(eos))).otherwise(ids)
    own = F.concat(F.when(F.size(own) >= most, F.slice(own, -F.lit(most - 1), most - 1)).otherwise(own), F.array(F.lit(eos)))
    return {"input_ids": own, "labels": own, "attention_mask": F.array_repeat(F.lit(1), F.size(own))}


def pad(df: DataFrame, batch: str, pad_id: int) -> DataFrame:
    """Rows of a batch padded on the right to its longest."""
    lack = F.max(F.size("input_ids")).over(Window.partitionBy(batch)) - F.size("input_ids")
    filled = {"input_ids": pad_id, "labels": -100, "attention_mask": 0}
    return df.withColumn("_lack", lack).withColumns({c: F.concat(c, F.array_repeat(F.lit(v), F.col("_lack"))) for c, v in filled.items()}).drop("_lack")


def learning_rate(step, *, rate: float, least: float, warm_up: int, decay: int) -> Column:
    share = (step - warm_up) / F.lit(float(max(1, decay - warm_up)))
    return F.when(step < warm_up, F.lit(rate) * step / F.lit(float(max(1, warm_up)))).when(step >= decay, F.lit(least)).otherwise(F.lit(least) + 0.5 * (1 + F.cos(F.pi() * share)) * (rate - least))
