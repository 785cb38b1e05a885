"""Chat exports and UI snapshots: files to lines to messages."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from palaver.functions import text as T
from palaver.sources import export_ranges

# The encodings to try in order, the line ends, and the line patterns of the format.
ENCODINGS = ("utf-8-sig", "utf-8", "cp949", "euc-kr", "utf-16")
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"
HEADER = r"^(\d{4}\. \d{1,2}\. \d{1,2}\. \d{1,2}:\d{2}), ([^:]+) : (.*)$"
SYSTEM = r"^(\d{4}\. \d{1,2}\. \d{1,2}\. \d{1,2}:\d{2}): (.*)$"
DATE_LINE = r"^\d{4}\s*[./년]\s*\d{1,2}\s*[./월]\s*\d{1,2}"
MARKERS = r"(?iu)저장한 날짜|saved\s*date|메시지가 삭제되었습니다|deleted message|카카오톡 대화|kakaotalk chats"
#: Lines of a text that one task takes together.
LINES = 65_536
SNAPSHOT_DAY = r"^(\d{4})년 (\d{1,2})월 (\d{1,2})일"
SNAPSHOT = r"^\[([^\]]+)\] \[(오전|오후) (\d{1,2}:\d{2})\] (.*)$"


@F.pandas_udf(StringType())
def decoded(content: pd.Series) -> pd.Series:
    def one(data: bytes):
        for name in ENCODINGS:
            try:
                return data.decode(name)
            except UnicodeError:
                pass
        return None

    return content.map(one)


def files(spark: SparkSession, paths) -> DataFrame:
    """`source_file`, `text`, `rank` (place in the order of paths), an error where no file matches.

    UTF-8 is decoded in the JVM, other encodings in a vectorised function.
    """
    raw = spark.read.format("binaryFile").load(paths)
    if raw.select("path").isEmpty():
        raise ValueError(f"no file matches {paths}")
    fast = F.regexp_replace(F.decode("content", "utf-8"), "^\ufeff", "")
    valid = F.is_valid_utf8(F.col("content").cast("string"))
    order = F.row_number().over(Window.orderBy("path")) - 1  # one row a file, without its content
    ranks = raw.select("path").withColumn("rank", order.cast("bigint"))
    name = F.element_at(F.split("path", "/"), -1).alias("source_file")
    rows = raw.select("path", name, "content", valid.alias("_valid"))
    texts = rows.where("_valid").select("path", "source_file", fast.alias("text")).union(rows.where("not _valid").select("path", "source_file", decoded("content").alias("text")))
    return texts.join(ranks, "path").select("source_file", "text", "rank")


def lines(texts: DataFrame) -> DataFrame:
    return texts.select("source_file", F.posexplode(F.split("text", LINE_END, -1)).alias("line_no", "raw")).withColumn("raw", F.replace("raw", F.lit("﻿"), F.lit("")))


def messages(texts: DataFrame, include_system: bool = False) -> DataFrame:
    """Messages of export files: headers begin one, system lines end one, other lines continue it."""
    rows = lines(texts).select("source_file", (F.col("line_no") / LINES).cast("bigint").alias("range"), (F.col("line_no") % LINES).cast("bigint").alias("at"), "raw")
    return _messages(rows, ["source_file"], include_system)


def export_messages(spark: SparkSession, path: str, include_system: bool = False, split: int = export_ranges.SPLIT, parts: bool = False) -> tuple[DataFrame, list[str]]:
    """The same of a folder's or pattern's files, with their `path`, each read by ranges of `split` bytes; and the files that no encoding reads.

    With `parts`, each folder is one file, its files being the parts.
    """
    rows, lost = export_ranges.lines(spark, path, LINE_END, split, parts)
    return _messages(rows, ["path", "source_file"], include_system), lost


def _messages(rows: DataFrame, file: list[str], include_system: bool) -> DataFrame:
    """Messages of lines (`range`, `at`, `raw`).

    A range's lines are counted, and how many of them begin or end a message; sums of these over the ranges before tell each
    range its first line's number and the message that is open at its beginning.  Bad times are counted likewise over the file.
    """
    line = T.strip(F.col("raw"))
    kind = F.when(line.rlike(HEADER), "header").when(line.rlike(SYSTEM), "system").when(line == "", "blank").when(line.rlike(DATE_LINE) | line.rlike(MARKERS), "skip").otherwise("more")
    rows = rows.withColumns({"line": line, "kind": kind}).withColumn("_edge", F.col("kind").isin("header", "system").cast("int"))
    pattern = F.when(F.col("kind") == "header", F.regexp_extract("line", HEADER, 1)).when(F.col("kind") == "system", F.regexp_extract("line", SYSTEM, 1))
    ts = F.try_to_timestamp(pattern, F.lit("yyyy. M. d. H:mm")).cast("timestamp_ntz")
    bad = F.col("kind").isin(["header", "system"] if include_system else ["header"]) & ts.isNull()
    order = Window.partitionBy(*file, "range").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    past = Window.partitionBy(*file).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = rows.groupBy(*file, "range").agg(F.count(F.lit(1)).alias("_n"), F.sum("_edge").alias("_edges"), F.count_if(bad).alias("_bad"))
    ranges = ranges.select(*file, "range", *(F.coalesce(F.sum(c).over(past), F.lit(0)).alias(into) for c, into in (("_n", "_line"), ("_edges", "_block"))), F.sum("_bad").over(Window.partitionBy(*file)).alias("_lost"))
    rows = rows.withColumn("_own", F.sum("_edge").over(order)).join(ranges, [*file, "range"])
    rows = rows.withColumns({"line_no": F.col("_line") + F.col("at"), "block": F.col("_block") + F.col("_own")}).where((F.col("block") > 0) & (F.col("kind") != "skip") & (F.col("_lost") == 0))
    piece = F.when(F.col("kind") == "header", F.regexp_extract("line", HEADER, 3)).when(F.col("kind") == "system", F.regexp_extract("line", SYSTEM, 2)).when(F.col("kind") == "blank", "").otherwise(F.col("raw"))
    rows = rows.withColumns({"ts": ts, "piece": piece, "speaker": F.when(F.col("kind") == "header", T.strip(F.regexp_extract("line", HEADER, 2))).when(F.col("kind") == "system", "SYSTEM")})
    # lines that a system line ends aren't gathered
    rows = rows.withColumn("_system", F.max(F.col("kind") == "system").over(Window.partitionBy(*file, "block"))).where(~F.col("_system") | (F.col("kind") == "system"))
    item = F.struct("line_no", "piece")
    each = rows.groupBy(*file, "block").agg(F.min("line_no").alias("seq"), F.first("ts", True).alias("ts"), F.first("speaker", True).alias("speaker"), F.max("_system").alias("system"), F.array_sort(F.collect_list(item)).alias("all"))
    out = each.withColumn("text", T.strip(F.array_join(F.transform("all", lambda m: m["piece"]), "\n")))
    keep = (F.col("text") != "") & ~F.col("system")
    return out.where(keep | F.col("system") if include_system else keep).select(*file, F.col("seq").cast("bigint").alias("seq"), "ts", "speaker", "text")


def parse_errors(texts: DataFrame, include_system: bool = False) -> DataFrame:
    """`source_file`, `reason` of the files that `messages` drops: undecodable ones and those with a bad header time."""
    line = T.strip(F.col("raw"))
    kind = F.when(line.rlike(HEADER), HEADER).when(line.rlike(SYSTEM), SYSTEM) if include_system else F.when(line.rlike(HEADER), HEADER)
    stamp = F.when(kind == HEADER, F.regexp_extract(line, HEADER, 1)).when(kind == SYSTEM, F.regexp_extract(line, SYSTEM, 1))
    rows = lines(texts).withColumn("stamp", stamp).where(F.col("stamp").isNotNull() & F.try_to_timestamp("stamp", F.lit("yyyy. M. d. H:mm")).isNull())
    times = rows.groupBy("source_file").agg(F.concat(F.lit("bad time: "), F.min_by("stamp", "line_no")).alias("reason"))
    return times.union(texts.where(F.col("text").isNull()).select("source_file", F.lit("cannot be decoded").alias("reason")))


def snapshots(texts: DataFrame) -> DataFrame:
    """Messages of UI snapshots with their day, the last day line before them."""
    order = Window.partitionBy("source_file").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    rows = lines(texts).withColumn("line", T.strip(F.col("raw")))
    is_day, is_head = F.col("line").rlike(SNAPSHOT_DAY), F.col("line").rlike(SNAPSHOT)
    part = lambda k: F.lpad(F.regexp_extract("line", SNAPSHOT_DAY, k), 2, "0")
    day = F.when(is_day, F.struct(F.try_to_date(F.concat_ws("-", F.regexp_extract("line", SNAPSHOT_DAY, 1), part(2), part(3)), "yyyy-MM-dd").alias("d")))
    rows = rows.withColumns({"day": F.last(day, True).over(order)["d"], "block": F.sum((is_day | is_head).cast("int")).over(order), "head": is_head, "is_day": is_day})
    rows = rows.where(~F.col("is_day") & (F.col("line") != "")).withColumn("piece", F.when(F.col("head"), F.regexp_extract("line", SNAPSHOT, 4)).otherwise(F.col("line")))
    each = rows.groupBy("source_file", "block").agg(F.min("line_no").alias("seq"), F.max("head").alias("head"), F.first("day").alias("day"), F.min_by("line", "line_no").alias("first"), F.array_sort(F.collect_list(F.struct("line_no", "piece"))).alias("all")).where("head")
    text = T.strip(F.array_join(F.transform("all", lambda m: m["piece"]), "\n"))
    get = lambda k: F.regexp_extract("first", SNAPSHOT, k)
    out = each.select("source_file", "seq", "day", get(2).alias("ampm"), get(3).alias("hm"), get(1).alias("speaker"), text.alias("text")).where("text <> ''")
    return out.withColumn("uid", T.message_uid(F.col("day"), T.to_24h(F.col("ampm"), F.col("hm")), F.col("speaker"), F.col("text")))


def inline(c) -> Column:
    """`speaker:text||speaker:text` as an array of structs; an item without a colon is an error."""
    parts = F.transform(F.split(c, r"\|\|"), lambda x: F.split(x, ":", 2))
    return F.transform(parts, lambda p: F.struct(T.strip(p[0]).alias("speaker"), T.strip(F.when(F.size(p) == 2, F.get(p, 1)).otherwise(F.raise_error(F.lit("no colon")))).alias("text")))
