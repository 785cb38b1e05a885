"""Functions for Spark SQL: text functions in the JVM and a table function of strided chunks."""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn
from pyspark.sql.types import LongType, StringType, StructField, StructType

from palaver.functions.text import WS, WS_CHARS


def _quoted(text: str) -> str:
    return "r'" + text + "'"


def _characters(text: str) -> str:
    return "'" + "".join(f"\\u{ord(c):04x}" for c in text) + "'"


LINE_FEEDS = "regexp_replace(coalesce(t, ''), r'\\r\\n?', '\\n')"
LINE = f"regexp_replace(regexp_replace({LINE_FEEDS}, {_quoted(f'{WS}*\\n+{WS}*')}, ' '), r'[ \\t]{{2,}}', ' ')"
#: SQL bodies of the scalar functions of a text `t`; they are expanded into the plan, so nothing leaves the JVM.
BODIES = {
    "compact_length": ("INT", f"length(translate(coalesce(t, ''), {_characters(WS_CHARS)}, ''))"),
    "one_line": ("STRING", f"trim(BOTH {_characters(WS_CHARS)} FROM {LINE})"),
    "mentions": ("INT", "regexp_count(coalesce(t, ''), '@[A-Za-z0-9_.\\\\-가-힣]+')"),
}


@dataclass
class Analyzed(AnalyzeResult):
    keys: list[str] = field(default_factory=list)


class Chunks:
    """`chunks(TABLE(rows), window, stride, least, shortest, longest)` of any rows with `ts`, `seq` and `line`.

    All other columns are keys: they part the rows and come back beside `start`, `message_count`, `text` and `reason`.  The rows of a
    key come in order; only the last `window` lines of it are held.
    """

    @staticmethod
    def analyze(rows: AnalyzeArgument, window, stride, least, shortest, longest) -> AnalyzeResult:
        if not rows.isTable:
            raise ValueError("the first argument must be a table")
        names = [f.name for f in rows.dataType.fields]
        if missing := {"ts", "seq", "line"} - set(names):
            raise ValueError(f"the table lacks {', '.join(sorted(missing))}")
        if any(a.value is None or a.value < 1 for a in (window, stride, least)):
            raise ValueError("window, stride and least must be 1 or more")
        keys = [f for f in rows.dataType.fields if f.name not in ("ts", "seq", "line")]
        own = [StructField("start", LongType()), StructField("message_count", LongType()), StructField("text", StringType()), StructField("reason", StringType())]
        parts = {"partitionBy": [PartitioningColumn(f.name) for f in keys]} if keys else {"withSinglePartition": True}
        return Analyzed(schema=StructType([*keys, *own]), orderBy=[OrderingColumn("ts"), OrderingColumn("seq")], keys=[f.name for f in keys], **parts)

    def __init__(self, analyzed: Analyzed):
        self.keys, self.key, self.n, self.next, self.held, self.options = analyzed.keys, None, 0, 0, None, None

    def eval(self, row, window: int, stride: int, least: int, shortest: int, longest: int):
        if self.held is None:
            self.key, self.held, self.options = [row[k] for k in self.keys], deque(maxlen=window), (window, stride, least, shortest, longest)
        self.held.append(row["line"] or "")
        self.n += 1
        if self.n == self.next + window:
            yield from self._chunk()

    def _chunk(self):
        window, stride, least, shortest, longest = self.options
        lines = list(self.held)[self.next - self.n :][:window]
        if len(lines) >= least:
            text = "\n".join(lines).strip(WS_CHARS)
            text = text[:longest].rstrip(WS_CHARS) if len(text) > longest else text
            short = len(text.translate(dict.fromkeys(map(ord, WS_CHARS)))) < shortest
            yield (*self.key, self.next, len(lines), text, "short_chunk" if short else None)
        self.next += stride

    def terminate(self):
        while self.held is not None and self.next < self.n:
            yield from self._chunk()


def register(spark: SparkSession) -> None:
    """Makes `one_line`, `compact_length`, `mentions` and the table function `chunks` known to the session's SQL."""
    from pyspark.sql.functions import udtf

    for name, (kind, body) in BODIES.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(t STRING) RETURNS {kind} RETURN {body}")
    spark.udtf.register("chunks", udtf(Chunks))
