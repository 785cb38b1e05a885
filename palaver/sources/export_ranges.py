"""Lines of chat exports by byte ranges: a large file is read by as many tasks as it has ranges.

A range has the lines that begin in it; it is cut at a line feed, which no character of the encodings but UTF-16 contains, so
files of that one are read whole.  A task takes neighbouring ranges together, up to `TASK` bytes.  With `parts`, a folder is one
file whose parts are its files in order of name, each but the last ended by a line feed; such a file isn't tried as UTF-16.  `probe` tells for each range which encodings can be right; the first that holds for all
ranges of a file is the file's.  Only files of other encodings than UTF-8, one short row each, are named to the reader.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from fnmatch import fnmatchcase
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from palaver.sources.files import file_system

SPLIT, TASK, STEP, ROWS = 64 << 20, 16 << 20, 1 << 20, 10_000
#: The encodings that ranges are tried with, in order; a file that none of them reads is tried as `WHOLE`.
PLAIN, WHOLE = ("utf-8", "cp949", "euc-kr"), "utf-16"
NAMES, KINDS = ("path", "range", "at", "raw"), (pa.string(), pa.int64(), pa.int64(), pa.string())


def listed(uri: str) -> list:
    """The files of a folder, below it too, or of a pattern, in order of path; hidden ones and those with `_` left out."""
    from pyarrow import fs

    files, path = file_system(uri)
    head = re.split(r"[*?\[]", path)[0]
    base = path if head == path else head.rpartition("/")[0]
    if files.get_file_info(base).type == fs.FileType.File:
        return [files.get_file_info(base)]
    found = files.get_file_info(fs.FileSelector(base, recursive=True))
    wanted = (i for i in found if i.type == fs.FileType.File and i.base_name[0] not in "._")
    return sorted((i for i in wanted if head == path or fnmatchcase(i.path, path)), key=lambda i: i.path)


def files_of(found: list, parts: bool) -> list[tuple[str, list]]:
    """Files by path, each with its parts: with `parts` the files of a folder in order of name, or else itself."""
    if not parts:
        return [(i.path, [i]) for i in found]
    folder = lambda i: i.path.rpartition("/")[0]
    return [(k, list(g)) for k, g in groupby(sorted(found, key=lambda i: (folder(i), i.path)), key=folder)]


@dataclass
class Range:
    path: str
    file: str
    number: int
    start: int
    stop: int
    size: int
    first: bool
    last: bool


@dataclass
class Ranges(InputPartition):
    ranges: list[Range]

    def __init__(self, ranges: list[Range]):
        super().__init__(None)
        self.ranges = ranges


def together(items: list, size_of, most: int) -> list[list]:
    """Neighbours together, so many as `most` bytes take; a larger one alone."""
    out, held = [], 0
    for item in items:
        size = size_of(item)
        if out and held + size <= most:
            out[-1].append(item)
            held += size
        else:
            out.append([item])
            held = size
    return out


def _after_line(source, at: int, size: int) -> int:
    """The place after the first line feed at or after `at`."""
    step = STEP >> 8
    while at < size:
        found = source.read_at(min(step, size - at), at)
        k = found.find(b"\n")
        if k >= 0:
            return at + k + 1
        at, step = at + len(found), min(2 * step, STEP)
    return size


def _contents(files, ranges: list[Range]):
    """Each range with the bytes of the lines that begin in it and the place where they end; a file is opened once, a border looked for once."""
    source, path, at, place = None, None, None, 0
    for r in ranges:
        if r.path != path:
            if source:
                source.close()
            source, path, at = files.open_input_file(r.path), r.path, None
        begin = 0 if not r.start else place if at == r.start else _after_line(source, r.start - 1, r.size)
        end = _after_line(source, r.stop - 1, r.size) if r.stop > begin else begin
        # a line that passes over the end of this range passes over the next one's beginning too
        at, place = r.stop, end
        yield r, source.read_at(end - begin, begin) if end > begin else b"", end
    if source:
        source.close()


class ExportReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.split = options["path"], int(options.get("split", SPLIT))
        self.probe, self.parts = (str(options.get(k, "false")).lower() == "true" for k in ("probe", "parts"))
        self.known: dict = json.loads(options.get("encodings", "{}"))
        self.ends = re.compile(options["ends"])

    def partitions(self):
        found = listed(self.path)
        if not found:
            raise ValueError(f"no file matches {self.path}")
        ranges = []
        for file, parts in files_of(found, self.parts):
            number = 0
            for k, info in enumerate(parts if self.known.get(file, "") is not None else ()):
                step = max(1, info.size) if self.known.get(file) == WHOLE else self.split
                for at in range(0, max(1, info.size), step):
                    ranges.append(Range(info.path, file, number, at, min(at + step, info.size), info.size, k == 0, k == len(parts) - 1))
                    number += 1
        return [Ranges(x) for x in together(ranges, lambda r: r.stop - r.start, TASK)]

    def read(self, part):
        if part is None:  # no readable file
            return
        rows = self._probed(part.ranges) if self.probe else self._lines(part.ranges)
        while some := list(islice(rows, ROWS)):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), KINDS, strict=True)], names=list(NAMES))

    def _probed(self, ranges: list[Range]):
        whole = len(self.known) > 0
        for r, data, _ in _contents(file_system(self.path)[0], ranges):
            if (data or not r.start) and (not whole or self.known.get(r.file) == WHOLE):
                for name in [n for n in ((WHOLE,) if whole else PLAIN) if _decoded(data, n) is not None] or [None]:
                    yield r.file, r.number, 0, name

    def _lines(self, ranges: list[Range]):
        for r, data, end in _contents(file_system(self.path)[0], ranges):
            if not data and r.start:
                continue
            text = _decoded(data, self.known.get(r.file, PLAIN[0])) or ""
            lines = self.ends.split(text.removeprefix("\ufeff") if r.first and not r.start else text)
            if lines[-1] == "" and (end < r.size or not r.last):
                lines.pop()
            for at, line in enumerate(lines):
                yield r.file, r.number, at, line.replace("\ufeff", "")


def _decoded(data: bytes, encoding: str) -> str | None:
    try:
        return data.decode(encoding)
    except UnicodeError:
        return None


class ExportDataSource(DataSource):
    """`spark.read.format("chat_export_lines")`."""

    @classmethod
    def name(cls):
        return "chat_export_lines"

    def schema(self):
        return "path string, range bigint, at bigint, raw string"

    def reader(self, schema):
        return ExportReader(self.options)


def encodings(spark: SparkSession, path: str, ends: str, split: int = SPLIT, parts: bool = False) -> dict[str, str | None]:
    """The files that aren't UTF-8, with their encoding; None for those that no encoding reads."""
    spark.dataSource.register(ExportDataSource)
    found = spark.read.format("chat_export_lines").options(path=path, split=split, ends=ends, parts=parts, probe="true").load()
    ranges = found.groupBy("path").agg(F.count_distinct("range").alias("ranges"), *(F.count_if(F.col("raw") == n).alias(f"n{k}") for k, n in enumerate(PLAIN)))
    first = F.coalesce(*(F.when(F.col(f"n{k}") == F.col("ranges"), n) for k, n in enumerate(PLAIN)), F.lit(None if parts else WHOLE))
    known = {r.path: r.encoding for r in ranges.select("path", first.alias("encoding")).where(~F.col("encoding").eqNullSafe(PLAIN[0])).collect()}
    if WHOLE in known.values():
        more = spark.read.format("chat_export_lines").options(path=path, split=split, ends=ends, parts=parts, probe="true", encodings=json.dumps(known)).load()
        known |= {r.path: None for r in more.groupBy("path").agg(F.count("raw").alias("n")).where("n = 0").collect()}
    return known


def lines(spark: SparkSession, path: str, ends: str, split: int = SPLIT, parts: bool = False) -> tuple[DataFrame, list[str]]:
    """`path`, `source_file`, `range`, `at` (place in the range), `raw` of all readable files; and the paths of the others."""
    known = encodings(spark, path, ends, split, parts)
    rows = spark.read.format("chat_export_lines").options(path=path, split=split, ends=ends, parts=parts, encodings=json.dumps(known)).load()
    lost = [p for p, e in known.items() if e is None]
    return rows.select("path", F.element_at(F.split("path", "/"), -1).alias("source_file"), "range", "at", "raw"), lost
