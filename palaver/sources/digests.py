"""Digests of files of any size: a row a file, its bytes hashed in bounded buffers.

With `parts`, a folder is one file whose parts are its files in order of name.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from palaver.sources.export_ranges import files_of, listed, together
from palaver.sources.files import file_system

#: Bytes that are read at a time; bytes of small files that one task takes together.
BUFFER, TASK = 1 << 20, 256 << 20


@dataclass
class Files(InputPartition):
    files: list[tuple[str, list[str]]]

    def __init__(self, files: list[tuple[str, list[str]]]):
        super().__init__(None)
        self.files = files


class DigestReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.task = options["path"], int(options.get("task", TASK))
        self.parts = str(options.get("parts", "false")).lower() == "true"

    def partitions(self):
        """Files in order of path, so many together as TASK bytes take; a larger one alone."""
        found = together(files_of(listed(self.path), self.parts), lambda f: sum(i.size for i in f[1]), self.task)
        return [Files([(path, [i.path for i in parts]) for path, parts in some]) for some in found]

    def read(self, part):
        system, _ = file_system(self.path)
        for path, parts in part.files if part else ():
            digest, n, lines, last = hashlib.sha256(), 0, 0, b"\n"
            for name in parts:
                with system.open_input_stream(name, compression=None) as f:
                    while data := f.read(BUFFER):
                        digest.update(data)
                        n, lines, last = n + len(data), lines + data.count(b"\n"), data[-1:]
            yield path, path.rpartition("/")[2], digest.hexdigest(), n, lines + (last != b"\n")


class DigestDataSource(DataSource):
    """`spark.read.format("file_digests")`."""

    @classmethod
    def name(cls):
        return "file_digests"

    def schema(self):
        return "path string, source_file string, sha256 string, bytes bigint, line_count bigint"

    def reader(self, schema):
        return DigestReader(self.options)


def digests(spark: SparkSession, path: str, task: int = TASK, parts: bool = False) -> DataFrame:
    """`path`, `source_file`, `sha256`, `bytes`, `line_count` (ended by line feeds, and a last one without) of a folder's or pattern's files."""
    spark.dataSource.register(DigestDataSource)
    return spark.read.format("file_digests").options(path=path, task=task, parts=parts).load()
