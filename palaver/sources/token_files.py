"""Flat token and mask files as a data source: ids of 16 bits and masks of 8, without delimiters between rows.

A folder holds parts (`part-X.ids` and `part-X.mask`) and `_tokens.json`: the parts in order, with the number of ids before
each.  Every task writes its own parts; the commit makes the offsets by a prefix sum of lengths, puts the list in place and
deletes what it doesn't name, so nothing of a failed or replaced attempt stays.  No row passes the driver.

The reader sees one array across all parts and returns it in blocks of `block` ids, the last one shorter: a partition is a
run of blocks, whatever parts they lie in, and reads only their bytes.  A part whose files don't have the length that the list
says, or whose mask differs from its ids in length, is an error.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan,
    LessThanOrEqual, WriterCommitMessage,
)

from palaver.sources.files import commit_list, file_system, read_list

LIST = "_tokens.json"
#: Ids of a part, ids that one partition reads, ids of a block.
PART_IDS, SPLIT, BLOCK = 1 << 27, 1 << 23, 1024
SCHEMA = pa.schema([("start", pa.int64()), ("ids", pa.list_(pa.int32())), ("mask", pa.list_(pa.int32()))])


def _flat(column: pa.ListArray, kind, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The values of all lists one after the other, and each list's length; null lists are empty."""
    lengths = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(column), 0))
    values = np.asarray(column.flatten())
    if len(values) and (values.min() < 0 or values.max() > top):
        raise ValueError(f"values must be from 0 to {top}")
    return values.astype(kind), lengths


@dataclass
class Wrote(WriterCommitMessage):
    parts: list[dict] = field(default_factory=list)


class TokenWriter(DataSourceArrowWriter):
    """Rows (ids, mask), in the order of partitions and rows."""

    def __init__(self, options):
        self.path, self.most = options["path"], int(options.get("partids", PART_IDS))

    def write(self, iterator):
        files, path = file_system(self.path)
        files.create_dir(path, recursive=True)
        done, name, n, out = [], None, 0, ()

        def close():
            for f in out:
                f.close()
            done.append({"name": name, "n_ids": n})

        for batch in iterator:
            ids, lengths = _flat(batch.column("ids"), "<u2", 0xFFFF)
            mask, others = _flat(batch.column("mask"), np.uint8, 0xFF)
            if (lengths != others).any():
                raise ValueError("mask and ids differ in length")
            at = 0
            while at < len(ids):
                if name is None:
                    name, n = f"part-{uuid.uuid4().hex}", 0
                    out = tuple(files.open_output_stream(f"{path}/{name}.{kind}", compression=None) for kind in ("ids", "mask"))
                end = min(len(ids), at + self.most - n)
                out[0].write(ids[at:end].tobytes())
                out[1].write(mask[at:end].tobytes())
                n, at = n + end - at, end
                if n == self.most:
                    close()
                    name, out = None, ()
        if name:
            close()
        return Wrote(done)

    def commit(self, messages):
        # messages come in the order of partitions
        parts, before = [p for m in messages if m for p in m.parts], 0
        for p in parts:
            p["before"], before = before, before + p["n_ids"]
        commit_list(self.path, LIST, parts, {f"{p['name']}.{kind}" for p in parts for kind in ("ids", "mask")})

    def abort(self, messages):
        files, path = file_system(self.path)
        for p in (p for m in messages if m for p in m.parts):
            for kind in ("ids", "mask"):
                files.delete_file(f"{path}/{p['name']}.{kind}")


@dataclass
class Run(InputPartition):
    """Ids `first` to `stop` of the whole array, and the parts that hold them."""

    first: int
    stop: int
    parts: list[dict]

    def __init__(self, first: int, stop: int, parts: list[dict]):
        super().__init__(None)
        self.first, self.stop, self.parts = first, stop, parts


class TokenReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.block, self.split = options["path"], int(options.get("block", BLOCK)), int(options.get("split", SPLIT))
        self.low, self.high = 0, None

    def pushFilters(self, filters):  # noqa: N802
        """Blocks are left out by the range of `start`; the filters are applied again above."""
        for f in filters:
            if f.attribute == ("start",):
                if isinstance(f, EqualTo | GreaterThan | GreaterThanOrEqual):
                    self.low = max(self.low, f.value)
                if isinstance(f, In):
                    self.low = max(self.low, min((v for v in f.value if v is not None), default=0))
                if isinstance(f, EqualTo | LessThan | LessThanOrEqual | In):
                    top = max((v for v in f.value if v is not None), default=0) if isinstance(f, In) else f.value
                    self.high = top if self.high is None else min(self.high, top)
            yield f

    def partitions(self):
        parts = read_list(self.path, LIST)
        if parts is None:
            raise ValueError(f"{self.path} has no {LIST}")
        total = sum(p["n_ids"] for p in parts)
        stop = total if self.high is None else min(total, max(0, self.high + 1))
        step, first = max(1, self.split // self.block) * self.block, self.low // self.block * self.block
        runs, k = [], 0
        for at in range(first, stop, step):
            end = min(at + step, total)
            while parts[k]["before"] + parts[k]["n_ids"] <= at:
                k += 1
            last = k
            while last + 1 < len(parts) and parts[last + 1]["before"] < end:
                last += 1
            runs.append(Run(at, end, parts[k : last + 1]))
        return runs

    def _read(self, files, path: str, run: Run, kind: str) -> np.ndarray:
        width, out = (2, []) if kind == "ids" else (1, [])
        for p in run.parts:
            with files.open_input_file(f"{path}/{p['name']}.{kind}") as f:
                if f.size() != p["n_ids"] * width:
                    raise ValueError(f"{p['name']}.{kind} has {f.size() // width} values, not {p['n_ids']}: mask and ids differ in length")
                a, b = max(0, run.first - p["before"]), min(p["n_ids"], run.stop - p["before"])
                out.append(np.frombuffer(f.read_at((b - a) * width, a * width), "<u2" if width == 2 else np.uint8))
        return np.concatenate(out).astype(np.int32)

    def read(self, run):
        if run is None:
            return
        files, path = file_system(self.path)
        ids, mask = (self._read(files, path, run, kind) for kind in ("ids", "mask"))
        edges = np.append(np.arange(0, len(ids), self.block), len(ids)).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(edges), pa.array(x)) for x in (ids, mask)]
        yield pa.RecordBatch.from_arrays([pa.array(edges[:-1].astype(np.int64) + run.first), *lists], schema=SCHEMA)


class TokenDataSource(DataSource):
    """`spark.read.format("token_files")` and `df.write.format("token_files")`."""

    @classmethod
    def name(cls):
        return "token_files"

    def schema(self):
        return "start bigint, ids array<int>, mask array<int>"

    def reader(self, schema):
        return TokenReader(self.options)

    def writer(self, schema, overwrite):
        if not overwrite:
            raise ValueError("a folder of token files is written as a whole: use mode overwrite")
        return TokenWriter(self.options)


def register(spark: SparkSession) -> None:
    """Makes the format known; a source that takes predicates needs the setting for as long as it is read."""
    spark.dataSource.register(TokenDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def write(df: DataFrame, folder: str, order: list[str], *, ids: str = "ids", mask: str = "mask", part_ids: int = PART_IDS) -> None:
    """The rows' ids and masks in the given order, one after the other."""
    register(df.sparkSession)
    rows = df.orderBy(*order).selectExpr(f"cast(`{ids}` as array<int>) AS ids", f"cast(`{mask}` as array<int>) AS mask")
    rows.write.format("token_files").option("partids", part_ids).mode("overwrite").save(folder)


def read(spark: SparkSession, folder: str, block: int = BLOCK, split: int = SPLIT) -> DataFrame:
    """Blocks of the whole array: `start` (the place of the first id), `ids`, `mask`."""
    register(spark)
    return spark.read.format("token_files").option("block", block).option("split", split).load(folder)
