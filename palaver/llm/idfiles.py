"""Token ids of whole documents in one concatenated array, with Elias-Fano coded boundaries, as a data source.

A folder holds parts in ascending order of document id and `_parts.json`, the list of those that count.  A part is

    ids of all its documents, 2 or 4 bytes each, little-endian
    ends: the number of ids up to each document's end
    keys: the document ids, from the smallest on
    a footer as JSON, its length in 4 bytes, and MAGIC

Ends and keys ascend, so both are Elias-Fano codes: of n values up to u, the lower log2(u / n) bits stand packed one
after the other, the upper ones as gaps in unary, two bits a value at most.  Every STEP-th one's place in the unary bits is
kept, so `select` of any range touches only its own bytes, and no table of 64-bit offsets exists in the file or in memory.

Writing: documents are dealt and sorted by ranges of id, each task writes one part (more if it is large) and the
commit puts the list in place, with the number of ids before each part; files of lost attempts are deleted.  Reading:
a partition is a share of a part's ids; its documents are found from the ends, and only their ids are read.  Equality, IN
and range predicates on `doc_id` are pushed down: parts are left out by their first and last id, documents by search
in the keys.  With the option `ids=false` no ids are read.

Null texts are empty; an empty text is the closing id alone; texts of any length are written whole; null ids
come first; rows that share an id stand side by side in the order of their texts' hashes; an empty table gives a list
without parts; other columns aren't written.  Document ids must be integers of 64 bits at most.
"""

from __future__ import annotations

import json
import struct
import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull,
    LessThan, LessThanOrEqual, WriterCommitMessage,
)

from palaver.llm.common import partitions
from palaver.llm.packing import CLOSING, Encoder, vocabulary
from palaver.sources.files import commit_list, file_system, read_list

LIST, MAGIC, STEP = "_parts.json", b"EFIDS\x00\x01\n", 256
#: Bytes of ids at which a task starts another part, bytes of ids that one partition reads, bytes and rows of a batch.
PART_BYTES, SPLIT, BATCH_BYTES, BATCH_ROWS = 256 << 20, 32 << 20, 4 << 20, 1024
COLUMNS = "doc_id bigint, start bigint, n_tokens bigint, ids binary"
SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


@dataclass
class EliasFano:
    """Ascending numbers below 2^64: `low` bits of each packed, the rest in unary, and the places of every STEP-th one."""

    n: int
    bits: int
    low: np.ndarray
    high: np.ndarray
    places: np.ndarray

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        shifts = np.arange(bits, dtype=np.uint64)
        low = np.packbits((values[:, None] >> shifts & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        unary = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        unary[ones] = 1
        return cls(n, bits, low, np.packbits(unary, bitorder="little"), ones[::STEP].astype("<u4" if n < 1 << 30 else "<u8"))

    def select(self, first: int, stop: int) -> np.ndarray:
        """The values from number `first` up to `stop`."""
        first, stop = max(0, first), min(stop, self.n)
        if first >= stop:
            return np.zeros(0, np.uint64)
        block, last = first // STEP, -(-stop // STEP)
        a = int(self.places[block]) // 8
        b = int(self.places[last]) // 8 + 1 if last < len(self.places) else len(self.high)
        ones = np.flatnonzero(np.unpackbits(self.high[a:b], bitorder="little")) + 8 * a
        ones = ones[np.searchsorted(ones, int(self.places[block])) :][first - block * STEP : stop - block * STEP]
        value = (ones - np.arange(first, stop)).astype(np.uint64) << np.uint64(self.bits)
        if self.bits:
            a, b = first * self.bits // 8, -(-stop * self.bits // 8)
            own = np.unpackbits(self.low[a:b], bitorder="little")[first * self.bits - 8 * a :][: (stop - first) * self.bits]
            value |= own.reshape(-1, self.bits).astype(np.uint64) @ (np.uint64(1) << np.arange(self.bits, dtype=np.uint64))
        return value

    def before(self, value: int) -> int:
        """How many of the values are less than `value`."""
        a, b = 0, self.n
        while a < b:
            m = (a + b) // 2
            a, b = (m + 1, b) if int(self.select(m, m + 1)[0]) < value else (a, m)
        return a

    def write(self, out, at: int) -> dict:
        found = {"n": self.n, "bits": self.bits, "wide": self.places.itemsize}
        for name in ("low", "high", "places"):
            data = getattr(self, name).tobytes()
            out.write(data)
            found[name] = [at, len(data)]
            at += len(data)
        return found | {"end": at}

    @classmethod
    def read(cls, source, found: dict) -> EliasFano:
        low, high, places = (source.read_at(size, at) for at, size in (found["low"], found["high"], found["places"]))
        return cls(found["n"], found["bits"], np.frombuffer(low, np.uint8), np.frombuffer(high, np.uint8), np.frombuffer(places, f"<u{found['wide']}"))


class Part:
    """A part that is open for writing: ids go to the file at once, ends and keys are kept until it is closed."""

    def __init__(self, files, folder: str, width: int):
        self.name, self.width, self.n_ids, self.ends, self.keys, self.nulls = f"part-{uuid.uuid4().hex}.ids", width, 0, [], [], 0
        self.out = files.open_output_stream(f"{folder}/{self.name}", compression=None)

    def add(self, key: int | None, ids: np.ndarray) -> None:
        if key is None and self.keys or self.keys and key < self.keys[-1]:
            raise ValueError("documents must be sorted by id")
        if self.width == 2 and len(ids) and int(ids.max()) > 0xFFFF:
            raise ValueError("an id needs more than two bytes: set the option width to 4")
        self.out.write(ids.astype(f"<u{self.width}").tobytes())
        self.n_ids += len(ids)
        self.ends.append(self.n_ids)
        if key is None:
            self.nulls += 1
        else:
            self.keys.append(key)

    def close(self) -> dict:
        least = self.keys[0] if self.keys else 0
        ends = EliasFano.of(np.array(self.ends, np.uint64)).write(self.out, self.n_ids * self.width)
        keys = EliasFano.of(np.array([k - least for k in self.keys], np.uint64)).write(self.out, ends["end"])
        footer = json.dumps({"width": self.width, "n_ids": self.n_ids, "least": least, "nulls": self.nulls, "ends": ends, "keys": keys}).encode()
        self.out.write(footer + struct.pack("<I", len(footer)) + MAGIC)
        self.out.close()
        edges = [self.keys[0], self.keys[-1]] if self.keys else None
        return {"name": self.name, "n_ids": self.n_ids, "n_docs": len(self.ends), "nulls": self.nulls, "keys": edges, "bytes": self.n_ids * self.width}


class Opened:
    """A part that is open for reading: its ends and keys, and any documents' ids."""

    def __init__(self, source):
        size = source.size()
        tail = source.read_at(12, size - 12)
        if tail[4:] != MAGIC:
            raise ValueError("not a file of token ids")
        length = struct.unpack("<I", tail[:4])[0]
        self.source, self.footer = source, json.loads(source.read_at(length, size - 12 - length))
        self.width, self.nulls, self.least = self.footer["width"], self.footer["nulls"], self.footer["least"]
        self.ends, self.keys = (EliasFano.read(source, self.footer[k]) for k in ("ends", "keys"))

    def documents(self, low: int | None, high: int | None, nulls: bool) -> tuple[int, int]:
        """First and last + 1 of the documents whose key lies from `low` to `high`; those without a key stand before all."""
        a = self.nulls + (self.keys.before(low - self.least) if low is not None else 0)
        b = self.nulls + (self.keys.before(high - self.least + 1) if high is not None else self.keys.n)
        return (0 if nulls else a), max(a, b)

    def rows(self, first: int, stop: int, base: int, with_ids: bool):
        """Batches of the documents from number `first` up to `stop`."""
        while first < stop:
            upto = min(stop, first + BATCH_ROWS)
            edges = self.ends.select(first - 1, upto).astype(np.int64)
            edges = edges if first else np.concatenate(([0], edges))
            if with_ids:  # at least one document, however long
                upto = min(upto, first + max(1, int(np.searchsorted(edges, edges[0] + BATCH_BYTES // 4, "right")) - 1))
            edges = edges[: upto - first + 1]
            keyed = (self.keys.select(first - self.nulls, upto - self.nulls) + np.uint64(self.least & (1 << 64) - 1)).astype(np.int64)
            keys = pa.array([None] * (upto - first - len(keyed)) + keyed.tolist(), pa.int64())
            ids = pa.nulls(upto - first, pa.binary())
            if with_ids:
                size = (int(edges[-1]) - int(edges[0])) * self.width
                data = np.frombuffer(self.source.read_at(size, int(edges[0]) * self.width), f"<u{self.width}").astype("<u4").tobytes()
                cuts = (edges - edges[0]) * 4
                ids = pa.array([data[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([keys, pa.array(edges[:-1] + base), pa.array(np.diff(edges)), ids], schema=SCHEMA)
            first = upto


@dataclass
class Wrote(WriterCommitMessage):
    parts: list[dict] = field(default_factory=list)


class IdWriter(DataSourceArrowWriter):
    def __init__(self, options):
        self.path, self.width = options["path"], int(options.get("width", 2))
        self.part_bytes, self.closing = int(options.get("partbytes", PART_BYTES)), int(options.get("closing", CLOSING))
        # read on the driver; executors need no copy of the file
        self.vocabulary = vocabulary(options["vocabulary"]) if "vocabulary" in options else None

    def _rows(self, iterator):
        encoder = Encoder(*self.vocabulary) if self.vocabulary else None
        for batch in iterator:
            for key, value in zip(batch.column("doc_id").to_pylist(), batch.column("text" if encoder else "ids"), strict=True):
                ids = np.array([*encoder(value.as_py() or ""), self.closing], "<u4") if encoder else np.frombuffer(value.as_buffer(), "<u4")
                yield key, ids

    def write(self, iterator):
        files, path = file_system(self.path)
        files.create_dir(path, recursive=True)
        part, done = None, []
        for key, ids in self._rows(iterator):
            part = part or Part(files, path, self.width)
            part.add(key, ids)
            if part.n_ids * self.width >= self.part_bytes:
                done.append(part.close())
                part = None
        return Wrote([*done, *([part.close()] if part else [])])

    def commit(self, messages):
        # messages come in the order of partitions, which are ranges of document ids
        parts, before, last = [p for m in messages if m for p in m.parts], 0, None
        for p in parts:
            if p["keys"] and last is not None and p["keys"][0] < last:
                raise ValueError("partitions must be ranges of document ids")
            last = p["keys"][1] if p["keys"] else last
            p["before"], before = before, before + p["n_ids"]
        commit_list(self.path, LIST, parts, {p["name"] for p in parts})

    def abort(self, messages):
        files, path = file_system(self.path)
        for p in (p for m in messages if m for p in m.parts):
            files.delete_file(f"{path}/{p['name']}")


@dataclass
class Share(InputPartition):
    """Share `k` of `of` equal shares of a part's ids."""

    name: str
    before: int
    k: int
    of: int

    def __init__(self, name: str, before: int, k: int, of: int):
        super().__init__(None)
        self.name, self.before, self.k, self.of = name, before, k, of


class IdReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.split = options["path"], int(options.get("split", SPLIT))
        self.ids = str(options.get("ids", "true")).lower() != "false"
        self.low = self.high = self.values = None
        self.nulls = True

    def pushFilters(self, filters):  # noqa: N802
        for f in filters:
            if f.attribute != ("doc_id",) or not isinstance(f, EqualTo | In | GreaterThan | GreaterThanOrEqual | LessThan | LessThanOrEqual | IsNotNull):
                yield f
                continue
            self.nulls = False
            if isinstance(f, EqualTo | In):
                own = set(f.value) if isinstance(f, In) else {f.value}
                self.values = own if self.values is None else self.values & own
            elif isinstance(f, GreaterThan | GreaterThanOrEqual):
                low = f.value + isinstance(f, GreaterThan)
                self.low = low if self.low is None else max(low, self.low)
            elif isinstance(f, LessThan | LessThanOrEqual):
                high = f.value - isinstance(f, LessThan)
                self.high = high if self.high is None else min(high, self.high)

    def _ranges(self) -> list[tuple[int | None, int | None]]:
        if self.values is None:
            return [(self.low, self.high)]
        return [(v, v) for v in sorted(self.values) if v is not None and (self.low is None or v >= self.low) and (self.high is None or v <= self.high)]

    def _met(self, part: dict) -> bool:
        a, b = part["keys"] or (None, None)
        return self.nulls and part["nulls"] or a is not None and any((low is None or b >= low) and (high is None or a <= high) for low, high in self._ranges())

    def partitions(self):
        listed = read_list(self.path, LIST)
        if listed is None:
            raise ValueError(f"{self.path} has no {LIST}")
        shares = ((p, max(1, -(-p["bytes"] // self.split))) for p in listed if self._met(p))
        return [Share(p["name"], p["before"], k, of) for p, of in shares for k in range(of)]

    def read(self, share):
        if share is None:  # no part to read
            return
        files, path = file_system(self.path)
        with files.open_input_file(f"{path}/{share.name}") as source:
            part = Opened(source)
            # a document belongs to the share in which it ends
            n, total = part.ends.n, part.footer["n_ids"]
            first, stop = (part.ends.before(total * k // share.of + 1) if 0 < k < share.of else (n if k else 0) for k in (share.k, share.k + 1))
            for low, high in self._ranges():
                a, b = part.documents(low, high, self.nulls)
                yield from part.rows(max(a, first), min(b, stop), share.before, self.ids)


class IdDataSource(DataSource):
    """`spark.read.format("token_ids")` and `df.write.format("token_ids")`, of rows (doc_id, ids), or (doc_id, text) with the option vocabulary."""

    @classmethod
    def name(cls):
        return "token_ids"

    def schema(self):
        return COLUMNS

    def reader(self, schema):
        return IdReader(self.options)

    def writer(self, schema, overwrite):
        if not overwrite:
            raise ValueError("a folder of token ids is written as a whole: use mode overwrite")
        return IdWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(IdDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def write(rows: DataFrame, folder: str, width: int = 2, part_bytes: int = PART_BYTES, **options) -> None:
    """Writes rows (doc_id, ids) that are sorted over the partitions; `width` is 2 for vocabularies of up to 65,536 ids, else 4."""
    register(rows.sparkSession)
    rows.write.format("token_ids").options(width=width, partbytes=part_bytes, **options).mode("overwrite").save(folder)


def write_texts(docs: DataFrame, path: str, folder: str, *, id_col: str = "doc_id", text_col: str = "text", closing: int = CLOSING, **options) -> None:
    """Writes the ids of whole texts by the vocabulary file at `path`, each text's followed by `closing`."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    # a hot id is spread by its texts' hashes
    laid = rows.withColumn("_hash", F.xxhash64("text")).repartitionByRange(partitions(docs.sparkSession), "doc_id", "_hash")
    write(laid.sortWithinPartitions("doc_id", "_hash").select("doc_id", "text"), folder, vocabulary=path, closing=closing, **options)


def read(spark: SparkSession, folder: str, ids: bool = True, split: int = SPLIT) -> DataFrame:
    """One row a document: its id, the number of ids before it, its number of ids, and its ids (null if `ids` is false)."""
    register(spark)
    return spark.read.format("token_ids").option("ids", str(ids).lower()).option("split", split).load(folder)
