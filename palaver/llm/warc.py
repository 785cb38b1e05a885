"""Web archives (WARC 1.1) as a PySpark data source, and page tables to and from it.

Writing: one gzip member a record (or plain records).  Each task writes one file under a name of its
own; the commit writes the list of the files that count, so files of lost or repeated attempts are
never read.  The list also has the places at which a large file may be split, each the start of a record.  A
member's header says how long it is compressed, in the extra field "sl".

Reading: partitions are planned from that list, without opening an archive; files of others, which have none, are
read by one task each.  Members without "sl", as other programs write them, are inflated up to their end.
Equality and IN predicates on `record_type`, `page_id` and other header columns are pushed down.  A record's
header is parsed first; the payload is neither read nor inflated (with "sl") when a predicate fails or no payload
column is asked for (option `payload=false`).  Rows leave a task in Arrow batches.

`page_id` is null for records whose id isn't `<urn:page:NUMBER>`; `record_id` always has the id as it stands.
`payload_bytes` and `payload_digest` come from the header: the number is Content-Length where there is no
WARC-Payload-Length, the digest is null where there is none and has its prefix where it isn't SHA-256.

Paths may be of any file system that pyarrow knows.  Null html is an empty payload; a payload may have any
length that one row can have; repeated page ids give as many records; an empty table gives an archive without
records; extra columns of a page table aren't written.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import uuid
import zlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, In, InputPartition, WriterCommitMessage

from palaver.llm.common import attach

LIST = "_records.json"
COLUMNS = "page_id bigint, url string, record_type string, refers_to bigint, payload_digest string, payload_bytes bigint, record_id string, payload string, payload_sha256 string"
#: Bytes of an archive file that one partition reads, and bytes and rows of a batch.
SPLIT, BATCH_BYTES, BATCH_ROWS = 64 << 20, 4 << 20, 1024
HEAD = 1 << 13


PAGE = re.compile(r"<urn:page:(-?\d{1,19})>")


def file_system(uri: str):
    """The file system and path of a URI or of a local path."""
    from pyarrow import fs

    if "://" not in uri:
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


def record(row) -> bytes:
    """The record of one row: header lines, a blank line, the payload, two line ends."""
    payload = (row["payload"] or "").encode() if row["record_type"] != "revisit" else b""
    lines = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <urn:page:{row['page_id']}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if row["url"] is not None:
        lines.append("WARC-Target-URI: " + row["url"].replace("\r", "%0D").replace("\n", "%0A"))
    if row["refers_to"] is not None:
        lines += [f"WARC-Refers-To: <urn:page:{row['refers_to']}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += [f"WARC-Payload-Digest: sha256:{row['payload_digest']}", f"WARC-Payload-Length: {row['payload_bytes']}", "Content-Type: text/html", f"Content-Length: {len(payload)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member whose extra field holds its own and its content's length."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    size = 10 + 2 + 12 + len(body) + 8
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, size, len(data) & 0xFFFFFFFF) + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def _number(text: str | None) -> int | None:
    """The page of a record id that this module wrote."""
    found = PAGE.fullmatch(text or "")
    return int(found[1]) if found else None


def header(lines: bytes) -> dict[str, str]:
    """Field names, in lower case, and values of a record's header."""
    out = {}
    for line in lines.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            out[name.strip().lower()] = value.strip()
    return out


class Records:
    """Walks the records of one open file from one offset to another."""

    def __init__(self, source, start: int, stop: int):
        self.source, self.at, self.stop = source, start, stop

    def __iter__(self):
        while self.at < self.stop:
            self.source.seek(self.at)
            head = self.source.read(HEAD)
            if not head:
                return
            yield self._member(head) if head[:2] == b"\x1f\x8b" else self._plain(head)

    def _plain(self, head: bytes):
        while (end := head.find(b"\r\n\r\n")) < 0:
            if not (more := self.source.read(HEAD)):
                raise ValueError(f"the record at {self.at} has no end of header")
            head += more
        fields = header(head[:end])
        begin, size = self.at + end + 4, int(fields.get("content-length", 0))
        self.at = begin + size + 4

        def payload() -> bytes:
            self.source.seek(begin)
            return self.source.read(size)

        return fields, payload

    def _member(self, head: bytes):
        if not head[3] & 4 or head[12:14] != b"sl":
            return self._unsized()
        size = struct.unpack_from("<I", head, 16)[0]
        begin, first = self.at, head[24:]
        self.at += size
        opened = zlib.decompressobj(-15)
        text = opened.decompress(first, HEAD)
        while (end := text.find(b"\r\n\r\n")) < 0 and not opened.eof:
            text += opened.decompress(opened.unconsumed_tail or self.source.read(HEAD), HEAD)
        fields = header(text[:end])

        def payload() -> bytes:
            self.source.seek(begin + 24)
            whole = zlib.decompressobj(-15).decompress(self.source.read(size - 24))
            return whole[end + 4 : end + 4 + int(fields.get("content-length", 0))]

        return fields, payload

    def _unsized(self):
        """A member of unknown length: it is inflated to its end, and only then is the next one's start known."""
        self.source.seek(self.at)
        opened, parts, taken = zlib.decompressobj(31), [], 0
        while not opened.eof:
            more = self.source.read(1 << 16)
            if not more:
                raise ValueError(f"the member at {self.at} has no end")
            taken += len(more)
            parts.append(opened.decompress(more))
        self.at += taken - len(opened.unused_data)
        whole = b"".join(parts)
        end = whole.find(b"\r\n\r\n")
        if end < 0:
            raise ValueError(f"the record of the member that ends at {self.at} has no end of header")
        fields = header(whole[:end])
        return fields, lambda: whole[end + 4 : end + 4 + int(fields.get("content-length", 0))]


@dataclass
class Part(InputPartition):
    path: str
    start: int
    stop: int

    def __init__(self, path: str, start: int, stop: int):
        super().__init__(None)
        self.path, self.start, self.stop = path, start, stop


NAMES = [c.split()[0] for c in COLUMNS.split(", ")]


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.split = options["path"], int(options.get("split", SPLIT))
        self.payload = str(options.get("payload", "true")).lower() != "false"
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters):  # noqa: N802
        fields = {"record_type", "page_id", "refers_to", "url", "payload_digest"}
        for f in filters:
            if isinstance(f, EqualTo | In) and len(f.attribute) == 1 and f.attribute[0] in fields:
                values = set(f.value) if isinstance(f, In) else {f.value}
                own = self.wanted.setdefault(f.attribute[0], values)
                self.wanted[f.attribute[0]] = own & values
            else:
                yield f

    def partitions(self):
        from pyarrow import fs

        files, path = file_system(self.path)
        listed = files.get_file_info(f"{path}/{LIST}")
        if listed.type == fs.FileType.File:
            with files.open_input_stream(f"{path}/{LIST}") as f:
                return [p for name, splits in json.loads(f.read()) for p in self._ranges(f"{path}/{name}", splits)]
        if files.get_file_info(path).type == fs.FileType.File:
            found = [files.get_file_info(path)]
        else:
            found = sorted((i for i in files.get_file_info(fs.FileSelector(path)) if i.path.endswith((".warc", ".warc.gz"))), key=lambda i: i.path)
        return [Part(i.path, 0, i.size) for i in found if i.size]

    def _ranges(self, name: str, splits: list[int]):
        """Parts of about `split` bytes; `splits` are starts of records and, last, the file's size."""
        out, start = [], 0
        for at in splits:
            if at - start >= self.split or at == splits[-1]:
                out.append(Part(name, start, at))
                start = at
        return [p for p in out if p.stop > p.start]

    def read(self, part):
        import pyarrow as pa

        if part is None:  # an archive without files
            return
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
        schema = pa.schema(list(zip(NAMES, kinds, strict=True)))
        files, _ = file_system(self.path)
        rows, held = [], 0
        with files.open_input_file(part.path) as source:
            for fields, payload in Records(source, part.start, part.stop):
                row = self._row(fields)
                if any(row[k] not in v for k, v in self.wanted.items()):
                    continue
                body = payload() if self.payload and row["record_type"] != "revisit" else None
                if body is not None:
                    row |= {"payload": body.decode("utf-8", "replace"), "payload_sha256": hashlib.sha256(body).hexdigest()}
                    held += len(body)
                rows.append(row)
                if len(rows) >= BATCH_ROWS or held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    @staticmethod
    def _row(fields: dict[str, str]) -> dict:
        digest = fields.get("warc-payload-digest", "")
        return {
            "page_id": _number(fields.get("warc-record-id")), "url": fields.get("warc-target-uri"), "record_type": fields.get("warc-type"),
            "refers_to": _number(fields.get("warc-refers-to")), "payload_digest": digest.removeprefix("sha256:") or None,
            "payload_bytes": int(fields.get("warc-payload-length", fields.get("content-length", 0))), "record_id": fields.get("warc-record-id"),
        }


@dataclass
class Written(WriterCommitMessage):
    """A file and the places at which it may be split, its size last."""

    name: str | None
    splits: list[int]


class WarcWriter(DataSourceWriter):
    def __init__(self, options, overwrite: bool):
        self.path, self.plain, self.overwrite = options["path"], options.get("compression", "gzip") == "none", overwrite
        self.split = int(options.get("split", SPLIT))

    def write(self, iterator):
        files, path = file_system(self.path)
        files.create_dir(path, recursive=True)
        name, out = f"part-{uuid.uuid4().hex}.warc" + ("" if self.plain else ".gz"), None
        at, splits = 0, [0]
        try:
            for row in iterator:
                out = out or files.open_output_stream(f"{path}/{name}", compression=None)
                if at - splits[-1] >= self.split:
                    splits.append(at)
                data = record(row) if self.plain else member(record(row))
                out.write(data)
                at += len(data)
        finally:
            if out:
                out.close()
        return Written(name if out else None, [*splits[1:], at])

    def commit(self, messages):
        files, path = file_system(self.path)
        files.create_dir(path, recursive=True)
        names = [(m.name, m.splits) for m in messages if m and m.name]
        if not self.overwrite and files.get_file_info(f"{path}/{LIST}").size:
            with files.open_input_stream(f"{path}/{LIST}") as f:
                names += map(tuple, json.loads(f.read()))
        with files.open_output_stream(f"{path}/{LIST}.new") as f:
            f.write(json.dumps(sorted(names)).encode())
        files.move(f"{path}/{LIST}.new", f"{path}/{LIST}")

    def abort(self, messages):
        files, path = file_system(self.path)
        for m in messages:
            if m and m.name:
                files.delete_file(f"{path}/{m.name}")


class WarcDataSource(DataSource):
    """`spark.read.format("warc")` and `df.write.format("warc")`."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return COLUMNS

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def records(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", text_col: str = "html", least: int = 100) -> DataFrame:
    """What to write for each page: of equal payloads of `least` bytes or more, the smallest id answers and the others refer to it."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.sha2(text, 256).alias("payload_digest"), F.octet_length(text).cast("bigint").alias("payload_bytes"), text.alias("payload"))
    # digests that occur once need no look-up; those of very many pages are broadcast
    known = rows.where(F.col("payload_bytes") >= least)
    first = known.groupBy("payload_digest").agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    found = attach(rows, first, "payload_digest", ["_first"], rows.count(), F.col("page_id"))
    again = F.coalesce(F.col("page_id") > F.col("_first"), F.lit(False))
    return found.select(
        "page_id", "url", F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("_first")).alias("refers_to"), "payload_digest", "payload_bytes", "payload",
    )


def write(pages: DataFrame, path: str, **options) -> None:
    register(pages.sparkSession)
    records(pages, **options).write.format("warc").mode("overwrite").save(path)


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)
