"""WARC archives as a Spark data source, and pages written with payload revisits.

Every record is a gzip member of its own. The writer notes a member's length in
an extra field of its gzip header, so a reader that learns from the record's
headers that it does not want the record moves on without inflating the rest.
Members without the field (archives of other writers) are inflated to find
their end, but not kept. A partition is one file; the writer begins another
after ``FILE_BYTES``.

Filters on ``record_type``, ``record_id``, ``target_uri``, ``refers_to`` and
``payload_digest`` are pushed down (``spark.sql.python.filterPushdown.enabled``)
and answered from the headers. With the option ``payload=false`` no payload is
inflated at all.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from tickloom.llm.common import shared_folder

SCHEMA = "record_id string, record_type string, target_uri string, date string, refers_to string, payload_digest string, payload_length long, payload binary"
# Names of WARC headers.
HEADERS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
    "payload_length": "X-Payload-Length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Records of payloads shorter than this never refer to another.
LEAST_REVISIT = 100
#: Bytes of a file before the writer begins another.
FILE_BYTES = 32 << 20
#: Bytes read ahead, so that small records are not a request each.
AHEAD = 1 << 20
#: Bytes of payload in a batch.
BATCH_BYTES = 8 << 20
MANIFEST = "_committed-"
LEVEL = 1
# Gzip magic with deflate and FEXTRA, the subfield's name.
GZIP_EXTRA = b"\x1f\x8b\x08\x04"
SUBFIELD = b"TL"
FIXED_HEADER = 10 + 2 + 12


def member(data: bytes) -> bytes:
    """One gzip member that knows its own length."""
    squeeze = zlib.compressobj(LEVEL, zlib.DEFLATED, -15)
    body = squeeze.compress(data) + squeeze.flush()
    size = FIXED_HEADER + len(body) + 8
    extra = SUBFIELD + struct.pack("<HQ", 8, size)
    return GZIP_EXTRA + b"\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def member_length(start: bytes) -> int | None:
    """The length a member's first bytes tell, if they do."""
    if start[:4] == GZIP_EXTRA and start[12:14] == SUBFIELD:
        return struct.unpack("<Q", start[16:24])[0]
    return None


def record(fields: dict, payload: bytes | None) -> bytes:
    """The text of a record; an absent payload makes a revisit without a block body."""
    kind = fields["record_type"]
    lines = [b"WARC/1.1"]
    for name, header in HEADERS.items():
        if fields.get(name) is not None:
            lines.append(f"{header}: {_one_line(fields[name])}".encode())
    if kind == "revisit":
        lines.append(b"WARC-Profile: " + REVISIT_PROFILE.encode())
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % (fields.get("payload_length") or 0)
    block = http + (payload or b"")
    lines += [b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def _one_line(value: object) -> str:
    return str(value).replace("\r", " ").replace("\n", " ")


def parse_headers(text: bytes) -> dict[str, str]:
    lines = text.split(b"\r\n")
    if not lines[0].startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    pairs = (line.split(b":", 1) for line in lines[1:] if b":" in line)
    return {name.strip().decode().lower(): value.strip().decode("utf-8", "replace") for name, value in pairs}


@dataclass
class ArchiveFile(InputPartition):
    path: str
    size: int


class ReadAhead:
    """Random reads of a file through one block read ahead."""

    def __init__(self, file: pa.NativeFile):
        self.file, self.begin, self.data = file, 0, b""

    def read(self, at: int, count: int) -> bytes:
        if not self.begin <= at <= at + count <= self.begin + len(self.data):
            self.file.seek(at)
            self.begin, self.data = at, self.file.read(max(count, AHEAD))
        return self.data[at - self.begin : at - self.begin + count]


@dataclass
class Written(WriterCommitMessage):
    files: list


class WarcSource(DataSource):
    """``spark.read.format("warc").load(folder)``; ``df.write.format("warc").mode("append").save(folder)``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payload", "true").lower() != "false")

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are only appended to")
        return WarcWriter(self.options["path"])


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path[5:])
    return pafs.LocalFileSystem(), path


class WarcWriter(DataSourceArrowWriter):
    """Each task writes files under names of its own; the commit lists those of the tasks that counted."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, folder = filesystem(self.path)
        store.create_dir(folder, recursive=True)
        files: list[str] = []
        out, size = None, 0
        for batch in iterator:
            payloads = batch.column("payload")
            fields = batch.drop_columns(["payload"]).to_pylist()
            for row, payload in zip(fields, payloads, strict=True):
                if out is None or size >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    files.append(f"part-{uuid.uuid4().hex}.warc.gz")
                    out, size = store.open_output_stream(f"{folder}/{files[-1]}", compression=None), 0
                size += out.write(member(record(row, payload.as_py())))
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages: list) -> None:
        store, folder = filesystem(self.path)
        store.create_dir(folder, recursive=True)
        names = [f for m in messages if m is not None for f in m.files]
        with store.open_output_stream(f"{folder}/{MANIFEST}{uuid.uuid4().hex}", compression=None) as out:
            out.write(json.dumps(names).encode())

    def abort(self, messages: list) -> None:
        """Files that no manifest lists are never read."""


class WarcReader(DataSourceReader):
    """Plans parts of files; reads headers first."""

    def __init__(self, path: str, payload: bool):
        self.path, self.payload = path, payload
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters: list) -> Iterator:  # noqa: N802
        """Take equality, membership and presence of header fields; return the rest."""
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if isinstance(f, EqualTo) and name in HEADERS and name != "payload_length":
                self._want(name, {f.value})
            elif isinstance(f, In) and name in HEADERS and name != "payload_length":
                self._want(name, set(f.value))
            elif isinstance(f, IsNotNull) and name == "record_type":
                pass  # every record has one
            else:
                yield f

    def _want(self, name: str, values: set) -> None:
        self.wanted[name] = self.wanted[name] & values if name in self.wanted else values

    def partitions(self) -> list[ArchiveFile]:
        store, folder = filesystem(self.path)
        found = [i for i in store.get_file_info(pafs.FileSelector(folder)) if i.type == pafs.FileType.File]
        manifests = [i for i in found if i.base_name.startswith(MANIFEST)]
        files = [i for i in found if i.base_name.endswith((".warc.gz", ".warc"))]
        if manifests:
            listed = {name for m in manifests for name in json.loads(store.open_input_stream(m.path).read())}
            files = [i for i in files if i.base_name in listed]
        return [ArchiveFile(i.path, i.size) for i in sorted(files, key=lambda i: i.path)] or [ArchiveFile("", 0)]

    def read(self, partition: ArchiveFile) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        store, _ = filesystem(self.path)
        rows: list[dict] = []
        size = 0
        with store.open_input_file(partition.path) as file:
            for row in self.records(ReadAhead(file), partition.size):
                rows.append(row)
                size += len(row["payload"] or b"") + 500
                if size >= BATCH_BYTES:
                    yield self.batch(rows)
                    rows, size = [], 0
        if rows:
            yield self.batch(rows)

    @staticmethod
    def batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(rows, schema=ARROW_SCHEMA)

    def records(self, file: ReadAhead, size: int) -> Iterator[dict]:
        at = 0
        while at < size:
            start = file.read(at, FIXED_HEADER)
            if start[:2] == b"\x1f\x8b":
                row, at = self.member(file, at, member_length(start))
            else:
                row, at = self.plain(file, at, size)
            if row:
                yield row

    def member(self, file: ReadAhead, at: int, length: int | None) -> tuple[dict | None, int]:
        """The record of a member, if it is wanted, and where the next begins."""
        inflate = zlib.decompressobj(31)
        taken = 0

        def more(step: int) -> bytes:
            nonlocal taken
            raw = file.read(at + taken, step if length is None else min(step, length - taken))
            if not raw:
                raise ValueError("a record is cut off")
            taken += len(raw)
            return inflate.decompress(raw)

        data = b""
        while b"\r\n\r\n" not in data and not inflate.eof:
            data += more(2048)
        head, _, block = data.partition(b"\r\n\r\n")
        headers = parse_headers(head)
        wanted = self.matches(headers)
        keep = wanted and self.payload and headers.get("warc-type") != "revisit"
        if not keep and length is not None:
            return (self.row(headers, None) if wanted else None), at + length
        parts = [block]
        while not inflate.eof:
            got = more(1 << 16)
            if keep:
                parts.append(got)
        end = at + taken - len(inflate.unused_data)
        return (self.row(headers, b"".join(parts) if keep else None) if wanted else None), end

    def plain(self, file: ReadAhead, at: int, size: int) -> tuple[dict | None, int]:
        """A record of an uncompressed archive."""
        data = b""
        while b"\r\n\r\n" not in data:
            got = file.read(at + len(data), 2048)
            if not got:
                if data.strip():
                    raise ValueError("a record is cut off")
                return None, size
            data += got
        head = data.partition(b"\r\n\r\n")[0]
        headers = parse_headers(head.lstrip(b"\r\n"))
        begin, length = at + len(head) + 4, int(headers["content-length"])
        after = begin + length + 4
        if not self.matches(headers):
            return None, after
        keep = self.payload and headers.get("warc-type") != "revisit"
        return self.row(headers, file.read(begin, length) if keep else None), after

    def matches(self, headers: dict[str, str]) -> bool:
        return all(headers.get(HEADERS[name].lower()) in values for name, values in self.wanted.items())

    @staticmethod
    def row(headers: dict[str, str], block: bytes | None) -> dict:
        out = {name: headers.get(header.lower()) for name, header in HEADERS.items()}
        out["payload_length"] = int(out["payload_length"]) if out["payload_length"] is not None else None
        if block is not None:
            block = block[: int(headers["content-length"])]
            if headers.get("content-type", "").startswith("application/http"):
                block = block.partition(b"\r\n\r\n")[2]
        out["payload"] = block
        return out


ARROW_SCHEMA = pa.schema([(n, pa.int64() if n == "payload_length" else pa.string()) for n in HEADERS] + [("payload", pa.binary())])


def use_warc(spark: SparkSession) -> None:
    """Register the source and let filters reach it."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def write_pages(pages: DataFrame, path: str, key: str = "page_id", uri: str = "url", html: str = "html") -> None:
    """One record a row: a response, or a revisit of the equal payload with the smallest key.

    Payloads under 100 bytes are always responses. A null html is an empty
    payload, a null uri leaves out its header. Of rows with equal payloads all
    with the smallest key are responses (a repeated key); those with a null key
    revisit it, or are responses if no row with that payload has a key.
    """
    payload = F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).alias("id"), (F.col(uri) if uri in pages.columns else F.lit(None)).cast("string").alias("target_uri"), payload.alias("payload"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "payload_length": F.octet_length("payload").cast("long")})
    # only payloads that occur more than once have anything to refer to
    first = rows.filter(F.col("payload_length") >= LEAST_REVISIT).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("copies")).filter("copies > 1").select("digest", "first")
    joined = rows.join(first, "digest", "left").withColumn("revisit", F.col("first").isNotNull() & (F.col("id").isNull() | (F.col("id") != F.col("first"))))
    name = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    joined.select(
        F.coalesce(name(F.col("id")), F.lit("<urn:page:>")).alias("record_id"),
        F.when(F.col("revisit"), "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        F.lit("1970-01-01T00:00:00Z").alias("date"),
        F.when(F.col("revisit"), name(F.col("first"))).alias("refers_to"),
        F.concat(F.lit("sha256:"), "digest").alias("payload_digest"),
        "payload_length",
        F.when(~F.col("revisit"), F.col("payload")).alias("payload"),
    ).write.format("warc").mode("append").save(path)


def read_pages(spark: SparkSession, path: str, key: str = "page_id", key_type: str = "long") -> DataFrame:
    """What the archives say of each page: sizes and digests of responses are those of the payloads read."""
    rows = spark.read.format("warc").load(path)
    response = F.col("record_type") == "response"
    page = lambda c: F.nullif(F.regexp_extract(c, "^<urn:page:(.*)>$", 1), F.lit("")).cast(key_type)
    return rows.select(
        page("record_id").alias(key),
        F.when(response, F.octet_length("payload").cast("long")).otherwise(F.col("payload_length")).alias("payload_bytes"),
        F.when(response, F.sha2("payload", 256)).otherwise(F.regexp_extract("payload_digest", "^sha256:(.*)$", 1)).alias("payload_digest"),
        "record_type",
        page("refers_to").alias("refers_to"),
    )


def archive_pages(pages: DataFrame, key: str = "page_id", uri: str = "url", html: str = "html") -> DataFrame:
    """Write the pages as archives in shared storage and read them back."""
    spark = pages.sparkSession
    use_warc(spark)
    path = shared_folder(spark, "warc")
    write_pages(pages, path, key, uri, html)
    return read_pages(spark, path, key, pages.schema[key].dataType.simpleString())
