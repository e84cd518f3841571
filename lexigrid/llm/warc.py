"""WARC archives as a PySpark data source, ``format("warc")``, for reading and writing.

Writing: one gzip member per record.  A task starts a new file at
``max_file_bytes``, so a file is what one read task handles.  Files get their
final name when the job commits; a task that is run again leaves nothing twice.

Reading: files are planned into partitions of about ``partition_bytes``.
Filters on ``record_type`` and on headers (``target_uri``, ``record_id``,
``refers_to``, ``payload_digest``, ``warc_date``) are pushed down.  Headers come
first: the payload of a record is decoded only if the record passes and the
payload is asked for (option ``payload``); else its member is inflated in pieces
and dropped, in bounded memory.

Paths are read through ``pyarrow.fs``: local and shared folders, and the stores
it supports.  Null payloads are empty, null URIs and digests leave the header
out and come back as null.  Extra input columns are ignored, repeated rows are
records of their own, an empty table gives an empty folder and no records.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage,
)

from lexigrid.llm.common import text_of
from lexigrid.session import fresh_dir, written

SCHEMA = (
    "record_id string, record_type string, target_uri string, warc_date string, refers_to string, "
    "payload_digest string, payload_bytes bigint, payload binary"
)
_KINDS = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
_ARROW = pa.schema([(name, _KINDS[kind]) for name, kind in (c.split() for c in SCHEMA.split(", "))])
MAX_FILE_BYTES = 64 << 20
PARTITION_BYTES = 64 << 20
_PIECE = 1 << 20
_HEADERS = {
    "WARC-Record-ID": "record_id", "WARC-Type": "record_type", "WARC-Target-URI": "target_uri", "WARC-Date": "warc_date",
    "WARC-Refers-To": "refers_to", "WARC-Payload-Digest": "payload_digest",
}
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def digest_of(payload: bytes) -> str:
    """Base32 SHA-1, upper case."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(row: dict) -> bytes:
    """A record as a gzip member; a revisit has the headers of its payload and no payload."""
    payload = row["payload"] or b""
    revisit = row["record_type"] == "revisit"
    head = ["WARC/1.1"]
    for header, column in _HEADERS.items():
        if row.get(column) is not None:
            # a line end in a value would end the header
            head.append(f"{header}: {str(row[column]).replace('%', '%25').replace(chr(13), '%0D').replace(chr(10), '%0A')}")
    if revisit:
        head.append(f"WARC-Profile: {_PROFILE}")
    head += [f"X-Payload-Bytes: {len(payload)}", "Content-Type: text/html; charset=utf-8", f"Content-Length: {0 if revisit else len(payload)}"]
    squeeze = zlib.compressobj(1, zlib.DEFLATED, 31)
    body = b"" if revisit else payload
    return squeeze.compress("\r\n".join(head).encode() + b"\r\n\r\n") + squeeze.compress(body) + squeeze.compress(b"\r\n\r\n") + squeeze.flush()


@dataclass
class _Written(WriterCommitMessage):
    files: list[str]


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, max_file_bytes: int):
        self.path, self.max_file_bytes = path, max_file_bytes

    def write(self, batches: Iterator[pa.RecordBatch]) -> _Written:
        store, folder = filesystem(self.path)
        store.create_dir(folder, recursive=True)
        files, out, size, attempt = [], None, 0, uuid.uuid4().hex
        for batch in batches:
            for i in range(batch.num_rows):
                data = record_bytes({c: batch.column(c)[i].as_py() for c in batch.schema.names})
                if out is None or size + len(data) > self.max_file_bytes:
                    if out:
                        out.close()
                    files.append(f"part-{attempt}-{len(files):05d}.warc.gz")
                    out, size = store.open_output_stream(f"{folder}/.{files[-1]}", compression=None), 0
                out.write(data)
                size += len(data)
        if out:
            out.close()
        return _Written(files)

    def commit(self, messages: list[_Written | None]) -> None:
        store, folder = filesystem(self.path)
        store.create_dir(folder, recursive=True)
        for message in filter(None, messages):
            for name in message.files:
                store.move(f"{folder}/.{name}", f"{folder}/{name}")

    def abort(self, messages: list[_Written | None]) -> None:
        store, folder = filesystem(self.path)
        for message in filter(None, messages):
            for name in message.files:
                store.delete_file(f"{folder}/.{name}")


@dataclass
class _Files(InputPartition):
    names: list[str]

    def __post_init__(self):
        super().__init__(self.names)


class _Inflated:
    """The content of one gzip member after another, in pieces."""

    def __init__(self, raw):
        self.raw, self.data, self.out, self.unzip = raw, b"", b"", None

    def next_member(self) -> bool:
        """Skips what is left of the member; False at the end of the file."""
        while self.unzip and not self.unzip.eof:
            self.out = b""
            self._more()
        self.out = b""
        self.data = self.data or self.raw.read(_PIECE)
        self.unzip = zlib.decompressobj(31)
        return bool(self.data)

    def _more(self) -> None:
        self.data = self.data or self.raw.read(_PIECE)
        piece = self.unzip.decompress(self.data, _PIECE)
        if not self.data and not piece and not self.unzip.eof:
            raise EOFError("a record is cut off")
        self.out += piece
        self.data = self.unzip.unused_data if self.unzip.eof else self.unzip.unconsumed_tail

    def head(self) -> bytes:
        while (end := self.out.find(b"\r\n\r\n")) < 0:
            self._more()
        head, self.out = self.out[:end], self.out[end + 4 :]
        return head

    def body(self, n: int) -> bytes:
        parts, have = [self.out], len(self.out)
        while have < n:
            self.out = b""
            self._more()
            parts.append(self.out)
            have += len(self.out)
        self.out = b""
        return b"".join(parts)[:n]


def _parsed(head: bytes) -> dict:
    row = dict.fromkeys(_HEADERS.values())
    for line in head.decode().split("\r\n")[1:]:
        name, _, value = line.partition(": ")
        if name in _HEADERS:
            row[_HEADERS[name]] = value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
        elif name == "X-Payload-Bytes":
            row["payload_bytes"] = int(value)
        elif name == "Content-Length":
            row["length"] = int(value)
    return row


def read_records(raw, keep=lambda row: True, payload: bool = True) -> Iterator[dict]:
    """The records of an open archive that ``keep`` accepts by their headers."""
    stream = _Inflated(raw)
    while stream.next_member():
        row = _parsed(stream.head())
        row.setdefault("payload_bytes", row.get("length", 0))
        if keep(row):
            row["payload"] = stream.body(row["length"]) if payload and row["record_type"] != "revisit" else None
            yield row


class _Reader(DataSourceReader):
    def __init__(self, path: str, payload: bool, partition_bytes: int):
        self.path, self.payload, self.partition_bytes = path, payload, partition_bytes
        self.allowed: list[tuple[str, frozenset]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if column in _HEADERS.values():
                self.allowed.append((column, frozenset([f.value] if isinstance(f, EqualTo) else f.value)))
            else:
                yield f  # Spark applies it

    def partitions(self) -> list[_Files]:
        store, folder = filesystem(self.path)
        infos = store.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
        files = sorted((i.path, i.size) for i in infos if i.base_name.endswith(".warc.gz") and i.base_name[0] != ".")
        groups, size = [], 0
        for name, n in files:
            if not groups or size + n > self.partition_bytes:
                groups.append([])
                size = 0
            groups[-1].append(name)
            size += n
        return [_Files(g) for g in groups] or [_Files([])]

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        store, _ = filesystem(self.path)
        keep = lambda row: all(row[c] in values for c, values in self.allowed)
        rows, size = [], 0
        for name in partition.names:
            with store.open_input_stream(name, compression=None) as raw:
                for row in read_records(raw, keep, self.payload):
                    rows.append(row)
                    size += len(row["payload"] or b"") + 500
                    if size >= 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)


class DataSourceWarc(DataSource):
    """Options: ``path``; reading ``payload`` (true), ``partition_bytes``; writing ``max_file_bytes``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        payload = str(self.options.get("payload", "true")).lower() == "true"
        return _Reader(self.options["path"], payload, int(self.options.get("partition_bytes", PARTITION_BYTES)))

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"], int(self.options.get("max_file_bytes", MAX_FILE_BYTES)))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(DataSourceWarc)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def _record_uuid(key: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), key, F.lit(">"))


def records(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0) -> DataFrame:
    """Pages as WARC records.

    Of pages with equal payloads of at least ``least_bytes``, that with the smallest ID is the
    response and the others revisit it.  Rows that share that ID, or have none to refer to, are all responses.
    Only digests and IDs are shuffled to find them; the digests that occur twice are joined
    to the pages with a salt, so that a payload of a third of all pages is spread.
    """
    payload = text_of(html).cast("binary")
    firsts = (
        pages.select(F.sha1(payload).alias("sha1_"), F.octet_length(payload).alias("size"), F.col(id).alias("id"))
        .where(F.col("size") >= least_bytes).groupBy("sha1_").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    )
    salts = 16
    firsts = written(firsts.select("sha1_", "first"), "warc-firsts").withColumn("salt_", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rows = pages.select(
        F.col(id).alias("id"), F.col(url).cast("string").alias("target_uri"), payload.alias("payload"), F.sha1(payload).alias("sha1"),
        F.pmod(F.xxhash64(F.col(id)), F.lit(salts)).cast("int").alias("salt"),
    )
    joined = rows.join(firsts, (F.col("sha1") == F.col("sha1_")) & (F.col("salt") == F.col("salt_")), "left")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    return joined.select(
        _record_uuid(F.coalesce(F.col("id").cast("string"), F.lit(""))).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "target_uri", F.lit("1970-01-01T00:00:00Z").alias("warc_date"),
        F.when(revisit, _record_uuid(F.col("first").cast("string"))).alias("refers_to"),
        F.concat(F.lit("sha1:"), base32(F.col("sha1"))).alias("payload_digest"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"), "payload",
    )


def base32(hexed: Column) -> Column:
    """A hex string of 20 bytes in base 32, by eight characters from each ten digits."""
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    digits = []
    for start in range(0, 40, 10):
        number = F.conv(F.substring(hexed, start + 1, 10), 16, 10).cast("bigint")
        for shift in range(35, -1, -5):
            digits.append(F.substring(alphabet, F.shiftright(number, shift).bitwiseAND(F.lit(31)).cast("int") + 1, F.lit(1)))
    return F.concat(*digits)


def write(pages: DataFrame, path: str, **columns) -> None:
    """Writes the pages as archives below ``path``."""
    register(pages.sparkSession)
    records(pages, **columns).write.format("warc").mode("append").save(path)


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records below ``path``."""
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def archived(pages: DataFrame, name: str = "warc") -> DataFrame:
    """Writes the pages to a new folder in the shared one and reads them back."""
    path = fresh_dir(pages.sparkSession, name)
    write(pages, path)
    return read(pages.sparkSession, path)
