"""WARC archives as a Spark data source.

Writing: every task writes files of its own, a record per row, and the commit lists the
files of finished attempts in a manifest. A ``.warc.gz`` file has a gzip member for each
record, as is usual, with its compressed size in the member's extra field.

Reading: a partition per file; predicates on record type and other headers are pushed
down. A record's headers are parsed first, from the first bytes of the member; a record
that is not wanted, or wanted without its payload, is left by a seek, its block neither
inflated nor decoded. Members of other writers lack the size and are inflated to their end."""

from __future__ import annotations

import base64
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
    WriterCommitMessage,
)

from deskcorpus.llm.common import hot_lookup
from deskcorpus.llm.storage import filesystem, fresh_name, make_folder, open_input
from deskcorpus.stages import materialize, scratch_dir

SCHEMA = (
    "record_id string, record_type string, target_uri string, refers_to string, payload_digest string,"
    " payload_length long, payload binary"
)
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
ARROW = pa.schema([*[(c, pa.string()) for c in COLUMNS[:5]], ("payload_length", pa.int64()), ("payload", pa.binary())])
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
HEADER_END = b"\r\n\r\n"
FILE_BYTES = 128 << 20
BATCH_BYTES = 4 << 20
MIN_REVISIT_BYTES = 1000
MANIFEST = "_manifest-"


# --- records ---------------------------------------------------------------------------


def _clean(value: str) -> str:
    """A header value must be a line: blanks and controls are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record_bytes(row: dict) -> bytes:
    """A record of the row. The payload is the body of an HTTP response; a revisit has the
    response's header alone."""
    body = (row["payload"] or b"") if row["record_type"] == "response" else b""
    length = row["payload_length"]
    length = len(body) if length is None else length
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode() + body
    lines = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <{_clean(row['record_id'])}>", f"WARC-Date: {DATE}"]
    if row["target_uri"] is not None:
        lines.append(f"WARC-Target-URI: {_clean(row['target_uri'])}")
    if row["payload_digest"] is not None:
        lines.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(row["payload_digest"])).decode())
    if row["record_type"] == "revisit":
        lines.append(f"WARC-Profile: {REVISIT_PROFILE}")
    if row["refers_to"] is not None:
        lines.append(f"WARC-Refers-To: <{_clean(row['refers_to'])}>")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + HEADER_END + block + HEADER_END


def info_record() -> bytes:
    body = b"format: WARC File Format 1.1\r\n"
    head = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nWARC-Date: {DATE}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(body)}"
    return head.encode() + HEADER_END + body + HEADER_END


def gzip_member(data: bytes, level: int = 1) -> bytes:
    """A gzip member whose extra field RL has the member's size."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    packed = deflate.compress(data) + deflate.flush()
    size = 12 + 12 + len(packed) + 8
    extra = b"RL" + struct.pack("<HQ", 8, size)
    return (
        b"\x1f\x8b\x08\x04\0\0\0\0\0\xff"
        + struct.pack("<H", len(extra))
        + extra
        + packed
        + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    )


class PlainRecords:
    """The records of an uncompressed file."""

    def __init__(self, file):
        self.file, self.at, self.size = file, 0, file.size()

    def next(self) -> bool:
        self.file.seek(self.at)
        self.data = self.file.read(1 << 12)
        self.skipped = len(self.data) - len(self.data.lstrip(b"\r\n"))
        self.data = self.data[self.skipped :]
        return bool(self.data)

    def header(self) -> bytes:
        while HEADER_END not in self.data:
            more = self.file.read(1 << 14)
            if not more:
                raise ValueError("the file ends inside a record's headers")
            self.data += more
        return self.data[: self.data.index(HEADER_END)]

    def block(self, start: int, length: int) -> bytes:
        while len(self.data) < start + length:
            more = self.file.read(start + length - len(self.data))
            if not more:
                raise ValueError("the file ends inside a record")
            self.data += more
        return self.data[start : start + length]

    def leave(self, start: int, length: int) -> None:
        self.at += self.skipped + start + length


class GzipRecords(PlainRecords):
    """The records of a file of gzip members, one or more in each; a member whose header
    gives its length holds one, and is inflated only as far as asked for."""

    inside = False  # a member that holds another record

    def next(self) -> bool:
        if self.inside:
            self.inside = False
            return True
        if self.at >= self.size:
            return False
        self.file.seek(self.at)
        raw = self.file.read(1 << 12)
        self.member = None
        if raw[3:4] == b"\x04" and raw[12:14] == b"RL":
            (self.member,) = struct.unpack("<Q", raw[16:24])
        self.inflate = zlib.decompressobj(31)
        self.data = self.inflate.decompress(raw, 1 << 12)
        self.read = len(raw)
        return True

    def _more(self, n: int) -> bool:
        """Inflate up to ``n`` more bytes; false at the member's end."""
        while not self.inflate.eof:
            raw = self.inflate.unconsumed_tail
            if not raw:
                raw = self.file.read(1 << 16)
                self.read += len(raw)
                if not raw:
                    raise ValueError("the file ends inside a member")
            got = self.inflate.decompress(raw, max(n, 1))
            if got:
                self.data += got
                return True
        return False

    def header(self) -> bytes:
        while HEADER_END not in self.data:
            if not self._more(1 << 12):
                raise ValueError("a member has no complete headers")
        return self.data[: self.data.index(HEADER_END)]

    def block(self, start: int, length: int) -> bytes:
        parts, self.data = [self.data], b""
        size = len(parts[0])
        while size < start + length:
            if not self._more(start + length - size):
                raise ValueError("a member ends inside its record")
            parts.append(self.data)
            size, self.data = size + len(self.data), b""
        self.data = b"".join(parts)
        return self.data[start : start + length]

    def leave(self, start: int, length: int) -> None:
        if self.member is None:
            left = start + length
            while len(self.data) < left:
                left, self.data = left - len(self.data), b""
                if not self._more(1 << 20):
                    raise ValueError("a member ends inside its record")
            self.data = self.data[left:].lstrip(b"\r\n")
            while not self.data and self._more(1 << 12):
                self.data = self.data.lstrip(b"\r\n")
            if self.data:
                self.inside = True
                return
            self.member = self.read - len(self.inflate.unused_data)
        self.at += self.member


def parse_headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    pairs = (line.partition(":") for line in lines[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _digest(value: str | None) -> str | None:
    """A payload digest as hex; base32 is usual in the header."""
    if not value or not value.lower().startswith("sha1:"):
        return None
    code = value[5:]
    return base64.b32decode(code).hex() if len(code) == 32 else code.lower()


def _header_columns(headers: dict[str, str]) -> dict:
    bare = lambda x: None if x is None else x.strip("<>")
    return {
        "record_id": bare(headers.get("warc-record-id")),
        "record_type": headers.get("warc-type"),
        "target_uri": headers.get("warc-target-uri"),
        "refers_to": bare(headers.get("warc-refers-to")),
        "payload_digest": _digest(headers.get("warc-payload-digest")),
    }


def _http_parts(block: bytes) -> tuple[int | None, bytes]:
    """The content length that an HTTP response states, and its body."""
    head, mark, body = block.partition(HEADER_END)
    if not mark or not head.startswith(b"HTTP/"):
        return None, block
    found = re.search(rb"(?im)^content-length:[ \t]*(\d+)", head)
    return (int(found[1]) if found else None), body


# --- data source -----------------------------------------------------------------------


@dataclass
class WarcFile(InputPartition):
    path: str


@dataclass
class WrittenFiles(WriterCommitMessage):
    paths: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.with_payload = options.get("payload", "true").lower() != "false"
        self.filters: list[tuple[str, str, tuple]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if column not in COLUMNS[:5]:
                yield f
            elif isinstance(f, EqualTo):
                self.filters.append((column, "in", (f.value,)))
            elif isinstance(f, In):
                self.filters.append((column, "in", tuple(f.value)))
            elif isinstance(f, StringStartsWith):
                self.filters.append((column, "prefix", (f.value,)))
            elif isinstance(f, IsNotNull):
                self.filters.append((column, "present", ()))
            else:
                yield f

    def partitions(self) -> Sequence[InputPartition]:
        files, inner = filesystem(self.path)
        from pyarrow.fs import FileSelector

        found = [x.path for x in files.get_file_info(FileSelector(inner, allow_not_found=False))]
        lists = [p for p in found if p.rsplit("/", 1)[-1].startswith(MANIFEST)]
        if not lists:
            scheme = self.path.split("://")[0] + "://" if "://" in self.path else ""
            return [WarcFile(scheme + p) for p in sorted(found) if p.endswith((".warc", ".warc.gz"))]
        paths = []
        for p in lists:
            with files.open_input_file(p) as f:
                paths += json.loads(f.read())
        return [WarcFile(p) for p in sorted(paths)]

    def _wanted(self, row: dict) -> bool:
        for column, kind, values in self.filters:
            value = row[column]
            if value is None or (kind == "in" and value not in values) or (kind == "prefix" and not value.startswith(values[0])):
                return False
        return True

    def read(self, partition: WarcFile | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what Spark hands over when there are no files
            return
        file = open_input(partition.path)
        records = GzipRecords(file) if partition.path.endswith(".gz") else PlainRecords(file)
        rows, size = [], 0
        while records.next():
            raw = records.header()
            headers = parse_headers(raw)
            row = _header_columns(headers)
            start, length = len(raw) + len(HEADER_END), int(headers.get("content-length", 0))
            if self._wanted(row):
                row |= {"payload": None, "payload_length": None}
                if headers.get("content-type", "").startswith("application/http"):
                    if self.with_payload or row["record_type"] == "revisit":
                        stated, body = _http_parts(records.block(start, length))
                        row["payload_length"] = len(body) if row["record_type"] == "response" else stated
                        row["payload"] = body if row["record_type"] == "response" else None
                elif self.with_payload:
                    row["payload"] = records.block(start, length)
                    row["payload_length"] = length
                rows.append(row)
                size += 500 + len(row["payload"] or b"")
                if size > BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=ARROW)
                    rows, size = [], 0
            records.leave(start, length)
        file.close()
        yield pa.RecordBatch.from_pylist(rows, schema=ARROW)


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.gzip = options.get("compression", "gzip") == "gzip"
        self.file_bytes = int(options.get("file_bytes", FILE_BYTES))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        from pyspark import TaskContext

        part, paths, out, size = TaskContext.get().partitionId(), [], None, 0
        pack = gzip_member if self.gzip else bytes
        for batch in iterator:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in COLUMNS}
                if out is None:
                    path = fresh_name(self.path, part, len(paths), ".warc.gz" if self.gzip else ".warc")
                    files, inner = filesystem(path)
                    out = files.open_output_stream(inner, compression=None)
                    out.write(pack(info_record()))
                    paths.append(path)
                data = pack(record_bytes(row))
                out.write(data)
                size += len(data)
                if size >= self.file_bytes:
                    out.close()
                    out, size = None, 0
        if out is not None:
            out.close()
        return WrittenFiles(paths)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        files, inner = filesystem(self.path)
        paths = [p for m in messages if m is not None for p in m.paths]
        with files.open_output_stream(f"{inner}/{MANIFEST}{uuid.uuid4().hex}", compression=None) as out:
            out.write(json.dumps(paths).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        files, _ = filesystem(self.path)
        for m in messages:
            for p in m.paths if m is not None else ():
                files.delete_file(filesystem(p)[1])


class WarcDataSource(DataSource):
    """``spark.read.format("warc")``: options ``path`` and ``payload`` (false: headers
    alone); ``df.write.format("warc").mode("append")``: options ``path``, ``compression``
    (gzip or none) and ``file_bytes``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("archives are only ever added to: write in mode append")
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def write_warc(records: DataFrame, path: str, **options: str) -> None:
    """Add records (the columns of SCHEMA) to the archives in a folder."""
    register(records.sparkSession)
    make_folder(path)
    records.select(*COLUMNS).write.format("warc").mode("append").options(path=path, **options).save()


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").options(path=path, payload=str(payload).lower()).load()


# --- pages -----------------------------------------------------------------------------


def page_records(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """A record for every page. Of pages whose payloads are equal and have at least
    MIN_REVISIT_BYTES, the one with the largest id is a response and the others revisit
    it. Null html is an empty payload; rows that repeat an id and a payload are alike; null
    ids are smaller than others, and pages of null ids alone are all responses."""
    payload = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(f"`{key}`").cast("long").alias("page"), F.col(f"`{url}`").alias("target_uri"), payload.alias("body"))
    digests = materialize(
        rows.select("page", F.sha2("body", 256).alias("equal"), F.octet_length("body").alias("n_bytes"))
    )
    groups = (
        digests.where(f"n_bytes >= {MIN_REVISIT_BYTES}")
        .groupBy("equal", "n_bytes")
        .agg(F.max("page").alias("keep"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1 and keep is not null")
    )
    named = rows.withColumns({"equal": F.sha2("body", 256), "n_bytes": F.octet_length("body")})
    found = hot_lookup(named, materialize(groups), ["equal", "n_bytes"], "_n", digests.count())
    again = F.col("keep").isNotNull() & ~F.col("page").eqNullSafe(F.col("keep"))
    name = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")))
    return found.select(
        name("page").alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        "target_uri",
        F.when(again, name("keep")).alias("refers_to"),
        F.sha1("body").alias("payload_digest"),
        F.col("n_bytes").cast("long").alias("payload_length"),
        F.when(~again, F.col("body")).alias("payload"),
    )


def page_table(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of page records
    read back: of responses from the payload itself, of revisits from their headers."""
    whole = F.col("record_type") == "response"
    number = lambda c: F.expr(f"try_cast(substring({c}, length('urn:page:') + 1) as long)")
    return records.where(F.col("record_type").isin("response", "revisit")).select(
        number("record_id").alias("page_id"),
        F.when(whole, F.octet_length("payload")).otherwise(F.col("payload_length")).cast("long").alias("payload_bytes"),
        F.when(whole, F.sha1("payload")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        number("refers_to").alias("refers_to"),
    )


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Every page written to archives and read back; see :func:`page_records` for nulls,
    repeated rows and equal payloads. A table without pages gives archives without page
    records, and no rows."""
    spark = pages.sparkSession
    path = scratch_dir(spark)
    write_warc(page_records(pages), path)
    return page_table(read_warc(spark, path))
