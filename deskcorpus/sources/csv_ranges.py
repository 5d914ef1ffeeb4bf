"""Multi-line CSV read by many tasks per file.

A line break ends a record unless it stands in a quoted cell, so a byte range cannot tell
where records start from its own bytes. It can under either assumption: the number of
quotes before a byte, odd or even, says whether it is in a cell. One pass counts the quotes of
every range; sums over the ranges before give each range's state; a second pass reads the
records that begin in a range, the last one to its end beyond it.

For that, quotes may only stand around cells, or doubled inside them, which is how all
common writers quote."""

from __future__ import annotations

import io
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from deskcorpus.sources.readers import NA_STRINGS, RAW_SCHEMA, typed_cells

RANGE_BYTES = 64 << 20
BLOCK_BYTES = 4 << 20
QUOTE, BREAK = 0x22, 0x0A
COUNTS = "number int, quotes long"


def file_system(path: str):
    """The file system and the path in it of a plain path or a URI that Arrow knows."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("/") else fs.FileSystem.from_uri(f"file:{path}")


def data_files(path: str) -> list[tuple[str, int]]:
    """(path, size) of a file, or of the files below a folder, but for hidden ones."""
    from pyarrow.fs import FileSelector, FileType

    files, inner = file_system(path)
    about = files.get_file_info(inner)
    if about.type == FileType.NotFound:
        raise FileNotFoundError(path)
    if about.type == FileType.File:
        return [(path, about.size)]
    base = path.rstrip("/")
    below = len(inner.rstrip("/")) + 1
    found = files.get_file_info(FileSelector(inner, recursive=True))
    names = [(f.path[below:], f.size) for f in found if f.type == FileType.File]
    return sorted((f"{base}/{n}", size) for n, size in names if not any(p[0] in "._" for p in n.split("/")))


@dataclass
class ByteRange(InputPartition):
    """Bytes ``start`` to ``stop`` of a file; ``inside`` if a quoted cell is open at ``start``."""

    number: int
    path: str
    start: int
    stop: int
    inside: bool = False


def plan_ranges(files: Sequence[tuple[str, int]], size: int) -> list[ByteRange]:
    spans = [(path, a, min(a + size, total)) for path, total in files for a in range(0, total, size)]
    return [ByteRange(k, *span) for k, span in enumerate(spans)]


def with_states(ranges: Sequence[ByteRange], quotes: dict[int, int]) -> list[ByteRange]:
    """The ranges, each with its state from the quotes of those before it in its file."""
    out, odd = [], False
    for r in ranges:
        odd = odd and r.start > 0
        out.append(ByteRange(r.number, r.path, r.start, r.stop, odd))
        odd ^= bool(quotes[r.number] % 2)
    return out


def blocks(path: str, start: int, size: int = BLOCK_BYTES) -> Iterator[bytes]:
    files, inner = file_system(path)
    with files.open_input_file(inner) as f:
        f.seek(start)
        while block := f.read(size):
            yield block


def count_quotes(r: ByteRange, size: int = BLOCK_BYTES) -> int:
    left, total = r.stop - r.start, 0
    for block in blocks(r.path, r.start, min(size, left)):
        total += block[:left].count(b'"')
        left -= len(block)
        if left <= 0:
            break
    return total


def whole_records(r: ByteRange, size: int = BLOCK_BYTES) -> Iterator[bytes]:
    """The bytes of the records that begin in a range, in portions of whole records. The
    first record of a file, its header, is left out."""
    begin = max(r.start - 1, 0)  # the byte before may end a record
    at, inside = begin, r.inside
    known = r.start == 0  # whether the start of a record has been found
    header = r.start == 0
    held = b""
    for block in blocks(r.path, begin, size):
        raw = np.frombuffer(block, np.uint8)
        quoted = raw == QUOTE
        if at < r.start and quoted[0]:
            inside = not inside  # the state holds for the range's start, not the byte before
        odd = (np.cumsum(quoted) + inside) % 2 == 1
        ends = np.flatnonzero((raw == BREAK) & ~odd) + 1
        inside = bool(odd[-1])
        first = 0
        if not known and len(ends):
            first = int(ends[0])
            if at + first >= r.stop:
                return
            known, ends = True, ends[1:]
        if header and len(ends):
            held, first, header = b"", int(ends[0]), False
            if at + first >= r.stop:
                return
            ends = ends[1:]
        if not known or header:
            at += len(block)
            if not known and at >= r.stop:
                return
            continue
        last = ends[np.searchsorted(ends, r.stop - at) :][:1]
        if len(last):
            yield held + block[first : int(last[0])]
            return
        upto = int(ends[-1]) if len(ends) else first
        if upto > first:
            yield held + block[first:upto]
            held = block[upto:]
        else:
            held += block[first:]
        at += len(block)
    if inside:
        raise ValueError(f"a quoted cell of {r.path} is never closed")
    if known and not header and held:
        yield held


def parse(portion: bytes, names: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """Cells of whole records as strings; an empty cell without quotes is null. A record of
    another number of cells is an error."""
    from pyarrow import csv

    table = csv.read_csv(
        io.BytesIO(portion),
        csv.ReadOptions(use_threads=False, block_size=len(portion) + 1, column_names=list(names)),
        csv.ParseOptions(newlines_in_values=True),
        csv.ConvertOptions(
            column_types={n: pa.string() for n in names},
            null_values=[""],
            strings_can_be_null=True,
            quoted_strings_can_be_null=False,
        ),
    )
    yield from table.combine_chunks().to_batches()


class CsvRangeReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict[str, str]):
        self.names = schema.names
        self.counting = options["scan"] == "quotes"
        self.ranges = [ByteRange(*r) for r in json.loads(options["ranges"])]

    def partitions(self) -> Sequence[InputPartition]:
        return self.ranges

    def read(self, partition: ByteRange | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what Spark hands over when there are no files
            return
        if self.counting:
            counted = [pa.array([partition.number], pa.int32()), pa.array([count_quotes(partition)], pa.int64())]
            yield pa.RecordBatch.from_arrays(counted, names=self.names)
            return
        for portion in whole_records(partition):
            if portion.strip(b"\r\n"):
                yield from parse(portion, self.names)


class CsvRanges(DataSource):
    @classmethod
    def name(cls) -> str:
        return "csv_ranges"

    def reader(self, schema: T.StructType) -> CsvRangeReader:
        return CsvRangeReader(schema, self.options)


def read_csv_ranges(
    spark: SparkSession,
    path: str,
    schema: T.StructType = RAW_SCHEMA,
    na_strings: Sequence[str] = NA_STRINGS,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """What ``read_csv`` reads with ``multi_line`` (S03), each file by as many tasks as it has
    ranges of ``range_bytes``, whatever cells have line breaks, and in bounded memory but for
    single records. Files are UTF-8 with a header, uncompressed, in a store that Arrow can
    open. An unclosed quote or a record of another number of cells fails the job. The driver
    holds a short entry per range."""
    spark.dataSource.register(CsvRanges)
    ranges = plan_ranges(data_files(path), range_bytes)

    def scan(kind: str, planned: Sequence[ByteRange]) -> DataFrame:
        listed = json.dumps([[r.number, r.path, r.start, r.stop, r.inside] for r in planned])
        cells = COUNTS if kind == "quotes" else T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
        return spark.read.format("csv_ranges").schema(cells).option("scan", kind).option("ranges", listed).load()

    if len(ranges) > len({r.path for r in ranges}):
        counted = {r.number: r.quotes for r in scan("quotes", ranges).collect()}
        ranges = with_states(ranges, counted)
    return typed_cells(scan("records", ranges), schema, na_strings)
