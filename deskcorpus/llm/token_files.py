"""Token ids of a corpus in Simple-8b files, in ascending order of document id.

A file holds a run of documents: a JSON header with the sizes of its arrays, then the
document ids, a flag for null ids, ids per document, the blocks' word offsets and escape
offsets, the words and the escaped values, all little-endian. A manifest table lists the
files in order with their totals; files of attempts that did not finish are not in it."""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deskcorpus.llm import simple8b
from deskcorpus.llm.common import partitions, text_chunks, text_of, tidy
from deskcorpus.llm.encode import default_tokenizer, encoder
from deskcorpus.llm.storage import fresh_name, make_folder, open_input, write_bytes
from deskcorpus.stages import materialize

MAGIC = b"TOKS8B1\n"
FILE_IDS = 16 << 20
READ_BLOCKS = 1024
MANIFEST = "part int, number int, path string, n_docs long, n_ids long, bytes long"
ARRAYS = (
    ("doc_ids", "<i8"),
    ("doc_null", "u1"),
    ("doc_lengths", "<i8"),
    ("block_words", "<i8"),
    ("block_escapes", "<i8"),
    ("words", "<u8"),
    ("escapes", "<u8"),
)


def write_file(path: str, doc_ids: list, lengths: np.ndarray, ids: simple8b.Packer) -> int:
    words, starts, odd, odd_starts = ids.finish()
    arrays = (
        [0 if d is None else d for d in doc_ids],
        [d is None for d in doc_ids],
        lengths,
        starts,
        odd_starts,
        words,
        odd,
    )
    body = [np.ascontiguousarray(a, kind) for a, (_, kind) in zip(arrays, ARRAYS)]
    sizes = {name: b.nbytes for b, (name, _) in zip(body, ARRAYS)}
    head = json.dumps({"n_ids": ids.n, "block": simple8b.BLOCK, "bytes": sizes}).encode()
    return write_bytes(path, [MAGIC, struct.pack("<I", len(head)), head, *body])


class TokenFile:
    """Random access to a file: the index is read at once, blocks on demand."""

    def __init__(self, path: str):
        self.file = open_input(path)
        if self.file.read(len(MAGIC)) != MAGIC:
            raise ValueError(f"{path} is not a token file")
        (size,) = struct.unpack("<I", self.file.read(4))
        head = json.loads(self.file.read(size))
        self.n_ids, self.block = head["n_ids"], head["block"]
        at, self.places = len(MAGIC) + 4 + size, {}
        for name, kind in ARRAYS:
            self.places[name] = at
            at += head["bytes"][name]
            if name not in ("words", "escapes"):
                setattr(self, name, np.frombuffer(self.file.read(head["bytes"][name]), kind))

    def _read(self, name: str, start: int, stop: int) -> np.ndarray:
        self.file.seek(self.places[name] + 8 * start)
        return np.frombuffer(self.file.read(8 * (stop - start)), "<u8")

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the file; only the blocks they lie in are read."""
        if stop <= start:
            return np.zeros(0, np.uint64)
        first, last = start // self.block, -(-stop // self.block)
        words, odd = self.block_words[first : last + 1], self.block_escapes[first : last + 1]
        n = min(last * self.block, self.n_ids) - first * self.block
        values = simple8b.decode(
            self._read("words", words[0], words[-1]),
            words - words[0],
            self._read("escapes", odd[0], odd[-1]),
            odd - odd[0],
            n,
        )
        return values[start - first * self.block : stop - first * self.block]

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """Documents in order, decoded a span of blocks at a time."""
        upto = np.cumsum(self.doc_lengths)
        k, span = 0, READ_BLOCKS * self.block
        while k < len(upto):
            begin = int(upto[k] - self.doc_lengths[k])
            stop = max(int(np.searchsorted(upto, begin + span, "right")), k + 1)
            values = self.ids(begin, int(upto[stop - 1]))
            for j in range(k, stop):
                end = int(upto[j]) - begin
                yield None if self.doc_null[j] else int(self.doc_ids[j]), values[end - int(self.doc_lengths[j]) : end]
            k = stop

    def close(self) -> None:
        self.file.close()


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str | None = None,
    key: str = "doc_id",
    text: str = "text",
    file_ids: int = FILE_IDS,
) -> DataFrame:
    """Encode whole texts, each followed by the end id, and write them in order of
    ``key``; returns the manifest. Texts are ranged by key and sorted, so every task
    writes a run of the order, in files of about ``file_ids`` ids.

    Null texts count as empty and have the end id alone; null keys come first; rows with
    the same key follow each other in order of text, but where they are so many that texts
    with the same first characters span tasks, each task has an order of its own. An empty
    table gives no files."""
    tokenizer = tokenizer or default_tokenizer()
    make_folder(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, enc = TaskContext.get().partitionId(), encoder(tokenizer)
        keys, lengths, packer, number = [], [], simple8b.Packer(), 0

        def flush() -> pa.RecordBatch:
            path = fresh_name(folder, part, number, ".s8b")
            written = write_file(path, keys, np.concatenate(lengths), packer)
            row = {"part": part, "number": number, "path": path, "n_docs": len(keys), "n_ids": packer.n, "bytes": written}
            return pa.RecordBatch.from_pylist([row], schema=MANIFEST_ARROW)

        for batch in batches:
            for chunk in text_chunks(batch):
                ids, bounds = enc.ids(chunk.column("text"))
                keys += chunk.column("key").to_pylist()
                lengths.append(np.diff(bounds))
                packer.add(ids)
                if packer.n >= file_ids:
                    yield flush()
                    keys, lengths, packer, number = [], [], simple8b.Packer(), number + 1
        if keys:
            yield flush()

    ordered = (
        docs.select(
            F.col(f"`{key}`").cast("long").alias("key"),
            text_of(f"`{text}`").alias("text"),
            F.monotonically_increasing_id().alias("_row"),
        )
        .withColumn("_begin", F.left("text", F.lit(32)))
        # rows of one key, even equal ones, may span tasks
        .repartitionByRange(partitions(docs.sparkSession), "key", "_begin", "_row")
        .sortWithinPartitions("key", "text")
        .select("key", "text")
    )
    return materialize(ordered.mapInArrow(tidy(write), MANIFEST))


MANIFEST_ARROW = pa.schema(
    [
        pa.field("part", pa.int32()),
        pa.field("number", pa.int32()),
        pa.field("path", pa.string()),
        pa.field("n_docs", pa.int64()),
        pa.field("n_ids", pa.int64()),
        pa.field("bytes", pa.int64()),
    ]
)


def read_documents(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, ids) read back from the files; ``ids`` is little-endian unsigned
    32-bit in a binary cell, ``start`` the number of ids of all documents before."""
    return _read(manifest, "ids binary", lambda ids: ids.astype("<u4").tobytes(), pa.binary())


def read_checksums(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""
    return _read(manifest, "ids_crc32 long", lambda ids: zlib.crc32(ids.astype("<u4").tobytes()), pa.int64())


def _read(manifest: DataFrame, column: str, make, kind: pa.DataType) -> DataFrame:
    name = column.split()[0]
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select(  # a row per file: files are large, so there are few
        "path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long").alias("start")
    ).repartition(partitions(manifest.sparkSession))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                file = TokenFile(path)
                rows, size = ([], [], [], []), 0
                for doc_id, ids in file.documents():
                    for column, value in zip(rows, (doc_id, start, len(ids), make(ids))):
                        column.append(value)
                    start, size = start + len(ids), size + len(ids)
                    if size > 4 << 20:
                        yield _rows(rows, name, kind)
                        rows, size = ([], [], [], []), 0
                yield _rows(rows, name, kind)
                file.close()

    return files.mapInArrow(tidy(read), f"doc_id long, start long, n_tokens long, {column}")


def _rows(rows: tuple, name: str, kind: pa.DataType) -> pa.RecordBatch:
    arrays = [pa.array(c, t) for c, t in zip(rows, (pa.int64(), pa.int64(), pa.int64(), kind))]
    return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "n_tokens", name])
