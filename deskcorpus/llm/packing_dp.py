"""Order-preserving packing: where to cut a stream of documents into sequences.

Documents are laid end to end in order of their key. Windows of at most ``length`` tokens
are cut at the end of a document, at the end of a sentence, or, where a sentence is long,
at a grid inside it. Padding costs its tokens, a cut inside a document a penalty, and the
cheapest cuts are found by dynamic programming: with f(j) the least cost up to cut j,

    f(j) = min over i with p(j) - p(i) <= length of  f(i) + length - (p(j) - p(i)) + penalty(j)

The minimum of f(i) + p(i) over that sliding range is kept by a monotone queue, so every
cut is entered and taken out once. The stream is divided into blocks by the running token
count, which no setting of the cluster changes, and each block is solved alone."""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskcorpus.llm.common import partitions, slices_as_binary, text_chunks, text_of, tidy
from deskcorpus.llm.encode import WORD_END, default_tokenizer, encoder
from deskcorpus.operators.running import prefix_sums
from deskcorpus.stages import materialize

LENGTH = 2048
BLOCK_TOKENS = 1 << 20
SENTENCE_PENALTY = 12
INSIDE_PENALTY = 48
GRID = 64


def sentence_ends(vocabulary: dict[str, int]) -> np.ndarray:
    """For each id, whether a sentence may end after it: punctuation with a full stop,
    question or exclamation mark at the end of a piece."""
    ends = np.zeros(max(vocabulary.values()) + 1, np.bool_)
    for token, i in vocabulary.items():
        mark = token.removesuffix(WORD_END)
        if token.endswith(WORD_END) and mark[-1:] in (".", "!", "?") and not any(c.isalnum() for c in mark):
            ends[i] = True
    return ends


def cut_places(flat: np.ndarray, bounds: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places inside each document where it may be cut, as 2 * place for sentence ends and
    2 * place + 1 for the grid in stretches of over GRID tokens; and their bounds."""
    lengths = np.diff(bounds)
    stops = np.flatnonzero(ends[flat]) + 1
    edges = np.union1d(stops, bounds)
    gaps = np.diff(edges)
    wide = np.flatnonzero(gaps > GRID)
    extra = (gaps[wide] - 1) // GRID
    grid = np.repeat(edges[wide] - GRID * (np.cumsum(extra) - extra), extra) + GRID * np.arange(1, extra.sum() + 1)
    places = np.concatenate([stops, grid])
    hard = np.concatenate([np.zeros(len(stops), np.int64), np.ones(len(grid), np.int64)])
    order = np.argsort(places, kind="stable")
    places, hard = places[order], hard[order]
    doc = np.searchsorted(bounds, places, "left") - 1
    inside = (places > bounds[doc]) & (places < bounds[doc] + lengths[doc])
    places, hard, doc = places[inside], hard[inside], doc[inside]
    coded = (2 * (places - bounds[doc]) + hard).astype("<u4")
    return coded, np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(lengths)))])


def best_cuts(places: np.ndarray, penalties: np.ndarray, length: int = LENGTH) -> list[int]:
    """Indices of the chosen places, which ascend from 0 (the start) in steps of at most
    ``length``; the last one is always chosen."""
    p, w = places.tolist(), penalties.tolist()
    cost, came = [0.0] * len(p), [0] * len(p)
    queue: deque[int] = deque([0])
    score = [0.0] * len(p)
    score[0] = p[0]
    for j in range(1, len(p)):
        low = p[j] - length
        while p[queue[0]] < low:
            queue.popleft()
        i = queue[0]
        came[j] = i
        cost[j] = score[i] + length - p[j] + w[j]
        value = score[j] = cost[j] + p[j]
        while queue and score[queue[-1]] >= value:
            queue.pop()
        queue.append(j)
    chosen, j = [], len(p) - 1
    while j > 0:
        chosen.append(j)
        j = came[j]
    return chosen[::-1]


def pack_block(lengths: list[int], cuts: list[np.ndarray], length: int, sentence: float, inside: float):
    """Pieces of one block: for each document a list of (start, length, sequence, offset)."""
    starts = np.concatenate([[0], np.cumsum(lengths)])
    inner = np.concatenate([s + (c >> 1).astype(np.int64) for s, c in zip(starts, cuts)]) if cuts else np.zeros(0, np.int64)
    hard = np.concatenate([c & 1 for c in cuts]) if cuts else np.zeros(0, np.uint32)
    places = np.concatenate([starts, inner])
    penalty = np.concatenate([np.zeros(len(starts)), np.where(hard == 1, inside, sentence)])
    order = np.argsort(places, kind="stable")
    places, penalty = places[order], penalty[order]
    chosen = places[best_cuts(places, penalty, length)]
    edges = np.union1d(chosen, starts)  # pieces end where a sequence or a document does
    begin = edges[:-1]
    sequence = np.searchsorted(chosen, begin, "right")
    opening = np.concatenate([[0], chosen])[sequence]
    doc = np.searchsorted(starts, begin, "right") - 1
    pieces: list[list[tuple[int, int, int, int]]] = [[] for _ in lengths]
    for d, b, n, s, o in zip(doc.tolist(), (begin - starts[doc]).tolist(), np.diff(edges).tolist(), sequence.tolist(), (begin - opening).tolist()):
        pieces[d].append((b, n, s, o))
    return pieces


PIECES = "pieces array<struct<start: long, length: long, sequence_id: long, offset: long>>"


def encoded(docs: DataFrame, tokenizer: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, key, ids, ids_crc32, doc_tokens, cuts) of every row of ``docs``, written once.
    ``row`` numbers the rows; ``ids`` is binary, little-endian, 16 bits an id if the
    vocabulary allows, else 32. Null texts count as empty: the end id alone."""
    tokenizer = tokenizer or default_tokenizer()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        kind = "<u4" if enc.wide else "<u2"
        ends = sentence_ends(enc.tokens)
        for batch in batches:
            for chunk in text_chunks(batch):
                flat, bounds = enc.ids(chunk.column("text"))
                cuts, at = cut_places(flat, bounds, ends)
                wide = flat.astype("<u4")
                sums = [zlib.crc32(wide[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        chunk.column("row"),
                        chunk.column("key"),
                        slices_as_binary(flat.astype(kind), bounds),
                        pa.array(sums, pa.int64()),
                        pa.array(np.diff(bounds), pa.int64()),
                        slices_as_binary(cuts, at),
                    ],
                    names=["row", "key", "ids", "ids_crc32", "doc_tokens", "cuts"],
                )

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("key"), text_of(text).alias("text")
    )
    return materialize(
        rows.mapInArrow(tidy(encode), "row long, key long, ids binary, ids_crc32 long, doc_tokens long, cuts binary")
    )


def pack_documents(
    tokens: DataFrame,
    length: int = LENGTH,
    block_tokens: int = BLOCK_TOKENS,
    sentence_penalty: float = SENTENCE_PENALTY,
    inside_penalty: float = INSIDE_PENALTY,
) -> DataFrame:
    """(row, pieces) for every row of :func:`encoded`: where each piece of the document
    starts, how long it is, its sequence and its offset there.

    Rows with the same key follow each other in order of their ids' checksum. Documents of
    any length are cut on the grid where nothing better is near. Sequences are numbered
    block * 2**32 + place in the block. An empty table gives no rows."""
    if length < GRID:
        raise ValueError(f"sequences of less than {GRID} tokens are not supported")
    placed = prefix_sums(
        tokens.select("row", "key", "ids_crc32", "doc_tokens", "cuts"),
        ["key", "ids_crc32", "doc_tokens", "row"],
        "doc_tokens",
        "begin",
    ).withColumn("block", F.expr(f"begin div {block_tokens}"))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, lengths, cuts, block = [], [], [], None

        def finish() -> pa.RecordBatch:
            packed = pack_block(lengths, cuts, length, sentence_penalty, inside_penalty)
            base = block << 32
            flat = [(a, b, base + c, d) for p in packed for a, b, c, d in p]
            upto = np.concatenate([[0], np.cumsum([len(p) for p in packed])])
            names = ("start", "length", "sequence_id", "offset")
            fields = [pa.array([x[k] for x in flat], pa.int64()) for k in range(4)]
            lists = pa.ListArray.from_arrays(
                pa.array(upto, pa.int32()), pa.StructArray.from_arrays(fields, names=names)
            )
            return pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), lists], names=["row", "pieces"])

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(batch.num_columns)]
            for b, row, n, c in zip(*columns):
                if b != block and rows:
                    yield finish()
                    rows, lengths, cuts = [], [], []
                block = b
                rows.append(row)
                lengths.append(n)
                cuts.append(np.frombuffer(c, "<u4"))
        if rows:
            yield finish()

    return (
        placed.select("block", "begin", "row", "doc_tokens", "cuts")
        .repartition(partitions(tokens.sparkSession), "block")
        .sortWithinPartitions("block", "begin")
        .select("block", "row", "doc_tokens", "cuts")
        .mapInArrow(tidy(solve), f"row long, {PIECES}")
    )


def piece_rows(tokens: DataFrame, packed: DataFrame) -> DataFrame:
    """One row per piece with its ids (little-endian unsigned 32-bit, binary): what a
    trainer reads, in order of (sequence_id, offset)."""
    return _pieces(tokens, packed, "ids binary", lambda ids: ids.tobytes(), pa.binary())


def piece_checksums(tokens: DataFrame, packed: DataFrame) -> DataFrame:
    """One row per piece with the crc32 of its ids instead of the ids."""
    return _pieces(tokens, packed, "ids_crc32 long", zlib.crc32, pa.int64())


def _pieces(tokens: DataFrame, packed: DataFrame, column: str, make, kind: pa.DataType) -> DataFrame:
    name = column.split()[0]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {c: batch.column(c).to_pylist() for c in ("key", "doc_tokens")}
            lists, ids = batch.column("pieces"), batch.column("ids")
            fields = [lists.flatten().field(k).to_numpy() for k in range(4)]
            counts = np.diff(lists.offsets.to_numpy())
            owner = np.repeat(np.arange(batch.num_rows), counts)
            made = []
            for d, start, n in zip(owner.tolist(), fields[0].tolist(), fields[1].tolist()):
                raw = ids[d].as_buffer()
                width = raw.size // columns["doc_tokens"][d]
                piece = np.frombuffer(raw, f"<u{width}", n, start * width)
                made.append(make(piece.astype("<u4")))
            key, total = (np.array([0 if v is None else v for v in columns[c]], np.int64)[owner] for c in columns)
            null = np.array([v is None for v in columns["key"]], np.bool_)[owner]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key, pa.int64(), mask=null),
                    pa.array(fields[0]),
                    pa.array(fields[1]),
                    pa.array(made, kind),
                    pa.array(total, pa.int64()),
                    pa.array(fields[2]),
                    pa.array(fields[3]),
                ],
                names=["doc_id", "start", "length", name, "doc_tokens", "sequence_id", "offset"],
            )

    joined = tokens.select("row", "key", "ids", "doc_tokens").join(packed, "row")
    return joined.drop("row").mapInArrow(
        tidy(cut), f"doc_id long, start long, length long, {column}, doc_tokens long, sequence_id long, offset long"
    )
