"""Best-fit packing whose bin counts are certified by lower bounds, in rounds.

Documents longer than a sequence are cut, the odd piece first. Pieces are dealt to blocks
by a hash, and each block is packed by best-fit decreasing. Dual feasible functions give a
lower bound of the block's bin count: a function u with sum u(x) <= 1 over every set of
sizes that fits a bin makes sum u(x) over all pieces such a bound. A block that meets its
bound is certified and keeps its bins; one with a gap gives up the pieces of all bins that
are not full. A certified block gives up its emptiest bin, for its bound was rounded
up. What was given up is dealt anew to fewer blocks and packed again, as long as that saves
bins.

Sizes are small integers, so a block is packed by counts: equal pieces that go into bins with
equal room are placed at once, and the work depends on the distinct sizes, not on the
pieces."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskcorpus.llm.common import partitions, slices_as_binary, text_chunks, text_of, tidy
from deskcorpus.llm.encode_bytes import default_tokenizer, encoder
from deskcorpus.stages import materialize

LENGTH = 1024
BLOCK_PIECES = 1 << 15
BOUND_STEPS = 16  # functions u(k) for k up to this
CHUNK_BYTES = 1 << 21


def lower_bound(counts: np.ndarray) -> int:
    """Least number of bins for ``counts[x]`` pieces of size x, where the last index is the
    size of a bin: the best of u(k) after U(e) over all k and e, in exact integers.

    U(e) takes sizes below e as nothing and above 1 - e as a whole bin; u(k) leaves x where
    (k + 1) x is whole and takes floor((k + 1) x) / k elsewhere."""
    size = len(counts) - 1
    x = np.arange(size + 1, dtype=np.int64)
    edges = np.arange(size // 2 + 1)
    upto = np.cumsum(counts.astype(np.int64))
    large = upto[-1] - upto[size - edges]
    best = 0
    for k in range(BOUND_STEPS + 1):
        whole = size * max(k, 1)
        value = x if k == 0 else np.where((k + 1) * x % size == 0, k * x, (k + 1) * x // size * size)
        sums = np.concatenate([[0], np.cumsum(counts * value)])
        total = large * whole + sums[size - edges + 1] - sums[edges]
        best = max(best, int(-(-total.max() // whole)))
    return best


def best_fit_decreasing(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of every piece, and the load of every bin. ``sizes`` fall."""
    place, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    room: dict[int, np.ndarray] = {}  # bins by what is left in them
    filled = np.zeros(length + 1, np.bool_)
    n_bins, at = 0, 0

    def put(left: int, bins: np.ndarray) -> None:
        if left and len(bins):
            room[left] = np.concatenate([room[left], bins]) if left in room else bins
            filled[left] = True

    for size, count in zip(*(v[::-1].tolist() for v in np.unique(sizes, return_counts=True))):
        while count:
            fits = np.flatnonzero(filled[size:])
            left = size + int(fits[0]) if len(fits) else length
            each = left // size  # a bin just used is the best fit for the next piece alike
            if len(fits):
                bins = room.pop(left)
                filled[left] = False
            else:
                bins = np.arange(n_bins, n_bins - (-count // each))
                n_bins += len(bins)
            taken = min(count, each * len(bins))
            step = np.arange(taken)
            place[at : at + taken] = bins[step // each]
            offset[at : at + taken] = length - left + step % each * size
            full, part = divmod(taken, each)
            put(left - each * size, bins[:full])
            if part:
                put(left - part * size, bins[full : full + 1])
            put(left, bins[full + (part > 0) :])
            at, count = at + taken, count - taken
    return place, offset, np.bincount(place, sizes, n_bins).astype(np.int64)


def given_up(sizes: np.ndarray, loads: np.ndarray, length: int) -> np.ndarray:
    """For each bin of a block, whether its pieces join the exchange."""
    if len(loads) > lower_bound(np.bincount(sizes, minlength=length + 1)):
        return loads < length
    released = np.zeros(len(loads), np.bool_)
    emptiest = int(np.argmin(loads))
    released[emptiest] = loads[emptiest] < length
    return released


def cut_pieces(lengths: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, number, start and length of every piece."""
    counts = np.maximum(-(-lengths // length), 1)
    doc = np.repeat(np.arange(len(lengths)), counts)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
    first = lengths - (counts - 1) * length
    start = np.where(piece == 0, 0, first[doc] + (piece - 1) * length)
    return doc, piece, start, np.where(piece == 0, first[doc], length)


def encoded_pieces(
    docs: DataFrame, length: int = LENGTH, tokenizer: str | None = None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(row, doc_id, piece, start, length, ids_crc32, ids) of every piece, written once.
    ``row`` numbers the rows of ``docs``, so repeated rows and null keys stay apart; ``ids``
    is binary, little-endian, 16 bits an id if the vocabulary allows, else 32. Null texts
    count as empty: one piece with the end id. Other columns are left out."""
    tokenizer = tokenizer or default_tokenizer()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        kind = "<u4" if enc.wide else "<u2"
        for batch in batches:
            for chunk in text_chunks(batch, size=CHUNK_BYTES):
                flat, bounds = enc.ids(chunk.column("text"))
                doc, piece, start, size = cut_pieces(np.diff(bounds), length)
                edges = np.append(bounds[doc] + start, bounds[-1])
                wide = memoryview(flat.astype("<u4")).cast("B")
                sums = [zlib.crc32(wide[4 * a : 4 * b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
                owner = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [
                        chunk.column("row").take(owner),
                        chunk.column("doc_id").take(owner),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(size, pa.int64()),
                        pa.array(sums, pa.int64()),
                        slices_as_binary(flat.astype(kind), edges),
                    ],
                    names=["row", "doc_id", "piece", "start", "length", "ids_crc32", "ids"],
                )

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("doc_id"), text_of(text).alias("text")
    )
    schema = "row long, doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
    return materialize(rows.mapInArrow(tidy(encode), schema))


PACKED = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"


def _pack_round(pieces: DataFrame, blocks: int, level: int, length: int) -> DataFrame:
    """``pieces`` with sequence_id, offset and settled, packed block by block."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def finish() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            block = held[0].column("block")[0].as_py()
            for rows in pa.Table.from_batches(held).combine_chunks().to_batches():
                sizes = rows.column("length").to_numpy()
                bins, offset, loads = best_fit_decreasing(sizes, length)
                settled = ~given_up(sizes, loads, length)[bins]
                base = (level << 56) + (block << 24)
                columns = [rows.column(c) for c in rows.schema.names if c != "block"]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(base + bins), pa.array(offset), pa.array(settled)],
                    names=[*(c for c in rows.schema.names if c != "block"), "sequence_id", "offset", "settled"],
                )
            held.clear()

        for batch in batches:
            block = batch.column("block").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
            for a, b in zip(edges[:-1], edges[1:]):
                if b == a:
                    continue
                if held and held[0].column("block")[0].as_py() != block[a]:
                    yield from finish()
                held.append(batch.slice(a, b - a))
        yield from finish()

    names = [c.split()[0] for c in PACKED.split(", ")]
    return (
        pieces.select(F.pmod(F.xxhash64("row", "piece", F.lit(level)), F.lit(blocks)).alias("block"), *names)
        .repartition(partitions(pieces.sparkSession), "block")
        .sortWithinPartitions("block", F.desc("length"), "doc_id", "ids_crc32", "row", "piece")
        .mapInArrow(tidy(solve), f"{PACKED}, sequence_id long, offset long, settled boolean")
    )


def pack_pieces(
    pieces: DataFrame, length: int = LENGTH, block_pieces: int = BLOCK_PIECES
) -> DataFrame:
    """Pieces of :func:`encoded_pieces`, without their ids, with ``sequence_id`` and
    ``offset``. No sequence is longer than ``length``; ids of sequences are any numbers.

    Pieces of one size, repeated rows and null keys are dealt by row number, so no block is
    larger than its share. A round that saves no bin is thrown away. An empty table gives no
    rows."""
    blocks = max(-(-pieces.count() // block_pieces), 1)
    packed = materialize(_pack_round(pieces, blocks, 0, length))
    done = packed.where("settled")
    rest = packed.where("not settled")
    level = 0
    while blocks > 1:
        items, bins = rest.agg(F.count(F.lit(1)), F.count_if(F.col("offset") == 0)).first()
        if not items:
            break
        level, blocks = level + 1, -(-items // block_pieces)
        packed = materialize(_pack_round(rest, blocks, level, length))
        if packed.where("offset = 0").count() >= bins:
            break
        done = done.unionByName(packed.where("settled"))
        rest = packed.where("not settled")
    return done.unionByName(rest).drop("settled")


def certified(pieces: DataFrame, packed: DataFrame, length: int = LENGTH) -> dict[str, int]:
    """``sequences`` in use and the ``bound`` below which no packing of all pieces can go,
    from counts of sizes, at most ``length`` rows."""
    counts = np.zeros(length + 1, np.int64)
    for size, n in pieces.groupBy("length").count().collect():
        counts[size] = n
    return {"sequences": packed.where("offset = 0").count(), "bound": lower_bound(counts)}


def piece_rows(pieces: DataFrame, packed: DataFrame) -> DataFrame:
    """Packed pieces with their ids, what a trainer reads in order of (sequence_id, offset)."""
    return packed.join(pieces.select("row", "piece", "ids"), ["row", "piece"]).drop("row")


def pack_table(docs: DataFrame) -> DataFrame:
    """Every piece of every document with its place. Null texts are one piece of one id;
    an empty table gives no rows; repeated rows are packed each on its own."""
    packed = pack_pieces(encoded_pieces(docs))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
