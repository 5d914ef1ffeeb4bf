"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType


SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

HOT_SHARE = 0.001
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_of(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does that for texts of ASCII alone, much faster
    than ``translate``, which the other texts need."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def hot_lookup(
    facts: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    weight: str,
    total: int,
    share: float = HOT_SHARE,
) -> DataFrame:
    """Left join of ``facts`` with ``table`` (unique on ``on``) in one pass over the facts.

    ``weight`` is a column of the table with the number of facts of a key, ``total`` the
    number of all facts. Keys above ``share`` of the facts are fewer than 1/share by
    counting, so their rows are broadcast; facts they match keep that answer and go to
    the shuffled join by a hash of their own values, so no task gets a hot key. That hash
    is the same in every attempt of a task. Null keys match nothing. ``weight`` is
    dropped."""
    on = list(on)
    values = [c for c in table.columns if c not in on and c != weight]
    hot = table.where(F.col(weight) > share * max(total, 1)).select(
        *on, F.struct(*values).alias("_hot")
    )
    rest = table.where(F.col(weight) <= share * max(total, 1)).select(
        F.xxhash64(*on).alias("_slot"), *[F.col(c).alias(f"_{c}") for c in on], F.struct(*values).alias("_rest")
    )
    first = facts.join(F.broadcast(hot), on, "left")  # fewer than 1/share rows
    plain = [f.name for f in facts.schema.fields if isinstance(f.dataType, AtomicType)]
    spread = F.when(F.col("_hot").isNull(), F.xxhash64(*on)).otherwise(F.xxhash64(*[F.col(f"`{c}`") for c in plain]))
    same = [F.when(F.col("_hot").isNull(), F.col(c)) == F.col(f"_{c}") for c in on]
    joined = first.withColumn("_at", spread).join(
        rest, [F.col("_at") == F.col("_slot"), *same], "left"
    )
    found = F.coalesce("_hot", "_rest")
    return joined.select(*facts.columns, *[found[c].alias(c) for c in values])


# --- inside Arrow functions ----------------------------------------------------------


def tidy(run):
    """For functions over Arrow batches: at its end a task hands free memory back to the
    system. Workers are kept between tasks, and what one stage has grown to would otherwise
    stay with the executor for all later ones."""

    def whole(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return whole


def worker_cache(kind: str) -> dict:
    """Objects that live as long as a Python worker. Functions travel to workers by value,
    with a copy of their module, so a variable of the module would be new in every task."""
    return sys.__dict__.setdefault(f"_deskcorpus_{kind}", {})


def text_chunks(batch: pa.RecordBatch, column: str = "text", size: int = CHUNK_BYTES):
    """Slices of a batch of about ``size`` bytes of text each, or of one longer text."""
    ends = text_offsets(batch.column(column))
    at, rows = 0, batch.num_rows
    while at < rows:
        upto = max(int(np.searchsorted(ends, ends[at] + size, "right")) - 1, at + 1)
        yield batch.slice(at, min(upto, rows) - at)
        pa.default_memory_pool().release_unused()
        at = min(upto, rows)


def text_offsets(texts: pa.Array) -> np.ndarray:
    wide = texts.type in (pa.large_string(), pa.large_binary())
    kind = np.int64 if wide else np.int32
    return np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an array without nulls, and the offsets of its rows in them."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = text_offsets(texts)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def word_bounds(raw: np.ndarray, ends: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in joined texts, and the number of words before each
    text (one more entry at the end). ``is_word`` says which of the 256 bytes are part
    of a word; words never reach across texts."""
    inside = np.zeros(len(raw) + 2, np.bool_)
    inside[1:-1] = is_word[raw]
    opens = inside[1:-1] & ~inside[:-2]
    closes = inside[1:-1] & ~inside[2:]
    cuts = ends[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(raw))]
    opens[cuts] = inside[1:-1][cuts]
    closes[cuts - 1] = inside[1:-1][cuts - 1]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, ends)


def binary(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


def slices_as_binary(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Slices of a flat array as a binary column, without a Python object per row."""
    values = np.ascontiguousarray(values)
    ends = bounds.astype(np.int64) * values.itemsize
    if ends[-1] < 2**31:
        return pa.Array.from_buffers(
            pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(values)]
        )
    return binary([values[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])])
