"""Keep-first deduplication of a stream, with keyed state that may expire."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from deskcorpus.operators.dedup import row_digest
from deskcorpus.operators.ranking import ordered_image
from deskcorpus.operators.schema import PAIR


def _sortable(column: str, schema: T.StructType) -> Column:
    """A column whose order Arrow and Spark agree on: NaN last, booleans as numbers."""
    kind = schema[column].dataType
    value = F.col(f"`{column}`")
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        raise ValueError(f"rows cannot be put in order by {column}, which is {kind.simpleString()}")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return ordered_image(value.cast("double"))
    return value.cast("int") if isinstance(kind, T.BooleanType) else value


def _firsts(rows: pa.RecordBatch, n_order: int) -> pa.RecordBatch:
    """The first row of every digest; order columns, nulls first, then the row's digest."""
    keys = ["_digest", *(f"_order{i}" for i in range(n_order)), "_row"]
    by = pa.RecordBatch.from_arrays([rows.column(k) for k in keys], names=keys)
    order = pc.sort_indices(by, sort_keys=[(k, "ascending") for k in keys], null_placement="at_start")
    digests = rows.column("_digest").take(order)
    new = pc.not_equal(digests.slice(1), digests.slice(0, max(len(digests) - 1, 0)))
    first = pa.concat_arrays([pa.array([True] * min(len(digests), 1)), new])
    return rows.take(order.filter(first))


def keep_first_stream(
    stream: DataFrame,
    keys: Sequence[str] = PAIR,
    order: Sequence[str] | None = None,
    event_time: str | None = None,
    late: str = "1 day",
    expire_seconds: int | None = None,
) -> DataFrame:
    """The first row of every key, nulls equal (A01 on a stream), given out at the end of the
    micro-batch that has it. An earlier micro-batch comes before a later one; inside one, the
    row first in ``order`` counts, nulls first, and of rows equal there the one with the
    smallest digest. So where files arrive in order the output is that of the batch
    ``keep_first``. Columns of any type pass through unchanged.

    The state is a mark for each 256-bit digest of a key's values, and stays for good.
    With ``event_time`` and ``expire_seconds`` it goes once the watermark, ``late`` behind the
    latest time, has passed the first row's time by so much; the key's next row is then kept
    again. As in any query with a watermark, rows behind it are late and left out; rows
    without a time are never late, and their keys never expire. Large streams want the RocksDB state store
    (spark.sql.streaming.stateStore.providerClass).

    Each Arrow batch is reduced to its first row per key before anything is shuffled, so a key
    that many rows share reaches its task as a row per batch."""
    schema, columns = stream.schema, stream.columns
    clash = [c for c in columns if c in ("_digest", "_row", "_time") or c.startswith("_order")]
    if clash:
        raise ValueError(f"columns {clash} have names that are used inside")
    if (event_time is None) != (expire_seconds is None):
        raise ValueError("expiry needs both event_time and expire_seconds")
    order = list(order or [c for c in columns if c not in keys]) or list(keys)
    time = F.lit(None) if event_time is None else F.col(f"`{event_time}`")
    tagged = stream.select(
        *[F.col(f"`{c}`") for c in columns],
        row_digest(keys, schema).alias("_digest"),
        *[_sortable(c, schema).alias(f"_order{i}") for i, c in enumerate(order)],
        row_digest(columns, schema).alias("_row"),
        time.cast("timestamp").alias("_time"),
    )
    carried, n_order = to_arrow_schema(tagged.schema), len(order)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _firsts(pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(batch.columns, carried)], schema=carried), n_order)
            packed = [rows.slice(i, 1).serialize().to_pybytes() for i in range(rows.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [rows.column("_digest"), rows.column("_time"), pa.array(packed, pa.binary())], names=["_digest", "_time", "packed"]
            )

    def first_seen(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        packed = [p for frame in frames for p in frame["packed"]]
        if state.exists or not packed:
            return
        rows = [pa.ipc.read_record_batch(pa.py_buffer(p), carried) for p in packed]
        best = 0
        if len(rows) > 1:
            merged = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
            best = [r.column("_row")[0] for r in rows].index(_firsts(merged, n_order).column("_row")[0])
        state.update((True,))
        if expire_seconds is not None:
            moment = rows[best].column("_time").cast(pa.int64())[0].as_py()
            if moment is not None:
                past = moment // 1000 + 1000 * expire_seconds
                state.setTimeoutTimestamp(max(past, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"packed": [packed[best]]})

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [pa.ipc.read_record_batch(p.as_buffer(), carried) for p in batch.column("packed")]
            if rows:
                yield from pa.Table.from_batches(rows).select(range(len(columns))).combine_chunks().to_batches()

    reduced = tagged.mapInArrow(reduce, "_digest binary, _time timestamp, packed binary")
    if expire_seconds is not None:
        reduced = reduced.withWatermark("_time", late)
    kept = reduced.groupBy("_digest").applyInPandasWithState(
        first_seen,
        "packed binary",
        "seen boolean",
        "append",
        GroupStateTimeout.NoTimeout if expire_seconds is None else GroupStateTimeout.EventTimeTimeout,
    )
    return kept.mapInArrow(unpack, schema)
