"""Whitening of embeddings: distributed centred covariance, leading components, projection.

Entries become integers, so sums, means and deviations are exact. The covariance is taken
over the distinct vectors, centred before multiplying: every task adds up its own outer
products, and the matrices of all tasks are summed by row as streams, a row of the matrix in
memory at a time. Only that matrix, whose size is set by the dimension and not by the rows,
comes to the driver, where :mod:`eigen` finds its leading components; they are broadcast
within the functions that project."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskcorpus.llm.common import partitions, slices_as_binary, text_bytes, tidy
from deskcorpus.llm.eigen import EPS, leading_components
from deskcorpus.stages import materialize

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
LIMIT = 2.0**40  # entries of this size and above count as not finite
LONG = 2**63


def integer_vectors(vectors: DataFrame, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(vec_id, dimension, x) of the usable rows, written once; ``x`` holds
    floor(64 c) + 1000000 of every entry c, as little-endian 64-bit integers.

    Rows whose vector is null or empty, or holds null or non-finite entries, are left out,
    as are entries beyond 2**40, which would not be exact."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v").filter(pc.is_valid(batch.column("v")))
            keys = batch.column("vec_id").filter(pc.is_valid(batch.column("v")))
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null becomes NaN
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            wrong = np.concatenate([[0], np.cumsum(~(np.abs(flat) < LIMIT))])[bounds]
            good = (np.diff(wrong) == 0) & (sizes > 0)
            flat = flat[np.repeat(good, sizes)]
            x = np.floor(SCALE * flat).astype("<i8") + SHIFT
            kept = sizes[good]
            yield pa.RecordBatch.from_arrays(
                [
                    keys.filter(pa.array(good)),
                    pa.array(kept.astype(np.int32)),
                    slices_as_binary(x, np.concatenate([[0], np.cumsum(kept)])),
                ],
                names=["vec_id", "dimension", "x"],
            )

    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v"))
    return materialize(rows.mapInArrow(tidy(convert), "vec_id long, dimension int, x binary"))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return text_bytes(column)[0].view("<i8").reshape(-1, d)


def _summed(rows: DataFrame, per_batch, d: int, shape: tuple[int, int]) -> np.ndarray:
    """The sum over all rows of the matrices of ``shape`` that ``per_batch`` makes of the x
    vectors of a batch. Tasks add up their own; a row of the matrix then meets in one task,
    as a stream with a share from each task. One such matrix reaches the driver."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            total += per_batch(_matrix(batch.column("x"), d))
        if total.any():
            numbers = pa.array(np.arange(len(total), dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [numbers, slices_as_binary(total.ravel(), np.arange(len(total) + 1) * shape[1])], names=["i", "part"]
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, total = None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([row], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["i", "part"])

        for batch in batches:
            for i, part in zip(batch.column("i").to_pylist(), batch.column("part")):
                values = np.frombuffer(part.as_buffer(), "<f8")
                if i != row and row is not None:
                    yield done()
                total = values + total if i == row else values.copy()
                row = i
        if row is not None:
            yield done()

    schema = "i int, part binary"
    sums = (
        rows.select("x")
        .mapInArrow(partial, schema)
        .repartition(min(partitions(rows.sparkSession), shape[0]), "i")
        .sortWithinPartitions("i")
        .mapInArrow(add, schema)
    )
    out = np.zeros(shape)
    for r in sums.collect():
        out[r["i"]] = np.frombuffer(r["part"], "<f8")
    return out


def _integer_sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of vectors and their exact sum in every dimension."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(d, object)
        for batch in batches:
            x = _matrix(batch.column("x"), d)
            n += len(x)
            if len(x):
                total = total + (x - SHIFT).sum(0).astype(object)  # exact: below 2**46 each
        if n:
            values = [n, *total.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(range(d + 1), pa.int32()), pa.array([str(v) for v in values])], names=["i", "part"])

    sums = fit.select("x").mapInArrow(partial, "i int, part string").groupBy("i")
    found = {r["i"]: int(r["total"]) for r in sums.agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect()}
    n = found.get(0, 0)
    return n, [found.get(i + 1, 0) + n * SHIFT for i in range(d)]


class Whitener:
    """What is learnt from the distinct vectors: count, sums, components, their eigenvalues
    and the trace of the covariance."""

    def __init__(self, n: int, sums: list[int], values: np.ndarray, components: np.ndarray, trace: float):
        self.n, self.sums, self.values, self.components, self.trace = n, sums, values, components, trace
        self.base = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n for s in sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n; the integer part is taken off exactly."""
        return (x - self.base) - self.rest / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, exact; None beyond a 64-bit integer."""
        y = x - self.base
        reach = (int(np.abs(y).max(initial=0)) + 1) * self.n
        if reach * reach * y.shape[1] < LONG:
            return ((self.n * y - self.rest) ** 2).sum(1).tolist()
        exact = ((self.n * y.astype(object) - self.rest.astype(object)) ** 2).sum(1).tolist()
        return [v if v < LONG else None for v in exact]


def fit_whitener(fit: DataFrame, d: int, components: int = COMPONENTS) -> Whitener | None:
    """Learn from distinct vectors of ``d`` entries; None without any. Directions in which
    they do not vary have no component."""
    n, sums = _integer_sums(fit, d)
    if not n:
        return None
    start = Whitener(n, sums, np.ones(0), np.zeros((d, 0)), 0.0)

    def products(x: np.ndarray) -> np.ndarray:
        y = start.centred(x)
        return y.T @ y

    covariance = _summed(fit, products, d, (d, d)) / n
    trace = float(np.trace(covariance))
    values, vectors = leading_components(covariance, components)
    some = values > d * EPS * max(values.max(initial=0.0), 0.0)
    return Whitener(n, sums, values[some], vectors[:, some], trace)


def identity_error(fit: DataFrame, whitener: Whitener, d: int) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity,
    measured on all distinct vectors."""
    k = len(whitener.values)

    def moments(x: np.ndarray) -> np.ndarray:
        w = whitener.whitened(x)
        return np.concatenate([w.T @ w, w.sum(0)[None]])

    found = np.zeros((k + 1, k))
    if k:
        found = _summed(fit, moments, d, (k + 1, k)) / whitener.n
    mean = found[-1]
    return float(np.abs(found[:-1] - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


def whitened_rows(rows: DataFrame, whitener: Whitener, error: float, d: int) -> DataFrame:
    """A row per vector and component, with the columns of :func:`whiten_table`."""
    k = len(whitener.values)
    explained = whitener.values / whitener.trace if k else whitener.values

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), d)
            m = len(x)
            owner = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(owner),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, whitener.n)),
                    pa.array(whitener.deviations(x), pa.int64()).take(owner),
                    pa.array(whitener.whitened(x).ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return rows.select("vec_id", "x").mapInArrow(tidy(project), schema)


def whiten_table(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every usable
    row and component.

    Rows without a usable vector are left out (see :func:`integer_vectors`). All vectors
    should be of one dimension; where they are not, the one with most rows counts, the larger
    of two alike, and other rows are left out. Repeated vectors count once in the fit and
    appear for every row that has them, null keys included. With one distinct vector, or an
    empty table, nothing varies and there are no rows; eigenvalues of zero have none
    either. ``deviation`` is null where it does not fit a long."""
    rows = integer_vectors(vectors)
    sizes = rows.groupBy("dimension").count().orderBy(F.desc("count"), F.desc("dimension")).first()
    d = sizes["dimension"] if sizes else 1
    rows = rows.where(F.col("dimension") == d)
    fit = materialize(rows.select("x").distinct())
    whitener = fit_whitener(fit, d, components)
    if whitener is None:
        whitener = Whitener(1, [0] * d, np.ones(0), np.zeros((d, 0)), 0.0)
    return whitened_rows(rows, whitener, identity_error(fit, whitener, d), d)
