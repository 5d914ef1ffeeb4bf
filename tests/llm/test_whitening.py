"""Whitening against numpy, and the eigen solver by itself."""

import numpy as np
import pytest

from deskcorpus.llm import eigen, whitening
from deskcorpus.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, x string, dimension string, component string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "d", "c") for i, v in rows], SCHEMA).repartition(3)


def expected(rows, k=16):
    """vec_id -> deviation, whitened, explained by numpy alone."""
    good = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.floor(64 * np.array([v for _, v in good], np.float32).astype(float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(0)
    y = fit - total / n
    values, v = np.linalg.eigh(y.T @ y / n)
    values, v = values[::-1][:k], v[:, ::-1][:, :k]
    white = (x - total / n) @ v / np.sqrt(values)
    deviation = ((n * x.astype(object) - total.astype(object)) ** 2).sum(1)
    return [i for i, _ in good], n, deviation, white, values / np.trace(y.T @ y / n)


def check(got, rows, k=16):
    keys, n, deviation, white, explained = expected(rows, k)
    assert len(got) == white.size and (got.n == n).all() and got.identity_error.nunique() == 1
    assert got.identity_error.max() < 1e-8
    for c in range(white.shape[1]):
        mine = got[got.component == c + 1].sort_values(["vec_id", "whitened"])
        assert np.allclose(mine.explained, explained[c], rtol=1e-9)
        sign = np.sign((mine.set_index("vec_id").whitened.to_dict()[keys[0]]) * white[0, c])
        theirs = sorted(zip(keys, sign * white[:, c], deviation))
        assert [t[0] for t in theirs] == mine.vec_id.tolist()
        assert np.allclose([t[1] for t in theirs], mine.whitened, atol=1e-7)
        assert [t[2] for t in theirs] == mine.deviation.tolist()


def test_query(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    got = QUERIES["op12_whitening"](spark, sf_dir).toPandas()
    check(got, [(r.vec_id, r.embedding) for r in table])


def test_nulls_repeats_and_small_dimensions(spark):
    draw = np.random.default_rng(3)
    good = [(i, [float(c) for c in draw.normal(size=5) * [5, 3, 2, 1, 0.5]]) for i in range(80)]
    rows = good + [(100 + i, good[0][1]) for i in range(60)]  # a vector that many rows share counts once
    bad = [(200, None), (201, []), (202, [1.0, None, 2.0, 3.0, 4.0]), (203, [float("nan")] + [1.0] * 4), (204, [float("-inf")] + [1.0] * 4), (205, [1.0, 2.0])]
    got = whitening.whiten_table(vectors(spark, rows + bad)).toPandas()
    check(got, rows, 5)


def test_nothing_to_whiten(spark):
    same = [(i, [1.0, 2.0]) for i in range(5)]
    for rows in ([], [(1, None)], same):
        assert whitening.whiten_table(vectors(spark, rows)).collect() == []


def test_directions_without_variance(spark):
    rows = [(i, [float(i), float(2 * i), 7.0]) for i in range(20)]
    got = whitening.whiten_table(vectors(spark, rows)).toPandas()
    assert set(got.component) == {1} and np.allclose(got.explained, 1.0)


def test_large_deviations_are_exact_or_null():
    whitener = whitening.Whitener(10**6, [10**12, 10**12], np.ones(0), np.zeros((2, 0)), 1.0)
    x = np.array([[10**6 + 2000, 10**6], [10**6 + 4000, 10**6]])
    assert whitener.deviations(x) == [4 * 10**18, None]


@pytest.mark.parametrize("kind", ["any", "repeated", "rank", "diagonal", "zero", "blocks"])
@pytest.mark.parametrize("d", [1, 2, 3, 40])
def test_eigen(kind, d):
    draw = np.random.default_rng(d)
    q, _ = np.linalg.qr(draw.normal(size=(d, d)))
    values = np.sort(draw.random(d))[::-1] * 1000
    if kind == "repeated":
        values[: d // 2] = 900
    if kind == "rank":
        values[1:] = 0
    m = q @ np.diag(values) @ q.T
    if kind == "diagonal":
        m = np.diag(np.round(values / 300))
    if kind == "zero":
        m = np.zeros((d, d))
    if kind == "blocks":
        m = np.kron(np.eye(d // 2 + 1), [[2.0, 1.0], [1.0, 2.0]])[:d, :d]
    m = (m + m.T) / 2
    found, z = eigen.leading_components(m, 16)
    scale = max(np.abs(m).max(), 1.0)
    assert np.abs(found - np.linalg.eigvalsh(m)[::-1][:16]).max() < 1e-12 * scale
    assert np.abs(m @ z - z * found).max() < 1e-12 * scale
    assert np.abs(z.T @ z - np.eye(len(found))).max() < 1e-12
