"""Whitening against an eigendecomposition of the whole covariance."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, components=16):
    kept = [(i, v) for i, v, _ in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * c) for c in v] for _, v in kept])
    u = np.unique(x, axis=0)
    n, total = len(u), u.sum(axis=0)
    y = u - u.mean(axis=0)
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, int((values > 1e-9 * values[0]).sum())) if values[0] > 0 else 0
    return ([i for i, _ in kept], n, ((n * x - total) ** 2).sum(axis=1).tolist(),
            (x - u.mean(axis=0)) @ vectors[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum())


def compare(df, rows):
    ids, n, deviation, white, explained = plain(rows)
    got = whitening.whiten(df).collect()
    key = lambda r: (str(r[0]), r[1])
    assert sorted(((r["vec_id"], r["deviation"]) for r in got), key=key) == sorted(zip(ids, deviation), key=key)
    assert all(r["n"] == n and r["identity_error"] < 1e-9 for r in got)
    assert all(np.allclose(r["explained"], explained, rtol=1e-9) for r in got)
    mine = {r["vec_id"]: np.array(r["whitened"]) for r in got}
    same = [i for i in mine if i is not None and ids.count(i) == 1]
    a, b = np.array([mine[i] for i in same]), np.array([white[ids.index(i)] for i in same])
    assert a.shape == b.shape
    assert np.abs(a * np.sign((a * b).sum(axis=0)) - b).max(initial=0) < 1e-8
    return got


def vectors(n, dims, seed, scale=0.3):
    rng = np.random.default_rng(seed)
    spread = np.linspace(2, 0.5, dims)
    return [(i, [float(c) for c in v * spread * scale], i % 3) for i, v in enumerate(rng.standard_normal((n, dims)).astype(np.float32))]


def test_odd_rows(spark):
    rows = vectors(400, 40, 1)
    rows += [(1000, None, 1), (1001, [], 1), (1002, [None] + [0.5] * 39, 1), (1003, [float("nan")] * 40, 1),
             (1004, [float("inf")] + [0.0] * 39, 1), (1005, rows[0][1], 2), (1005, rows[0][1], 2), (None, rows[1][1], 1),
             (None, None, 1), (1006, [30.0] * 40, 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = compare(df, rows)
    assert len(got) == 404 and len(got[0]["whitened"]) == 16
    clash = df.select("*", *[F.lit(1).alias(c) for c in ("id", "n", "x", "dims", "v", "whitened", "component")])
    again = whitening.digest(whitening.whiten(clash))
    assert again.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert again.count() == 16 * 404


def test_a_close_spectrum_and_a_dominant_component(spark):
    rng = np.random.default_rng(5)
    away = rng.standard_normal((900, 1)) * np.ones((1, 64))
    x = (0.12 * rng.standard_normal((900, 64)) + 4 * away).astype(np.float32)
    rows = [(i, [float(c) for c in v], 0) for i, v in enumerate(x)]
    compare(spark.createDataFrame(rows, SCHEMA), rows)


@pytest.mark.parametrize("dims,n", [(1, 20), (3, 50), (24, 60), (50, 9)])
def test_few_dimensions_and_low_rank(spark, dims, n):
    rows = vectors(n, dims, 3)
    got = compare(spark.createDataFrame(rows, SCHEMA), rows)
    assert len(got[0]["whitened"]) == min(dims, n - 1, 16)


def test_no_variance_no_rows(spark):
    same = spark.createDataFrame([(i, [0.1, 0.2], 0) for i in range(5)], SCHEMA)
    got = whitening.whiten(same)
    assert got.count() == 5 and whitening.digest(got).count() == 0
    for rows in ([], [(1, None, 1)], [(2, [], 1)]):
        empty = whitening.digest(whitening.whiten(spark.createDataFrame(rows, SCHEMA)))
        assert empty.count() == 0 and len(empty.columns) == 7
    with pytest.raises(ValueError):
        whitening.whiten(spark.createDataFrame([(1, [1.0], 1), (2, [1.0, 2.0], 1)], SCHEMA))


def test_deviation_beyond_a_long():
    away = np.array([[3, -4], [1 << 20, 0]])
    assert whitening._deviation(away, 1 << 31, [5, 7]) == [((1 << 31) * 3 - 5) ** 2 + ((1 << 31) * -4 - 7) ** 2
                                                           if ((1 << 31) * 3) ** 2 < 1 << 62 else None, None]
    assert whitening._deviation(away, 10, [5, 7]) == [25**2 + 47**2, ((10 << 20) - 5) ** 2 + 49]
