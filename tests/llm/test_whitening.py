"""Whitening against exact sums and a plain decomposition."""

from __future__ import annotations

import math

import numpy as np
import pytest

from querylode.llm import whitening


def rotation(n, seed):
    return np.linalg.qr(np.random.default_rng(seed).normal(size=(n, n)))[0]


@pytest.mark.parametrize("values", [
    np.arange(1.0, 41.0)[::-1], np.geomspace(1e6, 1e-6, 40), np.full(40, 3.0), np.concatenate([[9.0, 5 + 1e-9, 5, 5 - 1e-9, 5 - 2e-9], np.linspace(1, 0.5, 35)]),
    np.concatenate([1 + 1e-7 * np.arange(20)[::-1], np.zeros(20)]), np.zeros(40), np.concatenate([[1e12], np.full(38, 1.0), [0.0]]),
])
def test_refinement(values):
    q = rotation(len(values), 1)
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    found, x = whitening.refined(a)
    scale = max(values.max(), 1e-300)
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-13
    assert np.abs(a @ x - x * found).max() / scale < 1e-13
    assert np.abs(found - values).max() / scale < 1e-13


def test_float32_alone_is_not_enough():
    q = rotation(64, 2)
    a = (q * np.geomspace(100, 1, 64)) @ q.T
    rough = np.linalg.eigh(a.astype(np.float32))[1].astype(float)
    assert np.abs(rough.T @ rough - np.eye(64)).max() > 1e-8
    x = whitening.refined(a)[1]
    assert np.abs(np.abs(q.T @ x) - np.eye(64)).max() < 1e-11


def check(spark, vectors, components=8):
    """``vectors``: (vec_id, list). Compares all that ``whiten`` says with exact whole numbers and numpy's decomposition."""
    rows, fit = whitening.whiten(spark.createDataFrame(vectors, "vec_id long, embedding array<float>").repartition(3), components)
    got = rows.collect()
    usable = [(i, v) for i, v in vectors if v and all(e is not None and math.isfinite(e) for e in v)]
    x = [[math.floor(1024 * float(np.float32(e))) + 100_000 for e in v] for _, v in usable]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    assert fit["n"] == n and fit["sums"] == sums
    want = sorted((str(i), sum((n * e - s) ** 2 for e, s in zip(row, sums))) for (i, _), row in zip(usable, x))
    assert sorted((str(r.vec_id), int(r.deviation)) for r in got) == want
    centred = np.array([[(n * e - s) / n for e, s in zip(row, sums)] for row in x])
    v = centred.T @ centred / n
    values, directions = np.linalg.eigh(v)
    k = min(components, len(sums))
    alive = values[::-1][:k] > len(sums) * np.finfo(float).eps * max(values[-1], 0)
    assert np.allclose(fit["explained"][:k], values[::-1][:k] / (np.trace(v) or 1), rtol=1e-9, atol=1e-12)
    assert fit["identity_error"] < 1e-9
    by = {}
    for r in got:
        by.setdefault(int(r.deviation), []).append(np.array(r.whitened))
    z = centred @ directions[:, ::-1][:, :k] / np.sqrt(np.where(alive, values[::-1][:k], 1)) * alive
    for row, plain in zip(x, z):
        d = sum((n * e - s) ** 2 for e, s in zip(row, sums))
        assert any(np.allclose(np.abs(w), np.abs(plain), atol=1e-6) for w in by[d])
    return got, fit


def test_random_vectors(spark):
    rng = np.random.default_rng(4)
    mix = rng.normal(size=(12, 12)) * np.geomspace(1, 0.01, 12)
    rows = [(i, (rng.normal(size=12) @ mix).astype(np.float32).tolist()) for i in range(300)]
    rows += [(5, rows[5][1]), (None, rows[6][1]), (901, None), (902, []), (903, [1.0, None] + [0.0] * 10), (904, [float("nan")] + [0.0] * 11),
             (905, [float("inf")] + [0.0] * 11)]
    got, _ = check(spark, rows)
    assert len(got) == 302 and len(got[0].whitened) == 8


def test_small_and_degenerate_inputs(spark):
    check(spark, [(1, [0.5, -0.25])])  # one row: no variance anywhere
    check(spark, [(1, [0.5, 1.0, 0.0]), (2, [0.25, 1.0, 0.0]), (3, [0.75, 1.0, 0.0])])  # two directions without variance
    check(spark, [(i, [1e9 * (i % 3), 2.0 * i]) for i in range(9)])  # whole numbers beyond 64 bits once squared
    rows, fit = whitening.whiten(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>"))
    assert rows.collect() == [] and fit["n"] == 0
    rows, fit = whitening.whiten(spark.createDataFrame([], "vec_id long, embedding array<float>, component string"))
    assert rows.collect() == [] and rows.columns == ["vec_id", "deviation", "whitened"]


def test_other_widths_and_columns(spark):
    rows = [(1, [1.0, 2.0], "a"), (2, [2.0, 1.0], "b"), (3, [1.0, 2.0, 3.0], "c"), (4, [0.0, 1.5], None)]
    out, fit = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>, whitened string"))
    assert fit["n"] == 3 and sorted(r.vec_id for r in out.collect()) == [1, 2, 4]


def test_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/embeddings.parquet")
    check(spark, [(r.vec_id, r.embedding) for r in docs.collect()])
