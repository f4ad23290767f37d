"""Whitening of embeddings: eigenvectors of a distributed covariance, found in float32 and refined in float64.

Entries become whole numbers first, so that counts, sums and deviations are exact. Two passes over the vectors give the sums and the
covariance (centred before multiplying; one matrix per task, added up row by row of the matrix). Only matrices of the vectors' width
reach the driver. There a float32 decomposition is corrected by Ogita and Aishima's iteration, which needs nothing but matrix
products in the higher precision and converges quadratically. Where eigenvalues lie closer together than the iteration can tell
apart, the cluster's own small problem, shifted by its mean eigenvalue, is solved and its basis turned.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from querylode import lineage

SCALE, OFFSET = 1024, 100_000
#: Vectors taken at a time, in numbers.
BLOCK = 1 << 20
#: Largest absolute entry whose x is a long.
LIMIT = float(1 << 52)


def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(width of each vector, -1 where it is not usable; the usable ones' entries in a row as doubles)."""
    column = column.cast(pa.large_list(pa.float64()))
    width = np.full(len(column), -1, np.int64)
    valid = np.asarray(column.is_valid())
    width[valid] = np.diff(np.asarray(column.offsets))[valid] if column.null_count else np.diff(np.asarray(column.offsets))
    flat = column.flatten()
    entries = flat.fill_null(np.nan).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(column)), np.maximum(width, 0))
    bad = ~(np.abs(entries) < LIMIT)
    width[owner[bad]] = -1
    width[width == 0] = -1
    return width, entries[width[owner] >= 0]


def integers(entries: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * entries).astype(np.int64) + OFFSET


def _blocks(batches: Iterator[pa.RecordBatch], vector: str, dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(batch, places of the usable rows of ``dims`` entries, their whole numbers), in pieces of bounded size."""
    step = max(1, BLOCK // max(dims, 1))
    for batch in batches:
        for first in range(0, len(batch), step):
            part = batch.slice(first, step)
            width, entries = _vectors(part.column(vector))
            usable = np.repeat(width[width >= 0], width[width >= 0]) == dims
            yield part, np.flatnonzero(width == dims), integers(entries[usable]).reshape(-1, dims)


def _widths(vector: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width, n = np.unique(_vectors(batch.column(vector))[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(width), pa.array(n)], names=["width", "n"])

    return count


def _sum(x: np.ndarray) -> list[int]:
    """Exact sums of the columns; in Python's whole numbers where 64 bits might not do."""
    if not len(x) or int(np.abs(x).max()) * len(x) < 1 << 62:
        return x.sum(0).tolist()
    return [sum(c) for c in x.T.tolist()]


def _sums(vector: str, dims: int):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * dims
        for _, _, x in _blocks(batches, vector, dims):
            total = [a + b for a, b in zip(total, _sum(x))]
        yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))], names=["dim", "total"])

    return add


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exact; of Python's whole numbers where 64 bits might not do."""
    if len(x) and max(int(np.abs(x).max()) * n, max(map(abs, sums))) >= 1 << 62:
        return x.astype(object) * n - np.array(sums, object)
    return x * n - np.array([s if abs(s) < 1 << 62 else 0 for s in sums], np.int64)


def _squares(d: np.ndarray) -> pa.Array:
    """Sums of squares of the rows."""
    if d.dtype == object or len(d) and int(np.abs(d).max()) ** 2 * d.shape[1] >= 1 << 63:
        return pa.array([Decimal(sum(v * v for v in row)) for row in d.tolist()], pa.decimal128(38, 0))
    return pa.array((d * d).sum(1)).cast(pa.decimal128(38, 0))


def _gram(blocks: Iterator[np.ndarray], dims: int) -> Iterator[pa.RecordBatch]:
    """One row per row of the sum of products; the blocks' products are added in extended precision."""
    total = np.zeros((dims, dims), np.longdouble)
    for rows in blocks:
        total += rows.T @ rows
    lines = [r.astype(np.float64).tobytes() for r in total]
    task = np.full(dims, TaskContext.get().partitionId(), np.int32)
    yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array(task), pa.array(lines, pa.binary())], names=["dim", "task", "line"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of one dimension summed, those of equal dimensions following each other."""
    at, total = None, None
    lines = ((d, l) for batch in batches for d, l in zip(batch.column("dim").to_pylist(), batch.column("line").to_pylist()))
    for dim, line in lines:
        if dim != at and at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([total.astype(np.float64).tobytes()])], names=["dim", "line"])
            total = None
        at, values = dim, np.frombuffer(line).astype(np.longdouble)
        total = values if total is None else total + values
    if at is not None:
        yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([total.astype(np.float64).tobytes()])], names=["dim", "line"])


def _matrix(partial: DataFrame, dims: int) -> np.ndarray:
    """The sum of the tasks' matrices, each of its rows added up in one place and in the order of the tasks."""
    rows = partial.repartition("dim").sortWithinPartitions("dim", "task").mapInArrow(_added, "dim int, line binary").toArrow()
    out = np.zeros((dims, dims))
    for dim, line in zip(rows["dim"].to_pylist(), rows["line"].to_pylist()):
        out[dim] = np.frombuffer(line)
    return (out + out.T) / 2


def refined(a: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors in columns) of a symmetric matrix, falling, to the precision of ``a``.

    Starts from a float32 decomposition and applies the iteration until the correction stays at rounding level. Exactly or nearly
    equal eigenvalues have an orthonormal basis of their space.
    """
    size = float(np.linalg.norm(a)) or 1.0
    a = a / size
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.float64)
    eye, small = np.eye(len(a)), len(a) * np.finfo(np.float64).eps
    # Closer than this, rounding errors over the gap would be corrections whose squares show.
    least = np.sqrt(np.finfo(np.float64).eps)
    for _ in range(rounds):
        r = eye - x.T @ x
        s = x.T @ a @ x
        value = np.diag(s) / (1 - np.diag(r))
        spread = max(least, 2 * (np.linalg.norm(s - np.diag(value)) + np.linalg.norm(r)))
        gap = value[None, :] - value[:, None]
        near = np.abs(gap) <= spread
        step = np.where(near, r / 2, (s + value[None, :] * r) / np.where(near, 1, gap))
        x = x + x @ step
        change = float(np.abs(step).max())
        # Runs of eigenvalues too close for the iteration: the shifted problem in their space tells them apart.
        order = np.argsort(-value, kind="stable")
        x = x[:, order]
        parts = np.split(np.arange(len(a)), np.flatnonzero(-np.diff(value[order]) > spread) + 1)
        for part in (p for p in parts if len(p) > 1):
            basis = np.linalg.qr(x[:, part])[0]
            inner = basis.T @ (a @ basis - value[order][part].mean() * basis)
            x[:, part] = basis @ np.linalg.eigh((inner + inner.T) / 2)[1][:, ::-1]
        if change <= small:
            break
    x = x + x @ (eye - x.T @ x) / 2  # what turning the clusters left of their angles to the others
    value = np.einsum("ij,ij->j", x, a @ x) / np.einsum("ij,ij->j", x, x)
    order = np.argsort(-value, kind="stable")
    x = x[:, order] / np.linalg.norm(x[:, order], axis=0)
    return value[order] * size, x


def _whitened(vector: str, vec_id: str, dims: int, n: int, sums: list[int], matrix: np.ndarray):
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, rows, x in _blocks(batches, vector, dims):
            d = _deviations(x, n, sums)
            z = (d.astype(np.float64) / n) @ matrix
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1, dtype=np.int32) * matrix.shape[1]), pa.array(z.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(vec_id).take(pa.array(rows)), _squares(d), lists], names=["vec_id", "deviation", "whitened"])

    return project


def whiten(vectors: DataFrame, components: int = 8, vec_id: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, dict]:
    """(vec_id, deviation decimal(38,0), whitened array<double> of the first ``components`` of every usable row of ``vectors``,
    the fit: n, sums, covariance, eigenvalues, components, explained, identity_error).

    Left out are rows whose vector is null, empty, or holds null or non-finite entries or some whose whole number is no long (2^52 and
    more), and vectors of another width than the most frequent (of equally frequent the largest). Repeated rows count as often as
    they occur; ids may be null. With fewer dimensions there are as many components. A direction without variance (at rounding level) has
    whitened 0 and no part in identity_error. No usable rows: no result rows, and a fit with n = 0. The covariance divides by n.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    widths = rows.select("vector").mapInArrow(_widths("vector"), "width long, n long").where("width > 0")
    usual = widths.groupBy("width").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("width")).first()
    if usual is None:
        none = vectors.sparkSession.createDataFrame([], "vec_id long, deviation decimal(38,0), whitened array<double>")
        return none, {"n": 0, "sums": [], "covariance": np.zeros((0, 0)), "eigenvalues": np.zeros(0), "components": np.zeros((0, 0)),
                      "explained": np.zeros(0), "identity_error": 0.0}
    dims, n = usual["width"], usual["n"]
    total = rows.select("vector").mapInArrow(_sums("vector", dims), "dim int, total decimal(38,0)").groupBy("dim").agg(F.sum("total").cast("decimal(38,0)").alias("total"))
    sums = [int(r["total"]) for r in sorted(total.collect(), key=lambda r: r["dim"])]

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _gram((_deviations(x, n, sums).astype(np.float64) / n for _, _, x in _blocks(batches, "vector", dims)), dims)

    partial = "dim int, task int, line binary"
    covariance = _matrix(rows.select("vector").mapInArrow(products, partial), dims) / n
    values, directions = refined(covariance)
    kept = min(components, dims)
    alive = values[:kept] > dims * np.finfo(np.float64).eps * max(values[0], 0.0)
    scale = np.where(alive, 1 / np.sqrt(np.where(alive, values[:kept], 1)), 0)
    matrix = directions[:, :kept] * scale
    schema = "vec_id long, deviation decimal(38,0), whitened array<double>"
    out = lineage.stored(rows.mapInArrow(_whitened("vector", "vec_id", dims, n, sums, matrix), schema), "whitened")

    # The result's own covariance, centred at its own mean.
    means = np.array(out.agg(*[F.avg(F.col("whitened")[i]) for i in range(kept)]).first(), np.float64)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _gram((b.column("whitened").flatten().to_numpy().reshape(-1, kept) - means for b in batches), kept)

    error = np.abs(_matrix(out.select("whitened").mapInArrow(own, partial), kept) / n - np.eye(kept))[np.ix_(alive, alive)]
    trace = float(np.trace(covariance))
    fit = {"n": n, "sums": sums, "covariance": covariance, "eigenvalues": values, "components": directions,
           "explained": values / trace if trace > 0 else np.zeros(dims), "identity_error": float(error.max()) if error.size else 0.0}
    return out, fit
