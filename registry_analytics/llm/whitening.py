"""PCA whitening of embeddings through one triangular factor of the centred rows.

Vectors become integers, so equal ones are exactly equal: the fit list has each once, and its count and sums
are exact. Each task reduces its centred rows block by block to a triangular factor; factors of 32 tasks
are stacked and reduced again until 32 or fewer are left. The driver finds the directions of that one factor by
a bidiagonal qd solver (``bidiagonal_qd``). The covariance matrix is never formed.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import new_work_dir
from .bidiagonal_qd import EPS, right_singular
from .vectors import as_matrix, dimension, integer_vectors, row_slices

FAN_IN = 32
OUT = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exactly: in int64 where that fits, else in Python integers."""
    bound = n * int(np.abs(x).max(initial=0)) + max((abs(s) for s in sums), default=0)
    return x * n - np.array(sums, np.int64) if bound < 1 << 62 else x.astype(object) * n - np.array(sums, object)


def deviations(d: np.ndarray) -> pa.Array:
    """Row sums of squares as decimals, exactly."""
    if d.dtype != object and int(np.abs(d).max(initial=0)) ** 2 * max(1, d.shape[1]) < 1 << 62:
        return pa.array((d * d).sum(axis=1)).cast(pa.decimal128(38, 0))
    return pa.array([Decimal(sum(v * v for v in row)) for row in d.tolist()], pa.decimal128(38, 0))


def slice_rows(size: int) -> int:
    return max(64, 1_000_000 // max(1, size))


def count_and_sums(fit: DataFrame, size: int) -> tuple[int, list[int]]:
    """The number of rows and the sum of each component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * size
        for batch in row_slices(batches, slice_rows(size)):
            x = as_matrix(batch.column("x"), size)
            n += len(x)
            small = int(np.abs(x).max(initial=0)) < (1 << 62) // max(1, len(x))
            total = [a + b for a, b in zip(total, (x if small else x.astype(object)).sum(axis=0).tolist(), strict=True)]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(size + 1), pa.int32()), pa.array([Decimal(v) for v in [*total, n]], pa.decimal128(38, 0))], ["place", "total"])

    found = dict(fit.mapInArrow(run, "place int, total decimal(38,0)").groupBy("place").agg(F.sum("total")).collect())
    return int(found[size]), [int(found[i]) for i in range(size)]


def triangle(rows: np.ndarray, size: int) -> np.ndarray:
    """The square triangular factor of some rows."""
    r = np.linalg.qr(rows, mode="r")
    return np.vstack([r, np.zeros((size - len(r), size))]) if len(r) < size else r


def triangular_factor(fit: DataFrame, size: int, n: int, sums: list[int], folder: str) -> np.ndarray:
    """R of the centred rows of ``fit``: of blocks, then of blocks' factors, ``FAN_IN`` at a time."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for batch in row_slices(batches, slice_rows(size)):
            rows = (centred(as_matrix(batch.column("x"), size), n, sums) / n).astype(np.float64)
            r = triangle(rows if r is None else np.vstack([r, rows]), size)
        if r is not None:
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()])], ["r"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for batch in batches:
            for raw in batch.column("r"):
                other = np.frombuffer(raw.as_buffer()).reshape(size, size)
                r = other if r is None else triangle(np.vstack([r, other]), size)
        if r is not None:
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()])], ["r"])

    spark, level = fit.sparkSession, 0
    made = fit.mapInArrow(blocks, "r binary")
    while True:
        made.write.parquet(f"{folder}/factors-{level}")
        factors = spark.read.parquet(f"{folder}/factors-{level}")
        left = factors.count()
        if left <= FAN_IN:
            stack = np.vstack([np.frombuffer(bytes(row.r)).reshape(size, size) for row in factors.collect()])
            return triangle(stack, size)
        made = factors.repartition(-(-left // FAN_IN)).mapInArrow(merge, "r binary")
        level += 1


def identity_error(fit: DataFrame, size: int, n: int, sums: list[int], directions: np.ndarray) -> float:
    """The largest entry of the whitened fit list's covariance minus the identity."""
    width = directions.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width))
        for batch in row_slices(batches, slice_rows(size)):
            white = (centred(as_matrix(batch.column("x"), size), n, sums) / n).astype(np.float64) @ directions
            total += np.vstack([white.sum(axis=0), white.T @ white])
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], ["place", "total"])

    found = dict(fit.mapInArrow(run, "place int, total double").groupBy("place").agg(F.sum("total")).collect())
    total = np.array([found[i] for i in range((width + 1) * width)]).reshape(width + 1, width) / n
    return float(np.abs(total[1:] - np.outer(total[0], total[0]) - np.eye(width)).max())


def whiten(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    components: int = 16,
    scale: int = 64,
    offset: int = 1_000_000,
) -> DataFrame:
    """One row per row of ``vectors`` with a finite vector, and component (from 1, by falling eigenvalue).

    ``n`` is the number of different vectors, ``deviation`` the exact sum of (n * x - sums) ** 2 over the
    dimensions, ``whitened`` the centred vector's projection over the component's standard deviation,
    ``explained`` the component's share of the variance, ``identity_error`` the largest entry of the
    whitened covariance minus the identity (one value).

    Rows whose vector is null, or holds a null, NaN or infinite entry, go. Null ids stay. Repeated rows are
    given each, and are one row of the fit. Components whose eigenvalue is zero up to rounding have no rows;
    so an empty table, one different vector or empty vectors give none. Vectors of different lengths raise.
    Other columns are not read.
    """
    spark = vectors.sparkSession
    folder = new_work_dir(spark, "whitening")
    integer_vectors(vectors, vec_id, vector, scale, offset).write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    size = dimension(rows)
    if not size:
        return spark.createDataFrame([], OUT)
    rows.select("x").distinct().write.parquet(f"{folder}/fit")
    fit = spark.read.parquet(f"{folder}/fit")
    n, sums = count_and_sums(fit, size)
    squares, v = right_singular(triangular_factor(fit, size, n, sums, folder))
    kept = min(components, int((squares > squares[0] * (4 * size * EPS) ** 2).sum()) if squares[0] > 0 else 0)
    if not kept:
        return spark.createDataFrame([], OUT)
    directions = v[:, :kept] * np.sqrt(n / squares[:kept])
    explained = squares[:kept] / squares.sum()
    error = identity_error(fit, size, n, sums, directions)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches, slice_rows(size)):
            d = centred(as_matrix(batch.column("x"), size), n, sums)
            white = (d / n).astype(np.float64) @ directions
            each = pa.array(np.repeat(np.arange(len(d)), kept))
            m = len(d) * kept
            columns = [
                batch.column("vec_id").take(each),
                pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), len(d))),
                pa.array(np.full(m, n)),
                deviations(d).take(each),
                pa.array(white.ravel()),
                pa.array(np.tile(explained, len(d))),
                pa.array(np.full(m, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, OUT)
