"""Embedding columns as integer vectors: rows that hold no finite vector go, components become floor(scale * x) + offset."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F


def integer_vectors(table: DataFrame, vec_id: str, vector: str, scale: int, offset: int = 0, label: str | None = None) -> DataFrame:
    """``vec_id long, x array<long>`` (and ``label`` with its type) of each row whose vector is neither null nor holds a null, NaN or infinity.

    ``scale`` is a power of two, so the product is exact. A component beyond 2 ** 62 after scaling raises.
    """
    read = [F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("x")]
    kind = "vec_id long, x array<long>"
    if label is not None:
        read.append(F.col(label).alias("label"))
        kind += f", label {table.schema[label].dataType.simpleString()}"
    carried = ["vec_id"] + ["label"] * (label is not None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column("x").is_valid())
            column = batch.column("x")
            size = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
            values = column.flatten()
            number = pc.fill_null(values, np.nan).to_numpy(zero_copy_only=False)
            bad = np.bincount(np.repeat(np.arange(len(size)), size), weights=~np.isfinite(number), minlength=len(size)) > 0
            inside = np.repeat(~bad, size)
            scaled = np.floor(number[inside] * scale)
            if len(scaled) and np.abs(scaled).max() >= 2.0**62:
                raise ValueError("a vector component is too large for integer arithmetic")
            whole = scaled.astype(np.int64) + offset
            good = batch.filter(pa.array(~bad))
            ends = np.concatenate([[0], np.cumsum(size[~bad])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(whole))
            columns = {"vec_id": good.column("vec_id"), "x": lists}
            if label is not None:
                columns["label"] = good.column("label")
            yield pa.RecordBatch.from_arrays([columns[c] for c in ["vec_id", "x", *carried[1:]]], ["vec_id", "x", *carried[1:]])

    return table.select(*read).mapInArrow(run, kind)


def dimension(rows: DataFrame) -> int | None:
    """The length that all vectors ``x`` have; None without rows. Vectors of different lengths raise."""
    low, high = rows.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if low != high:
        raise ValueError(f"vectors of different lengths: {low} to {high}")
    return low


def as_matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column of equal lengths as an integer matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def row_slices(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The batches, cut to ``most`` rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, most):
            yield batch.slice(at, most)
