"""Numpy helpers over the UTF-8 bytes of an Arrow string column: spans, and 64-bit hashes of any span.

A batch's texts are one byte array and n + 1 offsets; nothing is decoded to Python strings. Span
hashes come from one polynomial prefix sum modulo 2**64, so a span of any length costs two lookups.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Hashable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
#: Powers kept per worker; a longer slice (one text of over 1 MB) makes its own.
POWERS = 1_100_000


def release() -> None:
    """Return the worker's freed memory to the system: Arrow's pool and the C heap keep it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, after whose tasks the worker gives back what it has freed: it lives on beside the next stage's JVM memory."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return tidied


def worker_cache(owner: Hashable) -> dict:
    """A dict that a Python worker keeps for its next tasks (functions pickled by value get new globals per task), until another owner asks for one.

    A worker serves one stage after another: what an earlier one kept is let go, and its memory returned.
    """
    held = sys.__dict__.setdefault("_registry_llm_worker_cache", {})
    if owner not in held:
        held.clear()
        release()
        held[owner] = {}
    return held[owner]


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: spreads every input bit over the word."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_slices(batch: pa.RecordBatch, column: str, most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """Consecutive row slices with about ``most`` bytes of text each; a longer text is a slice alone."""
    if batch.num_rows == 0:
        return
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        done = size[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(size, done + most, "right")))
        yield batch.slice(at, end - at)
        at = end


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    kind = np.int64 if wide else np.int32
    off = np.frombuffer(offsets, kind, len(column) + 1, column.offset * kind().itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and BASE ** -i for i < n; the first ``POWERS`` are kept per worker, for all owners."""
    if n > POWERS:
        return make_powers(n)
    name = "_registry_llm_powers"
    if name not in sys.__dict__:
        sys.__dict__[name] = make_powers(POWERS)
    up, down = sys.__dict__[name]
    return up[:n], down[:n]


def make_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up, down = np.full(n, BASE, np.uint64), np.full(n, BASE_INVERSE, np.uint64)
        up[0] = down[0] = 1
        return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def byte_codes() -> np.ndarray:
    """A fixed random-looking odd word for each byte value."""
    return mix(np.arange(1, 257, dtype=np.uint64) * BASE) | np.uint64(1)


class SpanHash:
    """64-bit hashes of spans [start, end) of one byte array."""

    def __init__(self, data: np.ndarray):
        up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(byte_codes()[data] * up[: len(data)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def runs(mask: np.ndarray, breaks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True; a run also ends at every position in ``breaks``."""
    edge = np.zeros(len(mask) + 1, np.int8)
    edge[1:-1] = mask[1:] != mask[:-1]
    if len(mask):
        edge[0], edge[-1] = mask[0], mask[-1]
    starts, ends = edge.copy(), edge
    if breaks is not None and len(mask):
        inner = breaks[(breaks > 0) & (breaks < len(mask))]
        inner = inner[mask[inner] & mask[inner - 1]]
        starts, ends = edge.copy(), edge.copy()
        starts[inner] = ends[inner] = 1
    start = np.flatnonzero(starts[:-1] & mask) if len(mask) else np.zeros(0, np.int64)
    end = np.flatnonzero(ends[1:] & mask) + 1 if len(mask) else np.zeros(0, np.int64)
    return start, end


def rows_of(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The row that holds each byte position."""
    return np.searchsorted(offsets, starts, "right") - 1


def gather(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The positions of all given spans, one span after another."""
    total = int(length.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    first = np.cumsum(length) - length
    return np.arange(total, dtype=np.int64) + np.repeat(start - first, length)
