"""Vector codes by product quantisation, with nearest entries found through memoised grid cells.

Integer vectors are cut into equal parts; each part has a codebook of a few entries that rounds of
assign-and-average refine. To find the nearest entry of a part, the part's coarse grid cell is looked up
in a memo: it holds the entries that some point of the cell's box may have nearest, which are those whose
least distance to the box is not above another entry's greatest. Only these are evaluated exactly.

All arithmetic is on integers. Codebooks are ``entries`` vectors, however many rows there are; they are all
that passes through the driver, with one row of sums per part and entry of each task added up by Spark.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import new_work_dir
from .links import hub_join
from .spans import worker_cache
from .vectors import as_matrix, dimension, integer_vectors, row_slices

#: Cells that a worker remembers for one part and codebook; it forgets all of them when there are more.
MEMO_CELLS = 1 << 17


@dataclass
class Codes:
    """``rows`` (``vec_id, label, code, error, label_error``) and the final codebooks [part, entry, component]."""

    rows: DataFrame
    codebooks: np.ndarray

    def digest(self) -> str:
        """SHA-256 of all components of the entries, by part, entry and position."""
        return hashlib.sha256(",".join(map(str, self.codebooks.ravel().tolist())).encode()).hexdigest()


def wide_enough(*arrays: np.ndarray) -> type:
    """int64 if sums of squared differences of these arrays' rows fit, else Python integers."""
    low = min((int(a.min()) for a in arrays if a.size), default=0)
    high = max((int(a.max()) for a in arrays if a.size), default=0)
    return np.int64 if (high - low + 1) ** 2 * max(a.shape[-1] for a in arrays) < 1 << 62 else object


class NearestEntry:
    """Nearest entries of one codebook [entry, component]; equal distances go to the lower index."""

    def __init__(self, book: np.ndarray, memo: dict[bytes | int, int]):
        self.book, self.memo = book, memo
        self.shift = self.cell_bits(book)

    @staticmethod
    def cell_bits(book: np.ndarray) -> int:
        """Cells are 2 ** bits wide: their diagonal is at most the mean distance of an entry to its nearest other one."""
        if book.size == 0:
            return 0
        real = book.astype(np.float64)
        apart = np.sqrt(((real[:, None] - real[None]) ** 2).sum(axis=2))
        apart[np.diag_indices(len(book))] = np.inf
        nearest = apart.min(axis=1)
        nearest = nearest[np.isfinite(nearest) & (nearest > 0)]
        width = nearest.mean() / np.sqrt(book.shape[1]) if len(nearest) else 1.0
        return max(0, int(np.floor(np.log2(max(width, 1.0)))))

    def candidates(self, cells: np.ndarray) -> np.ndarray:
        """For each cell a bit set of the entries not dominated across its box."""
        kind = wide_enough((cells << self.shift) + (1 << self.shift), cells << self.shift, self.book)
        least, most = np.zeros((2, len(cells), len(self.book)), kind)
        for d in range(cells.shape[1]):  # distances to a box add up over its sides; few sides are different
            side, at = np.unique(cells[:, d], return_inverse=True)
            low = (side << self.shift).astype(kind)[:, None]
            high, entry = low + ((1 << self.shift) - 1), self.book[:, d].astype(kind)[None]
            least += (np.maximum(np.maximum(low - entry, entry - high), 0) ** 2)[at]
            most += (np.maximum(entry - low, high - entry) ** 2)[at]
        return (least <= most.min(axis=1)[:, None]) @ (1 << np.arange(len(self.book), dtype=np.int64))

    def keys(self, cells: np.ndarray) -> np.ndarray:
        """A key of each cell, different for different cells: its coordinates in one word where they fit, else their bytes."""
        bits = 64 // max(1, cells.shape[1])
        if bits > 1 and len(cells) and -(1 << (bits - 1)) <= cells.min() and cells.max() < 1 << (bits - 1):
            low = cells.astype(np.uint64) & np.uint64((1 << bits) - 1)
            return np.bitwise_or.reduce(low << (np.uint64(bits) * np.arange(cells.shape[1], dtype=np.uint64)), axis=1)
        return np.ascontiguousarray(cells).view(f"V{8 * cells.shape[1]}").ravel()

    def lookup(self, cells: np.ndarray, keys: list[bytes | int]) -> np.ndarray:
        """The bit sets of different cells, from the memo where it has them."""
        found = np.fromiter(map(self.memo.get, keys, repeat(0)), np.int64, len(keys))
        new = np.flatnonzero(found == 0)  # no bit set is empty
        if len(new):
            found[new] = self.candidates(cells[new])
            if len(self.memo) + len(new) > MEMO_CELLS:
                self.memo.clear()
            self.memo.update(zip([keys[i] for i in new.tolist()], found[new].tolist(), strict=True))
        return found

    def __call__(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry of each row."""
        cells = parts >> self.shift
        keys, first, cell_of = np.unique(self.keys(cells), return_index=True, return_inverse=True)
        sets = self.lookup(cells[first], [k.tobytes() for k in keys] if keys.dtype.kind == "V" else keys.tolist())[cell_of]
        row, entry = np.nonzero((sets[:, None] >> np.arange(len(self.book))) & 1)
        kind = wide_enough(parts, self.book)
        distance = ((parts[row].astype(kind) - self.book[entry].astype(kind)) ** 2).sum(axis=1)
        begin = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        least = np.minimum.reduceat(distance, begin)
        hit = np.flatnonzero(distance == least[row])  # rows are in order, and entries in each row
        one = hit[np.append(True, row[hit][1:] != row[hit][:-1])]
        return entry[one], least


def finders(books: np.ndarray) -> list[NearestEntry]:
    """One finder a part; their memos stay with the worker while it serves these codebooks."""
    held = worker_cache(("vector_codes", hashlib.sha256(books.tobytes()).hexdigest()))
    return [NearestEntry(book, held.setdefault(part, {})) for part, book in enumerate(books)]


def assign(x: np.ndarray, find: list[NearestEntry]) -> tuple[np.ndarray, np.ndarray]:
    """(indexes, squared distances) [row, part] of whole vectors."""
    parts = x.reshape(len(x), len(find), -1)
    if parts.shape[2] == 0:
        return np.zeros(parts.shape[:2], np.int64), np.zeros(parts.shape[:2], np.int64)
    both = [f(parts[:, i]) for i, f in enumerate(find)]
    return np.stack([b[0] for b in both], axis=1), np.stack([b[1] for b in both], axis=1)


def slice_rows(books: np.ndarray) -> int:
    """Rows to take at once, so that rows x entries x components of a part stay near two million numbers."""
    return max(1, 2_000_000 // max(1, books.shape[1] * books.shape[2]))


def seeds(rows: DataFrame, entries: int) -> list[list[int]]:
    """The vectors of the smallest ids, ascending, null last; of an id with several vectors the least one."""
    out: list[list[int]] = []
    last = None
    while len(out) < entries:  # one job, unless ids repeat
        left = rows.where("vec_id IS NOT NULL") if last is None else rows.where(F.col("vec_id") > last)
        found = left.select("vec_id", "x").orderBy("vec_id", "x").limit(entries).collect()
        if not found:
            null = rows.where("vec_id IS NULL").select("x").orderBy("x").limit(1).collect()
            return out + [r.x for r in null]
        for r in found:
            if r.vec_id != last and len(out) < entries:
                out.append(r.x)
                last = r.vec_id
    return out


def refine(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: each used entry becomes its parts' componentwise floor of the mean."""
    n_parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = finders(books)
        count, total = np.zeros((n_parts, entries), np.int64), np.zeros((n_parts, entries, width), object)
        for batch in row_slices(batches, slice_rows(books)):
            x = as_matrix(batch.column("x"), n_parts * width)
            index, _ = assign(x, find)
            parts = x.reshape(len(x), n_parts, width)
            for p in range(n_parts):
                order = np.argsort(index[:, p], kind="stable")
                used, begin = np.unique(index[order, p], return_index=True)
                sums = np.add.reduceat(parts[order, p].astype(np.int64 if np.abs(parts[:, p]).max(initial=0) < 1 << 40 else object), begin, axis=0)
                total[p, used] += sums
                count[p, used] += np.diff(np.append(begin, len(x)))
        p, e = np.nonzero(count)
        if len(p):
            flat = total[p, e].ravel().tolist()
            repeat = np.repeat(np.arange(len(p)), width)
            columns = [
                pa.array(p[repeat].astype(np.int32)),
                pa.array(e[repeat].astype(np.int32)),
                pa.array(np.tile(np.arange(width, dtype=np.int32), len(p))),
                pa.array(count[p, e][repeat]),
                pa.array(flat, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "place", "n", "total"])

    sums = rows.select("x").mapInArrow(run, "part int, entry int, place int, n long, total long")
    out = books.copy()
    for part, entry, place, n, total in sums.groupBy("part", "entry", "place").agg(F.sum("n"), F.sum(F.col("total").cast("decimal(38,0)"))).collect():
        out[part, entry, place] = int(total) // n
    return out


def encode(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
) -> Codes:
    """Codes of all rows with a finite vector.

    ``rows`` holds ``vec_id``, ``label``, ``code`` (entry of each part, two hex digits each), ``error``
    (squared distances summed over parts) and ``label_error`` (``error`` summed over the rows of the label,
    null labels together).

    Rows whose vector is null, or holds a null, NaN or infinite component, go. Codebooks start as the parts
    of the ``entries`` smallest ids, null ids last and as one; of an id with several vectors the least one
    counts. Fewer ids give smaller codebooks. Repeated rows count and are coded each. An empty table gives
    no rows and empty codebooks; empty vectors have entry 0 and no error. Vectors whose lengths differ, or
    are not a multiple of ``parts``, raise, as do errors beyond a long. Other columns are not read.
    """
    if not 0 < entries <= 62:
        raise ValueError("a codebook has 1 to 62 entries")
    spark = vectors.sparkSession
    folder = new_work_dir(spark, "vector-codes")
    integer_vectors(vectors, vec_id, vector, scale, label=label).write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    size = dimension(rows)
    if size is not None and size % parts:
        raise ValueError(f"vectors of {size} components cannot be cut into {parts} equal parts")
    first = seeds(rows, entries)
    books = np.array(first, np.int64).reshape(len(first), parts, (size or 0) // parts).transpose(1, 0, 2).copy()
    for _ in range(rounds if size else 0):
        books = refine(rows, books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = finders(books)
        for batch in row_slices(batches, slice_rows(books)):
            index, distance = assign(as_matrix(batch.column("x"), size), find)
            code = ["".join(f"{i:02x}" for i in row) for row in index.tolist()]
            error = [sum(row) for row in distance.tolist()]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(code), pa.array(error, pa.int64())], ["vec_id", "label", "code", "error"])

    kind = rows.schema["label"].dataType.simpleString()
    rows.select("vec_id", "label", "x").mapInArrow(run, f"vec_id long, label {kind}, code string, error long").write.parquet(f"{folder}/codes")
    coded = spark.read.parquet(f"{folder}/codes")
    coded.groupBy("label").agg(F.count("*").alias("n"), F.sum("error").alias("label_error")).write.parquet(f"{folder}/labels")
    return Codes(hub_join(coded, spark.read.parquet(f"{folder}/labels"), "label"), books)
