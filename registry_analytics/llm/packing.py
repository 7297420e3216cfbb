"""Sum-of-squares packing of tokenized documents into fixed-length sequences.

Each input partition packs its own documents, online and without a shuffle. A level array holds how
many open windows are filled to each level; a document goes to the level (or a new window) that makes
the sum of squared level counts smallest. A document of a window's length or more first fills whole
windows. When more than ``most_open`` windows are open, and at the end, the emptiest windows are cut
up to fill the fullest, so memory is bounded and a partition leaves at most one partial window; that
one is cut into powers of two, which need no padding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .spans import text_slices, tidy
from .tokens import END_ID, encode_slice, row_ids, with_end_ids

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"

#: (doc_id, start, ids, tokens of the document)
Piece = tuple[int | None, int, np.ndarray, int]


class LevelPacker:
    """Open windows by fill level; closed ones are handed out as lists of pieces."""

    def __init__(self, capacity: int, most_open: int):
        self.capacity, self.most_open = capacity, most_open
        self.counts = np.zeros(capacity + 1, np.int64)
        self.levels: list[list[list[Piece]]] = [[] for _ in range(capacity + 1)]
        self.open = 0

    def best_level(self, size: int) -> int:
        """The level whose windows take a piece of ``size`` at the least sum of squares; 0 is a new window."""
        before = self.counts[: self.capacity - size + 1]
        after = self.counts[size:]
        change = 2 * (after - before) + 2
        change[-1] = 1 - 2 * before[-1]  # a full window is closed and counts no more
        change[before == 0] = np.iinfo(np.int64).max
        change[0] = 2 * after[0] + 1
        return len(change) - 1 - int(np.argmin(change[::-1]))

    def put(self, level: int, window: list[Piece]) -> None:
        self.levels[level].append(window)
        self.counts[level] += 1
        self.open += 1

    def take(self, level: int) -> list[Piece]:
        self.counts[level] -= 1
        self.open -= 1
        return self.levels[level].pop()

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        doc, start, ids, total = piece
        whole = len(ids) // self.capacity * self.capacity
        for at in range(0, whole, self.capacity):
            yield [(doc, start + at, ids[at : at + self.capacity], total)]
        size = len(ids) - whole
        if size:
            level = self.best_level(size)
            window = [*(self.take(level) if level else ()), (doc, start + whole, ids[whole:].copy(), total)]
            if level + size == self.capacity:
                yield window
            else:
                self.put(level + size, window)
                if self.open > self.most_open:
                    yield from self.tighten(self.most_open // 2)

    def tighten(self, leave: int) -> Iterator[list[Piece]]:
        """Fill the fullest windows with pieces cut from the emptiest until ``leave`` are open."""
        while self.open > max(leave, 1):
            held = np.flatnonzero(self.counts)
            full, low = int(held[-1]), int(held[0])
            window, source = self.take(full), self.take(low)
            gap = self.capacity - full
            while gap and source:
                doc, start, ids, total = source.pop()
                if len(ids) > gap:
                    source.append((doc, start, ids[:-gap], total))
                    doc, start, ids = doc, start + len(ids) - gap, ids[-gap:]
                window.append((doc, start, ids, total))
                gap -= len(ids)
            if gap:
                self.put(self.capacity - gap, window)
            else:
                yield window
            if source:
                self.put(sum(len(p[2]) for p in source), source)

    def finish(self) -> Iterator[list[Piece]]:
        yield from self.tighten(1)
        for level in np.flatnonzero(self.counts).tolist():
            yield from powers_of_two(self.take(level))


def powers_of_two(window: list[Piece]) -> Iterator[list[Piece]]:
    """The pieces of one window, cut into sequences whose lengths are powers of two."""
    left = sum(len(p[2]) for p in window)
    pieces = window[::-1]
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        out = []
        while room:
            doc, start, ids, total = pieces.pop()
            if len(ids) > room:
                pieces.append((doc, start + room, ids[room:], total))
                ids = ids[:room]
            out.append((doc, start, ids, total))
            room -= len(ids)
        yield out


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = 2048, most_open: int = 512, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids`` (little-endian unsigned 32-bit), ``doc_tokens``
    (with the end id), ``sequence_id, offset``.

    A null or empty text is the end id alone. Null and repeated ids, ties and repeated rows are packed
    row by row. An empty table gives no pieces. Other columns of ``docs`` are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, rows = LevelPacker(capacity, most_open), []
        sequence = TaskContext.get().partitionId() << 40

        def write(windows: Iterator[list[Piece]]) -> None:
            nonlocal sequence
            for window in windows:
                at = 0
                for doc, start, ids, total in window:
                    rows.append((doc, start, len(ids), ids.astype("<u4").tobytes(), total, sequence, at))
                    at += len(ids)
                sequence += 1

        def batch() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
            rows.clear()
            return out

        for whole in batches:
            for part in text_slices(whole, "text"):
                ids, offsets = with_end_ids(*encode_slice(part.column("text"), tokenizer), end_id)
                for doc, own in zip(part.column("doc_id").to_pylist(), row_ids(ids, offsets), strict=True):
                    write(packer.add((doc, 0, own, len(own))))
                if rows:
                    yield batch()
        write(packer.finish())
        if rows:
            yield batch()

    read = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return read.mapInArrow(tidy(run), PIECES)
