"""Token files: documents as zstandard frames that share one dictionary, with an index for single documents.

A store is a folder with ``dictionary`` (one row: kind, hash, bytes) and ``blocks``, both Parquet tables, so
Spark's commit protocol makes lost executors harmless. A row of ``blocks`` holds one block in this
format, little-endian throughout::

    magic "TOKZ" | version u16 | bytes per id u16 | dictionary SHA-256, 32 bytes | documents u32
    doc ids i64[n] | 1 where the id is null u8[n] | tokens u32[n] | frame offsets u64[n + 1] | frames

Blocks are in ascending document order: by ``shard`` (a range of ids), then ``part``.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from .samples import lowest
from .spans import text_slices
from .tokens import END_ID, encode_slice, row_ids, with_end_ids

MAGIC, VERSION, HEAD = b"TOKZ", 1, "<4sHH32sI"
BLOCKS = "shard int, part int, n_docs long, n_tokens long, payload binary"
LEVEL = 3


class Block(NamedTuple):
    """A parsed block: its frames stay compressed until one is asked for."""

    doc_ids: np.ndarray
    null_ids: np.ndarray
    tokens: np.ndarray
    offsets: np.ndarray
    width: int
    frames: memoryview
    reader: zstandard.ZstdDecompressor

    def document(self, i: int) -> np.ndarray:
        """Ids of the block's i-th document, without touching the others."""
        raw = self.reader.decompress(self.frames[self.offsets[i] : self.offsets[i + 1]], max_output_size=int(self.tokens[i]) * self.width)
        return np.frombuffer(raw, f"<u{self.width}").astype("<u4")


def compression_dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if raw else None


def encode_block(doc_ids: list[int | None], rows: list[np.ndarray], dictionary: bytes, width: int, writer: zstandard.ZstdCompressor) -> bytes:
    frames = [writer.compress(ids.astype(f"<u{width}").tobytes()) for ids in rows]
    n = len(rows)
    head = struct.pack(HEAD, MAGIC, VERSION, width, hashlib.sha256(dictionary).digest(), n)
    index = [
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], "u1").tobytes(),
        np.array([len(ids) for ids in rows], "<u4").tobytes(),
        np.concatenate([[0], np.cumsum([len(f) for f in frames])]).astype("<u8").tobytes(),
    ]
    return b"".join([head, *index, *frames])


def open_block(payload: bytes, dictionary: bytes) -> Block:
    """Parse a block; a dictionary other than the one it was written with is refused."""
    magic, version, width, digest, n = struct.unpack_from(HEAD, payload)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a token block of this version")
    if digest != hashlib.sha256(dictionary).digest():
        raise ValueError("the block was written with another dictionary")
    at, arrays = struct.calcsize(HEAD), []
    for kind, count in (("<i8", n), ("u1", n), ("<u4", n), ("<u8", n + 1)):
        arrays.append(np.frombuffer(payload, kind, count, at))
        at += arrays[-1].nbytes
    shared = compression_dictionary(dictionary)
    reader = zstandard.ZstdDecompressor(dict_data=shared) if shared else zstandard.ZstdDecompressor()
    return Block(arrays[0], arrays[1].astype(bool), arrays[2], arrays[3].astype(np.int64), width, memoryview(payload)[at:], reader)


def id_width(tokenizer: str, end_id: int) -> int:
    """Bytes that an id needs: two where all of the tokenizer's ids and the end id fit, else four."""
    return 2 if max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1) <= 1 << 16 else 4


def fit_dictionary(docs: DataFrame, tokenizer: str, width: int, sample_docs: int = 1000, sample_chars: int = 16_384, size: int = 65_536) -> tuple[str, bytes]:
    """``(kind, dictionary)``, learned from at most ``sample_docs`` documents (those of the lowest id hash, and
    of each the first ``sample_chars`` characters).

    ``trained``: by zstandard's trainer. ``raw``: where the trainer finds too little in the samples, they are
    themselves the dictionary, as raw content. ``none``: there is no text to learn from.
    """
    chosen = lowest(docs.select(F.col("doc_id").alias("chosen")).where("chosen IS NOT NULL"), ("chosen",), sample_docs)
    # at most sample_docs rows of one long each: broadcasting them is bounded
    sample = docs.join(F.broadcast(chosen), docs["doc_id"] == chosen["chosen"]).select(F.substring("text", 1, sample_chars).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in text_slices(whole, "text"):
                rows = [ids.astype(f"<u{width}").tobytes() for ids in row_ids(*with_end_ids(*encode_slice(part.column("text"), tokenizer)))]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["ids"])

    samples = [bytes(r.ids) for r in sample.mapInArrow(run, "ids binary").orderBy(F.xxhash64("ids")).limit(sample_docs).collect()]
    raw = b"".join(samples)[-size:]
    if len(raw) < 8:  # zstandard takes no shorter dictionary
        return "none", b""
    samples = [s for s in samples if len(s) >= 16]
    try:
        return "trained", zstandard.train_dictionary(min(size, sum(map(len, samples)) // 8), samples).as_bytes()
    except zstandard.ZstdError:  # how the trainer says that it needs more samples
        return "raw", raw


def write_store(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, block_bytes: int = 4_000_000, doc_id: str = "doc_id", text: str = "text"
) -> None:
    """Tokenize whole texts, append ``end_id`` to each and write the store, documents in ascending id order.

    A null text is empty. Null ids come first; rows with the same id are ordered by their text's hash.
    An empty table gives a store without blocks. Other columns are not read. The ``dictionary`` table
    says how the dictionary was made (``kind``, see ``fit_dictionary``).
    """
    spark, width = docs.sparkSession, id_width(tokenizer, end_id)
    read = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    kind, dictionary = fit_dictionary(read, tokenizer, width)
    spark.createDataFrame([(kind, hashlib.sha256(dictionary).hexdigest(), bytearray(dictionary))], "kind string, hash string, bytes binary").coalesce(1).write.parquet(f"{folder}/dictionary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = compression_dictionary(dictionary)
        writer = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared) if shared else zstandard.ZstdCompressor(level=LEVEL)
        shard, part = TaskContext.get().partitionId(), 0
        held_ids: list[int | None] = []
        held: list[np.ndarray] = []

        def block() -> pa.RecordBatch:
            nonlocal part
            payload = encode_block(held_ids, held, dictionary, width, writer)
            row = [[shard], [part], [len(held)], [sum(map(len, held))], [payload]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            part += 1
            held_ids.clear()
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], ["shard", "part", "n_docs", "n_tokens", "payload"])

        size = 0
        for whole in batches:
            for piece in text_slices(whole, "text"):
                ids, offsets = with_end_ids(*encode_slice(piece.column("text"), tokenizer), end_id)
                for doc, own in zip(piece.column("doc_id").to_pylist(), row_ids(ids, offsets), strict=True):
                    held_ids.append(doc)
                    held.append(own.astype(np.uint32))
                    size += own.nbytes
                    if size >= block_bytes:
                        yield block()
                        size = 0
        if held:
            yield block()

    # the range exchange samples only a scan: tokens are made after it, once
    in_order = read.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    in_order.mapInArrow(run, BLOCKS).write.option("compression", "uncompressed").parquet(f"{folder}/blocks")


def read_dictionary(spark: SparkSession, folder: str) -> bytes:
    """The store's dictionary (one row of bounded size)."""
    return bytes(spark.read.parquet(f"{folder}/dictionary").first()["bytes"])


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of a store: ``doc_id``, its block (``shard, part``), ``before`` (ids before it in the block),
    ``n_tokens`` and ``ids`` (binary, unsigned 32-bit)."""
    dictionary = read_dictionary(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for shard, part, payload in zip(*(whole.column(c) for c in ("shard", "part", "payload")), strict=True):
                block = open_block(payload.as_buffer().to_pybytes(), dictionary)
                before = np.cumsum(block.tokens.astype(np.int64)) - block.tokens
                for at in range(0, len(block.tokens), 512):
                    here = slice(at, min(at + 512, len(block.tokens)))
                    n = here.stop - here.start
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(block.doc_ids[here], pa.int64(), mask=block.null_ids[here]),
                            pa.array(np.full(n, shard.as_py()), pa.int32()),
                            pa.array(np.full(n, part.as_py()), pa.int32()),
                            pa.array(before[here], pa.int64()),
                            pa.array(block.tokens[here].astype(np.int64), pa.int64()),
                            pa.array([block.document(i).tobytes() for i in range(here.start, here.stop)], pa.binary()),
                        ],
                        ["doc_id", "shard", "part", "before", "n_tokens", "ids"],
                    )

    return spark.read.parquet(f"{folder}/blocks").select("shard", "part", "payload").mapInArrow(run, "doc_id long, shard int, part int, before long, n_tokens long, ids binary")


def with_starts(rows: DataFrame, folder: str) -> DataFrame:
    """Replace ``shard, part, before`` of rows of ``documents`` by ``start``, the ids of all documents before.

    Blocks are summed by shard first, so the one ordered window has a row per shard. Rows are best
    narrowed before: the join may shuffle them.
    """
    blocks = rows.sparkSession.read.parquet(f"{folder}/blocks").select("shard", "part", "n_tokens")
    shards = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("tokens"))
    shards = shards.select("shard", (F.sum("tokens").over(Window.orderBy("shard")) - F.col("tokens")).alias("shard_start"))
    parts = blocks.select("shard", "part", (F.sum("n_tokens").over(Window.partitionBy("shard").orderBy("part")) - F.col("n_tokens")).alias("part_start"))
    starts = parts.join(shards, "shard").select("shard", "part", (F.col("shard_start") + F.col("part_start")).alias("block_start"))
    return rows.join(starts, ["shard", "part"]).withColumn("start", F.col("block_start") + F.col("before")).drop("shard", "part", "before", "block_start")


def fetch(spark: SparkSession, folder: str, doc_ids: list[int]) -> DataFrame:
    """The documents of a short list: each block's index is searched, and only the listed frames are decompressed."""
    dictionary = read_dictionary(spark, folder)
    wanted = np.array(sorted(set(doc_ids)), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for payload in whole.column("payload"):
                block = open_block(payload.as_buffer().to_pybytes(), dictionary)
                found = np.flatnonzero(np.isin(block.doc_ids, wanted) & ~block.null_ids).tolist()
                yield pa.RecordBatch.from_arrays([pa.array(block.doc_ids[found], pa.int64()), pa.array([block.document(i).tobytes() for i in found], pa.binary())], ["doc_id", "ids"])

    return spark.read.parquet(f"{folder}/blocks").select("payload").mapInArrow(run, "doc_id long, ids binary")
