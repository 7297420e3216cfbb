"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Texts are sequences of normalised words; patterns are the benchmark's windows of ten words (a shorter
item is one pattern). For each pattern length a shift table, addressed by the hash of a block of two
words, tells how far the search may jump; where it says zero, the block's suffix bucket lists the
patterns to compare. Every document of a batch has its own cursor, and all cursors move together.

A small benchmark's patterns travel with the function. Those of a larger one are a table: the shift tables,
whose size is fixed, and a bit map of the windows choose the places of a text, and what stands there is
joined with the patterns by its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import new_work_dir
from .links import HUB_SHARE, hub_join
from .spans import BASE, SpanHash, gather, mix, rows_of, runs, string_bytes, text_slices, tidy

WORDS = 10
BLOCK = 2
TABLE_BITS = 18
#: Places of the bit map of a large benchmark's windows.
MAP_BITS = 27
#: Words that one cursor covers at most; longer texts get several.
STRETCH = 512
FOUND = T.StructType([T.StructField("n_words", T.LongType()), *(T.StructField(c, T.ArrayType(T.LongType())) for c in ("spans", "items"))])

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
#: Bytes of words after folding: digits, a-z and all of non-ASCII characters.
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(folded bytes, starts, ends) of all words; words never cross rows."""
    folded = _FOLD[data]
    start, end = runs(_WORD[folded], offsets)
    return folded, start, end


def slot(before: np.ndarray | int, last: np.ndarray) -> np.ndarray:
    """Place of a block in the tables."""
    return ((before * BASE + last) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def block_hash(words: np.ndarray, block: int) -> np.ndarray:
    """Slot of the block of one or two words that ends at each word."""
    before = np.zeros(len(words), np.uint64)
    if block == 2:
        before[1:] = words[:-1]
    return slot(before, words)


def stops(length: int, table: np.ndarray, slots: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Places of last words where the shift ``table`` says zero: those that the cursors do not jump over."""
    size = np.diff(first)
    stretches = np.maximum(-(-(size - length + 1) // STRETCH), 0)
    row = np.repeat(np.arange(len(size)), stretches)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(stretches) - stretches, stretches)
    at = first[row] + nth * STRETCH + length - 1
    stop = np.minimum(at + STRETCH, first[row + 1])
    shift = table[slots]
    found = [np.zeros(0, np.int64)]
    while len(at):
        jump = shift[at]
        found.append(at[jump == 0])
        at = at + np.maximum(jump, 1)
        alive = at < stop
        at, stop = at[alive], stop[alive]
    return np.concatenate(found)


class Patterns:
    """Patterns of one length: shift table, suffix buckets, and the words to compare."""

    def __init__(self, length: int, words: np.ndarray, spelled: list[bytes], items: list[tuple[int, ...]]):
        self.length, self.block = length, min(BLOCK, length)
        self.words, self.spelled, self.items = words.reshape(-1, length), spelled, items
        far = length - self.block + 1
        self.shift = np.full(1 << TABLE_BITS, far, np.int16)
        for end in range(self.block - 1, length):
            np.minimum.at(self.shift, self.slot(self.words[:, end - self.block + 1 : end + 1]), length - 1 - end)
        suffix = self.slot(self.words[:, length - self.block :])
        order = np.argsort(suffix, kind="stable")
        self.bucket = np.searchsorted(suffix[order], np.arange((1 << TABLE_BITS) + 1))
        self.order = order

    def slot(self, block: np.ndarray) -> np.ndarray:
        return slot(block[:, 0] if self.block == 2 else np.zeros(len(block), np.uint64), block[:, -1])

    def search(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the last word, pattern) of every candidate whose words' hashes are equal.

        ``first``: offsets of the rows in ``words``.
        """
        m = self.length
        slots = block_hash(words, self.block)
        place = stops(m, self.shift, slots, first)
        own = slots[place]
        held = self.bucket[own + 1] - self.bucket[own]
        pattern = self.order[gather(self.bucket[own], held)]
        place = np.repeat(place, held)
        for back in range(m - 1, -1, -1):  # word by word from the first: most candidates end at once
            same = words[place - back] == self.words[pattern, m - 1 - back]
            place, pattern = place[same], pattern[same]
        return place, pattern


def compile_patterns(items: list[tuple[int | None, str | None]], window: int = WORDS) -> list[Patterns]:
    """The patterns of a bounded list of items, grouped by length. Equal windows of several items are one pattern."""
    groups: dict[int, dict[bytes, tuple[np.ndarray, set[int]]]] = {}
    for item, text in items:
        if item is None or not text:
            continue
        raw = np.frombuffer(text.encode(), np.uint8)
        folded, start, end = words_of(raw, np.array([0, len(raw)]))
        if not len(start):
            continue
        hashes, flat = SpanHash(folded)(start, end), folded.tobytes()
        spelled = [flat[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)]
        length = min(window, len(spelled))
        for i in range(len(spelled) - length + 1):
            key = b" ".join(spelled[i : i + length])
            groups.setdefault(length, {}).setdefault(key, (hashes[i : i + length], set()))[1].add(item)
    return [
        Patterns(length, np.concatenate([h for h, _ in found.values()]), list(found), [tuple(sorted(ids)) for _, ids in found.values()])
        for length, found in sorted(groups.items())
    ]


def search(docs: DataFrame, patterns: list[Patterns]) -> DataFrame:
    """``doc_id, text_hash, n_words, spans`` (start, end, start, ... of the maximal runs of hit words) and
    ``items`` for each row of ``docs`` (``doc_id, text``, and ``row``, which is passed on); the bounded ``patterns`` travel with the function."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in text_slices(whole, "text"):
                data, offsets = string_bytes(part.column("text"))
                folded, start, end = words_of(data, offsets)
                words = SpanHash(folded)(start, end) if len(start) else np.zeros(0, np.uint64)
                first = np.searchsorted(start, offsets)
                cover = np.zeros(len(words) + 1, np.int64)
                flat = None
                items: dict[int, set[int]] = {}
                for group in patterns:
                    place, which = group.search(words, first)
                    flat = folded.tobytes() if flat is None and len(place) else flat
                    for p, w in zip(place.tolist(), which.tolist(), strict=True):
                        from_word = p - group.length + 1
                        # direct comparison confirms what the hashes found
                        if b" ".join(flat[a:b] for a, b in zip(start[from_word : p + 1], end[from_word : p + 1], strict=True)) == group.spelled[w]:
                            cover[from_word] += 1
                            cover[p + 1] -= 1
                            items.setdefault(int(np.searchsorted(first, p, "right")) - 1, set()).update(group.items[w])
                begin, stop = runs(np.cumsum(cover[:-1]) > 0, first[:-1])
                row = rows_of(begin, first) if len(begin) else begin
                spans: dict[int, list[int]] = {}
                for r, a, b in zip(row.tolist(), begin.tolist(), stop.tolist(), strict=True):
                    spans.setdefault(r, []).extend((a - int(first[r]), b - int(first[r])))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("text_hash"),
                        part.column("row"),
                        pa.array(np.diff(first), pa.int64()),
                        pa.array([spans.get(r, []) for r in range(part.num_rows)], pa.list_(pa.int64())),
                        pa.array([sorted(items.get(r, ())) for r in range(part.num_rows)], pa.list_(pa.int64())),
                    ],
                    ["doc_id", "text_hash", "row", "n_words", "spans", "items"],
                )

    read = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text", "row")
    return read.mapInArrow(tidy(run), T.StructType([*read.drop("text").schema, *FOUND]))


def covered(spans: Column) -> Column:
    """How many words a list of spans covers, overlaps once."""
    pairs = F.array_sort(F.transform(F.sequence(F.lit(0), F.shiftright(F.size(spans), 1) - 1), lambda i: F.struct(F.get(spans, 2 * i).alias("a"), F.get(spans, 2 * i + 1).alias("b"))))
    zero = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))
    step = lambda acc, x: F.struct(F.greatest(acc["end"], x["b"]).alias("end"), (acc["n"] + F.greatest(F.lit(0).cast("long"), x["b"] - F.greatest(acc["end"], x["a"]))).alias("n"))
    return F.when(F.size(spans) == 0, F.lit(0).cast("long")).otherwise(F.aggregate(pairs, zero, step, lambda acc: acc["n"]))


def hits(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WORDS, lot_bytes: int = 8_000_000
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_hit`` (words inside any occurrence of a pattern)
    and ``items`` (ascending ids of the benchmark items with an occurrence).

    A benchmark of up to ``lot_bytes`` of text, the bound of what is broadcast, takes one scan and no shuffle;
    a larger one two scans, whatever its size, and a join of the places that the tables leave (see
    ``search_table``). A null text has no words, an item without words or id no pattern; an empty
    benchmark finds nothing. Rows are searched one by one, so null and repeated ids change nothing.
    """
    read = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.lit(None).cast("int").alias("row"))
    return found_in(read, benchmark, item_id, item_text, window, lot_bytes).drop("row")


def keep_clean(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WORDS, lot_bytes: int = 8_000_000) -> DataFrame:
    """The rows of ``docs`` without a hit, all columns as they were."""
    read = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.struct("*").alias("row"))
    return found_in(read, benchmark, item_id, item_text, window, lot_bytes).where("n_hit = 0").select("row.*")


def found_in(read: DataFrame, benchmark: DataFrame, item_id: str, item_text: str, window: int, most_bytes: int) -> DataFrame:
    """``doc_id, row, n_words, n_hit, items`` of each row; see ``hits``."""
    items = benchmark.select(F.col(item_id).cast("long").alias("item"), F.col(item_text).alias("text")).where("item IS NOT NULL AND text <> ''")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size <= most_bytes:
        rows = search(read, compile_patterns([tuple(r) for r in items.collect()], window))  # most_bytes of text at most
    else:
        found = search_table(read, items, window)
        rows = search(read, []).drop("spans", "items").join(found, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")), "left")
        rows = rows.withColumns({c: F.coalesce(c, F.array().cast("array<long>")) for c in ("spans", "items")})
    return rows.select("doc_id", "row", "n_words", covered(F.col("spans")).alias("n_hit"), "items")


def window_hash(words: np.ndarray, last: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words that end at each place ``last``."""
    out = np.zeros(len(last), np.uint64)
    for back in range(length - 1, -1, -1):
        out = out * BASE + words[last - back]
    return mix(out + np.uint64(length))


def benchmark_windows(items: DataFrame, window: int) -> DataFrame:
    """``words`` (a window, joined by spaces), ``m`` (its length), ``place`` (of its hash in the bit map) and ``item`` of every window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in text_slices(whole, "text"):
                folded, start, end = words_of(*string_bytes(part.column("text")))
                if not len(start):
                    continue
                first = np.searchsorted(start, string_bytes(part.column("text"))[1])
                hashes, flat, ids = SpanHash(folded)(start, end), folded.tobytes(), part.column("item").to_pylist()
                size = np.diff(first)
                for m in np.unique(np.minimum(size[size > 0], window)).tolist():
                    rows = np.flatnonzero(np.minimum(size, window) == m)
                    n = size[rows] - m + 1
                    last = gather(first[rows] + m - 1, n)
                    place = window_hash(hashes, last, m) >> np.uint64(64 - MAP_BITS)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([spelled(flat, start, end, p, m) for p in last.tolist()], pa.binary()),
                            pa.array(np.full(len(last), m), pa.int32()),
                            pa.array(place.astype(np.int64)),
                            pa.array(np.repeat(np.array([ids[r] for r in rows], np.int64), n)),
                        ],
                        ["words", "m", "place", "item"],
                    )

    return items.mapInArrow(tidy(run), "words binary, m int, place long, item long")


def spelled(flat: bytes, start: np.ndarray, end: np.ndarray, last: int, length: int) -> bytes:
    """The ``length`` words that end at place ``last``, joined by spaces."""
    own = slice(last - length + 1, last + 1)
    return b" ".join([flat[a:b] for a, b in zip(start[own].tolist(), end[own].tolist(), strict=True)])


def shift_tables(patterns: DataFrame) -> dict[int, np.ndarray]:
    """The shift table of each pattern length of ``patterns`` (``words, m``); at most ten of 2**TABLE_BITS places reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("m").to_numpy()
            for m in np.unique(length).tolist():
                folded, start, end = words_of(*string_bytes(batch.column("words").filter(pa.array(length == m))))
                own = Patterns(m, SpanHash(folded)(start, end), [], [])
                used = np.flatnonzero(own.shift < m - own.block + 1)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), m), pa.int32()), pa.array(used, pa.int64()), pa.array(own.shift[used], pa.int16())], ["m", "slot", "shift"])

    least = patterns.select("words", "m").mapInArrow(tidy(run), "m int, slot long, shift short").groupBy("m", "slot").agg(F.min("shift").alias("shift")).toArrow()
    length, slots, shift = (least.column(c).to_numpy() for c in ("m", "slot", "shift"))
    tables = {m: np.full(1 << TABLE_BITS, m - min(BLOCK, m) + 1, np.int16) for m in np.unique(length).tolist()}
    for m, table in tables.items():
        table[slots[length == m]] = shift[length == m]
    return tables


def window_map(patterns: DataFrame) -> np.ndarray:
    """2**MAP_BITS bits, set at the ``place`` of every pattern: 16 MB, whatever the benchmark's size."""
    bit = F.col("place") + 1  # Spark numbers the bits from 1
    parts = patterns.groupBy(F.bitmap_bucket_number(bit).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")).collect()
    out = np.zeros((1 << MAP_BITS) // 8, np.uint8)
    for r in parts:
        own = np.frombuffer(r.bits, np.uint8)
        out[(r.part - 1) * len(own) : r.part * len(own)] = own
    return out


def search_table(docs: DataFrame, items: DataFrame, window: int) -> DataFrame:
    """``d, h`` (id and text hash), ``spans`` and ``items`` of the rows of ``docs`` with a hit, for a benchmark of any size.

    One scan of the documents writes the words at the places that the tables leave. They are joined with the
    patterns by these words themselves; a passage that stands in very many documents is joined where its rows are.
    """
    spark = docs.sparkSession
    folder = new_work_dir(spark, "decontamination")

    def write(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    windows = write(benchmark_windows(items, window).distinct(), "windows")
    patterns = windows.select("words", "m", "place").distinct()
    tables, bits = shift_tables(patterns), window_map(patterns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in text_slices(whole, "text"):
                data, offsets = string_bytes(part.column("text"))
                folded, start, end = words_of(data, offsets)
                if not len(start):
                    continue
                hashes, first, flat = SpanHash(folded)(start, end), np.searchsorted(start, offsets), None
                for m, table in tables.items():
                    last = stops(m, table, block_hash(hashes, min(BLOCK, m)), first)
                    place = window_hash(hashes, last, m) >> np.uint64(64 - MAP_BITS)
                    last = last[(bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1]
                    if not len(last):
                        continue
                    flat = folded.tobytes() if flat is None else flat
                    row = rows_of(last, first)
                    of_row = pa.array(row)
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("doc_id").take(of_row),
                            part.column("text_hash").take(of_row),
                            pa.array([spelled(flat, start, end, p, m) for p in last.tolist()], pa.binary()),
                            pa.array(last - m + 1 - first[row], pa.int64()),
                            pa.array(np.full(len(last), m), pa.int32()),
                        ],
                        ["d", "h", "words", "start", "m"],
                    )

    read = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    places = write(read.mapInArrow(tidy(run), "d long, h long, words binary, start long, m int"), "places")
    standing = write(places.groupBy("words").agg(F.count("*").alias("n")).join(patterns.select("words"), "words"), "standing")
    # how many parts a window's documents are dealt over where they meet its items
    parts = F.greatest(F.lit(1), F.ceil(F.col("n") / (F.lit(HUB_SHARE) * standing.agg(F.sum("n")).scalar()))).cast("int")
    standing = standing.withColumn("parts", parts)
    hit = write(hub_join(places, standing, "words"), "hits")
    spans = hit.select("d", "h", F.array("start", F.col("start") + F.col("m")).alias("span")).groupBy("d", "h").agg(F.flatten(F.collect_set("span")).alias("spans"))
    owners = windows.select("words", "item").join(standing, "words").select("words", "item", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    holders = hit.select("d", "h", "words", F.pmod(F.xxhash64("d", "h"), "parts").cast("int").alias("part")).distinct()
    found = holders.join(owners, ["words", "part"]).groupBy("d", "h").agg(F.array_sort(F.collect_set("item")).alias("items"))
    found = found.select(F.col("d").alias("d2"), F.col("h").alias("h2"), "items")
    return spans.join(found, F.col("d").eqNullSafe(F.col("d2")) & (F.col("h") == F.col("h2"))).drop("d2", "h2")


def items_digest(items: Column) -> Column:
    """SHA-256 of the item ids, sorted as strings and joined by commas."""
    return F.sha2(F.array_join(F.array_sort(F.transform(items, lambda i: i.cast("string"))), ",").cast("binary"), 256)


DECONTAMINATION_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words
  FROM documents
), b AS (
  SELECT row_number() OVER () AS n, item_id, words, least(10, len(words)) AS m FROM (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL) WHERE len(words) > 0
), bu AS (
  SELECT n, item_id, m, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM b
), bt AS (
  SELECT item_id, m, [word, lead(word, 1) OVER z, lead(word, 2) OVER z, lead(word, 3) OVER z, lead(word, 4) OVER z, lead(word, 5) OVER z,
    lead(word, 6) OVER z, lead(word, 7) OVER z, lead(word, 8) OVER z, lead(word, 9) OVER z] AS ten
  FROM bu WINDOW z AS (PARTITION BY n ORDER BY i)
), p AS (
  SELECT DISTINCT item_id, m, array_to_string(ten[1:m], ' ') AS g FROM bt WHERE ten[m] IS NOT NULL
), du AS (
  SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM d
), dt AS (
  SELECT r, i, [word, lead(word, 1) OVER z, lead(word, 2) OVER z, lead(word, 3) OVER z, lead(word, 4) OVER z, lead(word, 5) OVER z,
    lead(word, 6) OVER z, lead(word, 7) OVER z, lead(word, 8) OVER z, lead(word, 9) OVER z] AS ten
  FROM du WINDOW z AS (PARTITION BY r ORDER BY i)
), w AS (
  SELECT r, m, i, array_to_string(ten[1:m], ' ') AS g FROM dt, (SELECT DISTINCT m FROM p) WHERE ten[m] IS NOT NULL
), f AS (
  SELECT w.r, w.m, w.i, p.item_id FROM w JOIN p ON w.m = p.m AND w.g = p.g
), hit AS (
  SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(range(i, i + m)) AS q FROM (SELECT DISTINCT r, m, i FROM f)) GROUP BY r
), its AS (
  SELECT r, count(*) AS n, string_agg(s, ',' ORDER BY s) AS s FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM f) GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(its.n, 0) AS BIGINT) AS n_items,
  sha256(coalesce(its.s, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r)"""
