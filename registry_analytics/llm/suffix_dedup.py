"""Removal of repeated byte strings by blockwise suffix sorting with difference-cover ranks.

A byte goes if a string of ``length`` bytes that covers it also starts in a document with a smaller id.
Suffixes are dealt into buckets by the minimiser of their first ``length`` bytes (the lowest hash of the
``seed`` byte strings in it), so equal strings meet in one bucket. Neighbouring suffixes with the same
minimiser travel as one record of overlapping text. Each bucket is sorted alone:

1. by the first 8 and 13 bytes; suffixes without an equal are dropped on the way;
2. long ties by the ranks of a difference-cover sample of the bucket's text: {0, 1, 3, 9} modulo 13 has
   for any two suffixes an offset at which both meet a sample, whose ranks over 52 bytes are computed
   before by doubling (13, 26, 52).

Neighbours in that order that agree on ``length`` bytes form a group; its smallest document keeps its own.

Within a task, records with equal text are sent once, for their smallest document: those of larger ones are
known to repeat, and the smallest document's further places travel as numbers beside the text. So a passage
that a third of all documents share costs a bucket one record per task. Records at the edge of such a passage
hold their documents' own text too: those of a crowded minimiser are split into single suffixes, which are
merged likewise and dealt by a hash of their ``length`` bytes.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from .spans import SpanHash, gather, mix, rows_of, string_bytes, text_slices, tidy, worker_cache

#: The difference cover of period 13: each difference modulo 13 occurs once.
PERIOD, COVER = 13, (0, 1, 3, 9)
SEED = 12
MULTIPLIER = np.uint64(0x94D049BB133111EB)
NO_ID = np.iinfo(np.int64).max
RECORDS = "bucket int, payload binary"
SPANS = "part int, payload binary"
#: Places of the map of crowded minimisers: 8 MB.
MAP_BITS = 26


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, in a logarithmic number of passes."""
    out, done = values, 1
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[:-step], out[step:])
        done += step
    return out


def records(spans: SpanHash, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first suffix, last suffix, minimiser's place, its hash) of the maximal runs of suffixes that share a minimiser."""
    n = len(spans.sums) - 1
    seeds = (spans.sums[SEED:] - spans.sums[: n - SEED + 1]) * spans.down[: n - SEED + 1]
    seeds ^= seeds >> np.uint64(29)
    seeds *= MULTIPLIER
    # high bits order the seeds, low bits hold the place: ties go to the first
    keyed = (seeds & ~np.uint64(0xFFFFFF)) | np.arange(n - SEED + 1, dtype=np.uint64)
    lowest = sliding_min(keyed, length - SEED + 1)  # of the suffix that starts at each place
    start = offsets[:-1]
    last = offsets[1:] - length
    own = last >= start
    edge = np.zeros(n + 2, np.int8)
    edge[start[own]] += 1
    edge[last[own] + 1] -= 1
    valid = np.cumsum(edge, dtype=np.int8)[: len(lowest)] > 0
    place = lowest & np.uint64(0xFFFFFF)
    new = np.ones(len(lowest), bool)
    new[1:] = (place[1:] != place[:-1]) | ~valid[:-1]
    new[start[own]] = True
    first = np.flatnonzero(new & valid)
    close = np.ones(len(lowest), bool)
    close[:-1] = new[1:] | ~valid[1:]
    end = np.flatnonzero(close & valid)
    seed = place[first].astype(np.int64)
    return first, end, seed, seeds[seed]


def key_bytes(text: np.ndarray, at: np.ndarray, skip: int, n: int) -> np.ndarray:
    """``n`` (1 to 8) bytes from ``at + skip`` as a big-endian number; eight bytes from there must lie in ``text``, which is padded."""
    eights = np.ndarray((max(len(text) - 7, 0),), ">u8", text, strides=(1,))  # the eight bytes from every place
    return eights[at + skip].astype(np.uint64) >> np.uint64(64 - 8 * n)


def dense(key: np.ndarray) -> np.ndarray:
    """Ranks from 1; equal keys have equal ranks."""
    order = np.argsort(key)
    ranks = np.empty(len(key), np.uint64)
    ranks[order] = np.cumsum(np.append(1, key[order][1:] != key[order][:-1])).astype(np.uint64)
    return ranks


def cover_ranks(text: np.ndarray) -> np.ndarray:
    """Rank of the 52 bytes from each sample place of ``text`` (the padding's zero bytes beyond its end); 0 elsewhere."""
    whole = np.arange(0, len(text) - 4 * PERIOD, PERIOD)
    sample = (whole[:, None] + np.array(COVER)).ravel()
    ranks = np.zeros(len(text) + 4 * PERIOD, np.uint64)
    ranks[sample] = dense(key_bytes(text, sample, 0, 8))
    ranks[sample] = dense((ranks[sample] << np.uint64(40)) | key_bytes(text, sample, 8, PERIOD - 8))
    for step in (PERIOD, 2 * PERIOD):
        ranks[sample] = dense((ranks[sample] << np.uint64(32)) | ranks[sample + step])
    return ranks.astype(np.int64)


def meeting_offsets() -> np.ndarray:
    """For residues a and b, the smallest offset that brings both into the cover."""
    held = set(COVER)
    return np.array([[next(d for d in range(PERIOD) if (a + d) % PERIOD in held and (b + d) % PERIOD in held) for b in range(PERIOD)] for a in range(PERIOD)])


def drop_single(group: np.ndarray) -> np.ndarray:
    """Where a sorted group number occurs more than once."""
    same = np.zeros(len(group) + 1, bool)
    same[1:-1] = group[1:] == group[:-1]
    return same[1:] | same[:-1]


def sort_ties(at: np.ndarray, group: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Order of suffixes whose groups (sorted numbers) agree on 13 bytes, by the cover's ranks.

    A three-way quicksort of all groups at once: each round, every open group is split by a pivot.
    """
    meet = meeting_offsets()
    at, group = at.copy(), group.astype(np.int64)
    final = np.zeros(len(at), np.int64)
    index = np.arange(len(at))
    # places of a group are consecutive and stay its own: a split only reorders inside them
    place = np.arange(len(at))
    while len(index):
        new = np.ones(len(group), bool)
        new[1:] = group[1:] != group[:-1]
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(group)))
        pivot = np.repeat(at[begin + size // 2], size)
        offset = meet[at % PERIOD, pivot % PERIOD]
        mine, other = ranks[at + offset], ranks[pivot + offset]
        side = np.sign(mine - other) + 1
        order = np.lexsort((side, group))
        at, index, group, side = at[order], index[order], group[order], side[order]
        final[place] = index
        group = group * 3 + side
        # '=' parts are in order already
        open_ = (side != 1) & drop_single(group)
        at, index, group, place = at[open_], index[open_], group[open_], place[open_]
        if len(group):
            fresh = np.zeros(len(group), np.int64)
            fresh[1:] = group[1:] != group[:-1]
            group = np.cumsum(fresh)
    return final


def repeated(text: np.ndarray, at: np.ndarray, docs: np.ndarray, length: int) -> np.ndarray:
    """Which suffixes (places ``at`` in ``text``, of documents ``docs``) share ``length`` bytes with a smaller document.

    ``text`` has at least 52 + 13 bytes of padding. Suffixes are sorted block by block of first bytes in
    one go by number keys; only those that tie on 13 bytes need the cover.
    """
    out = np.zeros(len(at), bool)
    if len(at) < 2:
        return out
    key = key_bytes(text, at, 0, 8)
    order = np.argsort(key, kind="stable")
    keep = drop_single(key[order])
    order = order[keep]
    if not len(order):
        return out
    group = np.cumsum(np.append(0, key[order][1:] != key[order][:-1]))
    more = key_bytes(text, at[order], 8, PERIOD - 8)
    both = (group.astype(np.uint64) << np.uint64(40)) | more
    again = np.argsort(both, kind="stable")
    order, both = order[again], both[again]
    keep = drop_single(both)
    order, both = order[keep], both[keep]
    if not len(order):
        return out
    group = np.cumsum(np.append(0, both[1:] != both[:-1]))
    order = order[sort_ties(at[order], group, cover_ranks(text))]
    place = at[order]
    same = np.zeros(len(order) + 1, bool)
    rows = np.lib.stride_tricks.sliding_window_view(text, length)
    for a in range(0, len(order) - 1, 100_000):
        b = min(a + 100_000, len(order) - 1)
        same[a + 1 : b + 1] = (rows[place[a:b]] == rows[place[a + 1 : b + 1]]).all(axis=1)
    begin = np.flatnonzero(~same[:-1])
    size = np.diff(np.append(begin, len(order)))
    smallest = np.repeat(np.minimum.reduceat(docs[order], begin), size)
    out[order] = smallest < docs[order]
    return out


class SpanLists:
    """Removed spans (row key, start, end), dealt to the parts that assemble the texts."""

    def __init__(self, parts: int):
        self.parts, self.held, self.size = parts, [], 0

    def add(self, key: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        if len(key):
            self.held.append((key, start, end))
            self.size += len(key)

    def batches(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        key, start, end = (np.concatenate(x) for x in zip(*self.held, strict=True))
        self.held, self.size = [], 0
        part = (key % np.uint64(self.parts)).astype(np.int64)
        order = np.lexsort((start, key, part))
        part = part[order]
        table = np.stack([key[order].view(np.int64), start[order].astype(np.int64), end[order].astype(np.int64)])
        cut = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(part))
        pack = zstandard.ZstdCompressor(level=1)
        payload = [pack.compress(np.ascontiguousarray(table[:, a:b]).tobytes()) for a, b in zip(cut[:-1], cut[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(part[cut[:-1]].astype(np.int32)), pa.array(payload, pa.binary())], ["part", "payload"])


def merged(key: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans in order of key and start, with those that touch or overlap made one."""
    if not len(key):
        return key, start, end
    order = np.lexsort((start, key))
    key, start, end = key[order], start[order], end[order]
    group = np.cumsum(np.append(0, key[1:] != key[:-1]))
    wide = int(end.max()) + 1  # running maximum per key: lift each key above the one before
    reach = np.maximum.accumulate(end + group * wide) - group * wide
    new = np.append(True, (key[1:] != key[:-1]) | (start[1:] > reach[:-1]))
    first = np.flatnonzero(new)
    return key[first], start[first], reach[np.append(first[1:], len(key)) - 1]


PAYLOAD = "<qqq"  # records, further places, bytes of text


def pack_records(
    data: np.ndarray, first: np.ndarray, last: np.ndarray, seed: np.ndarray, doc: np.ndarray, tag: np.ndarray, base: np.ndarray, length: int, more: tuple[np.ndarray, np.ndarray, np.ndarray]
) -> bytes:
    """Text and owners of records: suffix counts and minimisers' places u16, differences of document ids i64, text tags u24, starts in the row u32 (both by planes of bytes), ``more``, text.

    ``more`` is (record, tag, start in the row) of further places of the records' texts in their documents, in order of the records.
    """
    size = last - first + length
    text = data[gather(first, size)]
    head = struct.pack(PAYLOAD, len(first), len(more[0]), len(text))
    places = [planes(np.diff(more[0], prepend=0), 4), planes(more[1], 3), planes(more[2], 4)]
    raw = b"".join([head, (last - first + 1).astype("<u2").tobytes(), (seed - first).astype("<u2").tobytes(), np.diff(doc, prepend=0).astype("<i8").tobytes(), planes(tag, 3), planes(first - base, 4), *places, text.tobytes()])
    return zstandard.ZstdCompressor(level=5).compress(raw)


def planes(values: np.ndarray, n: int) -> bytes:
    """The lowest ``n`` bytes of numbers, first all lowest bytes: planes compress better than rows."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :n].T).tobytes()


def numbers(raw: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((len(raw) // n, 4), np.uint8)
    out[:, :n] = raw.reshape(n, -1).T
    return out.view("<u4").ravel()


def unpack_records(payload: bytes) -> tuple[np.ndarray, ...]:
    raw = zstandard.ZstdDecompressor().decompress(payload)
    n, m, size = struct.unpack_from(PAYLOAD, raw)
    at, out = struct.calcsize(PAYLOAD), []
    for kind, count in (("<u2", n), ("<u2", n), ("<i8", n), ("u1", 3 * n), ("u1", 4 * n), ("u1", 4 * m), ("u1", 3 * m), ("u1", 4 * m), ("u1", size)):
        out.append(np.frombuffer(raw, kind, count, at))
        at += out[-1].nbytes
    out[2], out[3], out[4] = np.cumsum(out[2]), numbers(out[3], 3), numbers(out[4], 4)
    out[5], out[6], out[7] = np.cumsum(numbers(out[5], 4), dtype=np.int64), numbers(out[6], 3), numbers(out[7], 4)
    return tuple(out)


def shared(hashes: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Which rows have a hash that rows of another document have too."""
    order = np.lexsort((docs, hashes))
    h, d = hashes[order], docs[order]
    begin = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    end = np.append(begin[1:], len(h)) - 1
    out = np.zeros(len(h), bool)
    out[order] = np.repeat(d[begin] != d[end], end - begin + 1)
    return out


def candidates(text: np.ndarray, begin: np.ndarray, size: np.ndarray, seed: np.ndarray, docs: np.ndarray, length: int) -> np.ndarray:
    """Records that may hold a repeat: ``length`` equal bytes around a minimiser agree on half of the rest before or after it."""
    side = (length - SEED) // 2
    text = np.concatenate([text, np.zeros(8, np.uint8)])
    out = np.zeros(len(begin), bool)
    for a, b in ((seed, seed + SEED + side), (seed - side, seed + SEED)):
        held = np.flatnonzero((a >= 0) & (b <= size))
        if len(held):
            hashes = np.zeros(len(held), np.uint64)
            for skip in range(0, SEED + side, 8):
                hashes = mix(hashes + key_bytes(text, begin[held] + a[held], skip, min(8, SEED + side - skip)))
            out[held] |= shared(hashes, docs[held])
    return out


def bucket_spans(payloads: list[bytes], length: int, spans: SpanLists) -> None:
    """Sort the suffixes of one bucket and add the spans that repeat."""
    parts = list(map(unpack_records, payloads))
    shift = np.cumsum([0, *(len(x[0]) for x in parts[:-1])])
    twin = np.concatenate([x[5] + k for x, k in zip(parts, shift, strict=True)])
    count, seed, doc, tag, start, _, twin_tag, twin_start, text = (np.concatenate(x) for x in zip(*parts, strict=True))
    del parts
    twin_key, twin_start = row_keys(doc[twin], twin_tag), twin_start.astype(np.int64)
    count = count.astype(np.int64)
    size = count + length - 1
    begin = np.cumsum(size) - size
    held = np.flatnonzero(candidates(text, begin, size, seed.astype(np.int64), doc, length))
    if not len(held):
        return
    text = np.concatenate([text[gather(begin[held], size[held])], np.zeros(6 * PERIOD, np.uint8)])
    count, size, doc, key, start = count[held], size[held], doc[held], row_keys(doc[held], tag[held]), start[held].astype(np.int64)
    begin = np.cumsum(size) - size
    at = gather(begin, count)
    row = np.repeat(np.arange(len(count)), count)
    found = np.flatnonzero(repeated(text, at, doc[row], length))
    if not len(found):
        return
    row, at = row[found], at[found]
    new = np.append(True, (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1))
    a = np.flatnonzero(new)
    b = np.append(a[1:], len(at)) - 1
    own = row[a]
    since, until = at[a] - begin[own], at[b] - begin[own] + length
    spans.add(key[own], start[own] + since, start[own] + until)
    low = np.searchsorted(twin, held[own], "left")
    size = np.searchsorted(twin, held[own], "right") - low
    also = gather(low, size)
    since, until = np.repeat(since, size), np.repeat(until, size)
    spans.add(*merged(twin_key[also], twin_start[also] + since, twin_start[also] + until))


def row_keys(doc: np.ndarray, tag: np.ndarray) -> np.ndarray:
    """One number for an id and a 24-bit tag of the text: rows with the same id and text share it, and their result."""
    return mix(mix(doc.view(np.uint64)) + tag.astype(np.uint64))


def ids_and_tags(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False), batch.column("tag").to_numpy(zero_copy_only=False).astype(np.uint32)


def pieces(batch: pa.RecordBatch, length: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, offsets, start of each row in them, ids, tags) of row slices; a text of over ``most`` bytes comes in pieces that overlap by ``length - 1`` bytes, so each suffix is in one.

    The start of a row whose first bytes came in earlier pieces is negative.
    """
    for part in text_slices(batch, "text", most):
        data, offsets = string_bytes(part.column("text"))
        ids, tags = ids_and_tags(part)
        if part.num_rows > 1 or len(data) <= most:
            yield data, offsets, offsets[:-1], ids, tags
            continue
        for at in range(0, len(data) - length + 1, most - length + 1):
            cut = data[at : at + most]
            yield cut, np.array([0, len(cut)]), np.array([-at]), ids, tags


def crowded_map(rows: DataFrame, length: int, crowd: int, piece: int = 1_000_000, flush: int = 16_000_000, weight: int = 32) -> tuple[np.ndarray, int]:
    """Bits of 2**MAP_BITS places, set where a minimiser's hash falls that about ``crowd`` or more records have, equal
    texts within ``flush`` bytes counted once; and the bytes of all texts. Without such a minimiser the map is empty.

    A count under ``weight`` of one flush is handed on as ``weight`` with a chance in proportion, so sums are
    right on average. The map only chooses how records are dealt, and so may a place that two minimisers share:
    no result depends on it. Its size does not grow with the input.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("suffix_dedup")
        held: list[tuple] = []
        size = total = 0

        def counts() -> pa.RecordBatch:
            seed, content = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            content, once = np.unique(content, return_index=True)  # equal texts have the same minimiser
            seeds, n = np.unique(seed[once], return_counts=True)
            chance = mix(seeds + content[0]) % np.uint64(weight)
            keep = chance < n.astype(np.uint64)
            return pa.RecordBatch.from_arrays([pa.array(mix(seeds[keep]).view(np.int64)), pa.array(np.maximum(n[keep], weight).astype(np.int64))], ["seed", "n"])

        for whole in batches:
            for data, offsets, _, _, _ in pieces(whole, length, piece):
                total += len(data)
                if len(data) < length:
                    continue
                hashes = SpanHash(data)
                first, last, _, seed = records(hashes, offsets, length)
                if not len(first):
                    continue
                held.append((seed, hashes(first, last + length)))
                size += len(data)
                if size >= flush:
                    yield counts()
                    size = 0
        if held:
            yield counts()
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([total], pa.int64())], ["seed", "n"])

    found = rows.mapInArrow(tidy(run), "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n")).where((F.col("n") >= crowd) | F.col("seed").isNull())
    place = F.col("seed").bitwiseAND((1 << MAP_BITS) - 1) + 1  # Spark numbers the bits from 1
    found = found.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"), F.max(F.when(F.col("seed").isNull(), F.col("n"))).alias("bytes"))
    parts = found.collect()  # of 4 KB each, 2**MAP_BITS bits at most, and one of the bytes
    total = sum(r.bytes or 0 for r in parts)
    if all(r.part is None for r in parts):
        return np.zeros(0, np.uint8), total
    table = np.zeros((1 << MAP_BITS) // 8, np.uint8)
    for r in parts:
        if r.part is not None:
            own = np.frombuffer(r.bits, np.uint8)
            table[(r.part - 1) * len(own) : r.part * len(own)] = own
    return table, total


def split_crowded(crowded: np.ndarray, first: np.ndarray, last: np.ndarray, place: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, ...]:
    """The records, those of crowded minimisers as one record for each suffix; and which these are."""
    if not len(crowded):
        return first, last, place, seed, np.zeros(len(first), bool)
    bit = mix(seed) & np.uint64((1 << MAP_BITS) - 1)
    full = (crowded[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
    n = np.where(full, last - first + 1, 1)
    start = gather(first, n)
    full = np.repeat(full, n)
    return start, np.where(full, start, np.repeat(last, n)), np.repeat(place, n), np.repeat(seed, n), full


def deal_records(rows: DataFrame, length: int, buckets: int, parts: int, crowd: int = 10_000, flush: int = 16_000_000, piece: int = 1_000_000, crowded: np.ndarray | None = None) -> DataFrame:
    """Compressed records of ``rows`` (``tag, doc_id, text``) by bucket, and under -1 - part what is known to repeat; ``piece`` is under 16 MiB, ``crowded`` the map for ``crowd``, if there is one."""
    if crowded is None:
        crowded = crowded_map(rows, length, crowd, piece, flush)[0]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("suffix_dedup")
        spans = SpanLists(parts)
        held: list[tuple] = []
        size = 0

        def send() -> Iterator[pa.RecordBatch]:
            """Deal out what is held: equal texts once, for their smallest document, with all its places."""
            nonlocal size
            data = np.concatenate([h[0] for h in held])
            shift = np.cumsum([0, *(len(h[0]) for h in held[:-1])])
            first, last, place, base = (np.concatenate([h[i] + s for h, s in zip(held, shift, strict=True)]) for i in (1, 2, 3, 6))
            deal_by, content, doc, tag = (np.concatenate([h[i] for h in held]) for i in (4, 5, 7, 8))
            held.clear()
            size = 0
            order = np.lexsort((doc, content))
            new = np.append(True, content[order][1:] != content[order][:-1])
            head = order[np.flatnonzero(new)]
            owner = head[np.cumsum(new) - 1]
            twins = np.flatnonzero(~new & (doc[order] == doc[owner]))
            twin, twin_of = order[twins], owner[twins]
            later = np.flatnonzero(~new & (doc[order] > doc[owner]))
            again = order[later]
            spans.add(row_keys(doc[again], tag[again]), first[again] - base[again], last[again] + length - base[again])
            bucket = (deal_by[head] >> np.uint64(20)) % np.uint64(buckets)
            by = np.argsort(bucket, kind="stable")
            head, bucket = head[by], bucket[by]
            by = np.argsort(twin_of, kind="stable")
            twin, twin_of = twin[by], twin_of[by]
            cut = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(head))
            for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                own = np.sort(head[a:b])  # in order of rows: ids and tags repeat or rise
                low = np.searchsorted(twin_of, own, "left")
                size_of = np.searchsorted(twin_of, own, "right") - low
                also = twin[gather(low, size_of)]
                more = (np.repeat(np.arange(len(own)), size_of), tag[also], first[also] - base[also])
                payload = pack_records(data, first[own], last[own], place[own], doc[own], tag[own], base[own], length, more)
                yield pa.RecordBatch.from_arrays([pa.array([int(bucket[a])], pa.int32()), pa.array([payload], pa.binary())], ["bucket", "payload"])
            for batch in spans.batches():  # in the same shape, told apart by a negative bucket
                yield pa.RecordBatch.from_arrays([pa.array(-1 - batch.column("part").to_numpy(), pa.int32()), batch.column("payload")], ["bucket", "payload"])

        for whole in batches:
            for data, offsets, base, ids, tags in pieces(whole, length, piece):
                if len(data) < length:
                    continue
                hashes = SpanHash(data)
                first, last, place, seed = records(hashes, offsets, length)
                if not len(first):
                    continue
                first, last, place, seed, full = split_crowded(crowded, first, last, place, seed)
                row, content = rows_of(first, offsets), hashes(first, last + length)
                held.append((data, first, last, place, np.where(full, content, seed), content, base[row], ids[row], tags[row]))
                size += len(data)
                if size >= flush:
                    yield from send()
        if held:
            yield from send()

    return rows.mapInArrow(tidy(deal), RECORDS)


def find_spans(rows: DataFrame, length: int, buckets: int, parts: int, crowded: np.ndarray, piece: int) -> DataFrame:
    """Removed spans of ``rows`` (``tag, doc_id, text``) as compressed lists by part."""

    def sort(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Buckets arrive one after another; each is sorted when it is complete."""
        spans = SpanLists(parts)
        now, payloads = None, []
        for batch in frames:
            for bucket, payload in zip(batch.column("bucket").to_pylist(), batch.column("payload").to_pylist(), strict=True):
                if bucket < 0:
                    yield pa.RecordBatch.from_arrays([pa.array([-1 - bucket], pa.int32()), pa.array([payload], pa.binary())], ["part", "payload"])
                    continue
                if bucket != now:
                    if payloads:
                        bucket_spans(payloads, length, spans)
                    now, payloads = bucket, []
                payloads.append(payload)
            if spans.size > 500_000:
                yield from spans.batches()
        if payloads:
            bucket_spans(payloads, length, spans)
        yield from spans.batches()

    dealt = deal_records(rows, length, buckets, parts, crowded=crowded, piece=piece)
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return dealt.repartition(tasks, "bucket").sortWithinPartitions("bucket").mapInArrow(tidy(sort), SPANS)


def remove_repeats(
    docs: DataFrame, length: int = 50, doc_id: str = "doc_id", text: str = "text", bucket_bytes: int = 6_000_000, part_bytes: int = 24_000_000, piece: int = 1_000_000, crowd: int = 10_000, carry: tuple[str, ...] = (), decode: bool = False
) -> DataFrame:
    """One row per distinct row of (id, text) of ``docs`` times its copies: ``doc_id, n_bytes, n_removed,
    n_spans`` (maximal removed runs), ``kept`` (the remaining bytes, in order) and ``row``, a struct of the
    columns named in ``carry``. With ``decode``, ``kept`` is a string without the bytes of characters cut in two.

    A null text is empty; a text under ``length`` bytes keeps all. A null id is larger than every id and
    its documents lose to any other, but not to each other. Rows with the same id never remove from each
    other; repeated rows have the same result each. An empty table gives no rows; other columns are not read.
    """
    row = F.struct(*carry) if carry else F.lit(None).cast("int")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), row.alias("row"))
    rows = rows.select(F.xxhash64("text").bitwiseAND(0xFFFFFF).alias("tag"), "doc_id", "text", "row")
    crowded, total = crowded_map(rows.drop("row"), length, crowd, piece)
    buckets = max(64, -(-total // bucket_bytes) * 2)  # records overlap: a bucket holds about 1.8 times as many bytes
    parts = max(16, -(-total // part_bytes))
    spans = find_spans(rows.drop("row"), length, buckets, parts, crowded, piece)
    row_type = rows.schema["row"]

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=5)
        for whole in batches:
            for piece in text_slices(whole, "text"):
                data, offsets = string_bytes(piece.column("text"))
                raw = data.tobytes()
                texts = [pack.compress(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                keys = row_keys(*ids_and_tags(piece))
                part = (keys % np.uint64(parts)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(keys.view(np.int64)), piece.column("doc_id"), piece.column("row"), pa.array(texts, pa.binary())], ["part", "key", "doc_id", "row", "payload"])

    dealt = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("key", T.LongType()), T.StructField("doc_id", T.LongType()), row_type, T.StructField("payload", T.BinaryType())])
    texts = rows.select("tag", "doc_id", "text", "row").mapInArrow(tidy(squeeze), dealt)

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per part: its span lists first, then its texts, in order of the sort."""
        now, lists, spans = None, [], (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        for whole in batches:
            out: list[tuple] = []
            places: list[int] = []
            size = 0
            for place, (part, kind, key, doc, payload) in enumerate(zip(*(whole.column(c).to_pylist() for c in ("part", "kind", "key", "doc_id", "payload")), strict=True)):
                if part != now:
                    now, lists, spans = part, [], None
                raw = zstandard.ZstdDecompressor().decompress(payload)
                if kind == 0:
                    lists.append(np.frombuffer(raw, "<i8").reshape(3, -1))
                    continue
                if spans is None:
                    table = np.concatenate(lists, axis=1) if lists else np.zeros((3, 0), np.int64)
                    spans, lists = merged(table[0].copy().view(np.uint64), table[1], table[2]), []
                mark = np.uint64(key & 0xFFFFFFFFFFFFFFFF)
                a, b = np.searchsorted(spans[0], mark, "left"), np.searchsorted(spans[0], mark, "right")
                at, kept, gone = 0, [], 0
                for s, e in zip(spans[1][a:b].tolist(), spans[2][a:b].tolist(), strict=True):
                    kept.append(raw[at:s])
                    gone += e - s
                    at = e
                kept.append(raw[at:])
                left = b"".join(kept)
                out.append((doc, len(raw), gone, int(b - a), left.decode("utf-8", "ignore") if decode else left))
                places.append(place)
                size += len(raw)
                if size > 4_000_000:
                    yield result(out, whole.column("row").take(pa.array(places)))
                    out, places, size = [], [], 0
            if out:
                yield result(out, whole.column("row").take(pa.array(places)))

    def result(out: list[tuple], row: pa.Array) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string() if decode else pa.binary()]
        return pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)), row], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "row"])

    nothing = {"key": F.lit(None).cast("long"), "doc_id": F.lit(None).cast("long"), "row": F.lit(None).cast(row_type.dataType)}
    both = spans.withColumns(nothing).withColumn("kind", F.lit(0)).unionByName(texts.withColumn("kind", F.lit(1)))
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    gathered = both.repartition(tasks, "part").sortWithinPartitions("part", "kind")
    counts = [T.StructField(c, T.LongType()) for c in ("doc_id", "n_bytes", "n_removed", "n_spans")]
    return gathered.mapInArrow(tidy(assemble), T.StructType([*counts, T.StructField("kept", T.StringType() if decode else T.BinaryType()), row_type]))

