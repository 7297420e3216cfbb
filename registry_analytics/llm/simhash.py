"""SimHash near-duplicates over a Gray-order hierarchical index.

A document's 64-bit fingerprint has the majority bits of its word shingles' hashes; two documents are linked
if theirs differ in at most ``most`` bits.

The index is a tree of masked bit patterns over the distinct fingerprints. Its top is distributed: the bits
are cut into ``most`` + 1 blocks, and a fingerprint hangs below (block, its bits there) for each block. Linked
fingerprints agree in a whole block, so they meet below a common node. A node with more than ``limit``
fingerprints is divided again by blocks of the bits it leaves open, so its size is bounded by these.

Below such a node fingerprints are sorted by Gray rank, and runs of 16, of 16 runs and so on form upper
nodes; each keeps as its pattern the bits that all below it share. Searching pairs of nodes from the top
adds up the differences in bits that the pair newly shares: over ``most``, the pair's groups are pruned as a
whole; if even the open bits cannot exceed ``most``, they are linked as a whole; and groups already linked
with each other are skipped. A node hands on one edge per fingerprint, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import new_work_dir
from .links import components, hub_join
from .spans import gather, string_bytes, text_slices, tidy

SHINGLE = 4
SEED = 42
BITS = 64
FAN = 16
#: Pairs of nodes looked at in one step of a search.
STEP_PAIRS = 1 << 20


def shingle_spans(data: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """(normal text, starts, ends, shingles of each row): A-Z lowered, one space between words, spans of consecutive words."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return b"", none, none, np.zeros(len(offsets) - 1, np.int64)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    first_of_row = np.zeros(len(data) + 1, bool)
    first_of_row[offsets] = True
    after_word = np.append(False, ~blank[:-1]) & ~first_of_row[:-1]
    start = np.flatnonzero(~blank & ~after_word)
    end = np.flatnonzero(~blank & (np.append(blank[1:], True) | first_of_row[1:])) + 1
    kept = ~blank | after_word
    place = np.cumsum(kept) - kept
    text = np.where((data >= 65) & (data <= 90), data + 32, data)
    text[blank] = 32
    first = np.searchsorted(start, offsets)
    words = np.diff(first)
    n = np.where(words >= shingle, words - shingle + 1, np.minimum(words, 1))
    at = gather(first[:-1], n)
    last = np.minimum(at + shingle, np.repeat(first[1:], n)) - 1
    return text[kept].tobytes(), place[start[at]], place[end[last] - 1] + 1, n


def majority(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The bits that over half of each row's hashes have; ``rows`` are their numbers. None: zero."""
    out = np.zeros(len(rows), np.uint64)
    full = np.flatnonzero(rows)
    if not len(full):
        return out
    # bytes can count 255 hashes: rows are summed in runs of so many
    runs = -(-rows[full] // 255)
    run_start = np.repeat(np.cumsum(rows[full]) - rows[full], runs) + 255 * (np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs))
    counts = np.zeros((len(run_start), BITS), np.int64)
    step = 4096
    for at in range(0, len(run_start), step):
        here = run_start[at : at + step]
        stop = run_start[at + step] if at + step < len(run_start) else len(hashes)
        bits = np.unpackbits(hashes[here[0] : stop].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts[at : at + step] = np.add.reduceat(bits, here - here[0], axis=0, dtype=np.uint8)
    total = np.add.reduceat(counts, np.cumsum(runs) - runs, axis=0)
    out[full] = np.packbits(2 * total > rows[full, None], axis=1).view(">u8").ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp`` (long with the fingerprint's bits) of ``doc_id, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for whole in batches:
            for part in text_slices(whole, "text"):
                text, start, end, n = shingle_spans(*string_bytes(part.column("text")), shingle)
                hashes = np.fromiter((digest(text[i:j], SEED) for i, j in zip(start.tolist(), end.tolist(), strict=True)), np.uint64, len(start))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(majority(hashes, n).view(np.int64))], ["doc_id", "fp"])

    return docs.mapInArrow(tidy(run), "doc_id long, fp long")


def gray_rank(words: np.ndarray) -> np.ndarray:
    """The place of each word in the Gray order."""
    rank = words.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def parts_of(a: np.ndarray, b: np.ndarray, label: np.ndarray) -> np.ndarray:
    """``label`` (the least member of each part) after linking the parts of each a and b."""
    a, b = label[a], label[b]
    while len(a):
        low = np.minimum(a, b)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while (label[label] != label).any():
            label = label[label]
        a, b = label[a], label[b]
        open_ = a != b
        a, b = a[open_], b[open_]
    while (label[label] != label).any():
        label = label[label]
    return label


class GrayIndex:
    """The upper nodes over groups of fingerprints, and the parts that links within ``most`` bits make in each group."""

    def __init__(self, group: np.ndarray, words: np.ndarray, most: int, fan: int = FAN):
        order = np.lexsort((gray_rank(words), group))
        self.order, self.words, self.most, self.fan = order, words[order], most, fan
        self.compared = 0
        group = group[order]
        begin = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        every, ones = np.full(len(group), ~np.uint64(0)), self.words
        # a level: masks of shared bits, their values, and the first child of each node
        self.masks, self.values, self.children = [every], [ones], [np.arange(len(group) + 1)]
        low, high, first = ones, ones, begin
        while True:
            count = np.diff(np.append(first, len(low)))
            nodes = -(-count // fan)
            node_group = np.cumsum(nodes) - nodes
            child = np.repeat(first, nodes) + fan * (np.arange(nodes.sum()) - np.repeat(node_group, nodes))
            low, high = np.bitwise_and.reduceat(low, child), np.bitwise_or.reduceat(high, child)
            self.masks.append(~(low ^ high))
            self.values.append(low)
            self.children.append(np.append(child, len(self.masks[-2])))
            first = node_group
            if (nodes == 1).all():
                break

    def parts(self) -> np.ndarray:
        """The least member (as a place in Gray order) of each fingerprint's part."""
        label = np.arange(len(self.words))
        top = len(self.masks) - 1
        nodes = np.arange(len(self.masks[top]))
        stack = [(top, nodes, nodes, np.zeros(len(nodes), np.int64))]
        while stack:
            level, a, b, differ = stack.pop()
            if len(a) > 1 and level:
                size = np.cumsum(self.width(level, a) * self.width(level, b))
                if size[-1] > STEP_PAIRS:
                    half = min(len(a) - 1, max(1, int(np.searchsorted(size, STEP_PAIRS))))
                    stack.append((level, a[half:], b[half:], differ[half:]))
                    a, b, differ = a[:half], b[:half], differ[:half]
            shared = self.masks[level][a] & self.masks[level][b]
            if level:
                same = self.one_part(level, a, b, label)
                open_bits = BITS - np.bitwise_count(shared).astype(np.int64)
                all_linked = ~same & (differ + open_bits <= self.most)
                if all_linked.any():
                    label = self.link_all(level, a[all_linked], b[all_linked], label)
                go = ~same & ~all_linked
                a, b, differ, shared = a[go], b[go], differ[go], shared[go]
                if len(a):
                    stack.append((level - 1, *self.expand(level, a, b, differ, shared)))
            else:
                label = parts_of(a, b, label)
        return label

    def width(self, level: int, nodes: np.ndarray) -> np.ndarray:
        return self.children[level][nodes + 1] - self.children[level][nodes]

    def expand(self, level: int, a: np.ndarray, b: np.ndarray, differ: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of children whose differences, those of the parents and those in newly shared bits, are at most ``most``."""
        wide = self.width(level, b)
        size = self.width(level, a) * wide
        pair = np.repeat(np.arange(len(a)), size)
        nth = np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size)
        x = self.children[level][a][pair] + nth // wide[pair]
        y = self.children[level][b][pair] + nth % wide[pair]
        below = level - 1
        ordered = (x < y) | ((x == y) & (below > 0))
        x, y, pair = x[ordered], y[ordered], pair[ordered]
        self.compared += len(x)
        new = self.masks[below][x] & self.masks[below][y] & ~shared[pair]
        total = differ[pair] + np.bitwise_count((self.values[below][x] ^ self.values[below][y]) & new)
        near = total <= self.most
        return x[near], y[near], total[near]

    def leaves(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last-plus-one fingerprint below each node."""
        low, high = nodes, nodes + 1
        for at in range(level, 0, -1):
            low, high = self.children[at][low], self.children[at][high]
        return low, high

    def one_part(self, level: int, a: np.ndarray, b: np.ndarray, label: np.ndarray) -> np.ndarray:
        """Pairs whose fingerprints are all linked with each other already."""
        changes = np.concatenate([[0], np.cumsum(label[1:] != label[:-1])])
        (a0, a1), (b0, b1) = self.leaves(level, a), self.leaves(level, b)
        return (changes[a1 - 1] == changes[a0]) & (changes[b1 - 1] == changes[b0]) & (label[a0] == label[b0])

    def link_all(self, level: int, a: np.ndarray, b: np.ndarray, label: np.ndarray) -> np.ndarray:
        """All fingerprints below each pair linked: every one is within ``most`` of the other node's first."""
        (a0, a1), (b0, b1) = self.leaves(level, a), self.leaves(level, b)
        left = gather(a0, a1 - a0), gather(b0, b1 - b0)
        right = np.repeat(b0, a1 - a0), np.repeat(a0, b1 - b0)
        return parts_of(np.concatenate(left), np.concatenate(right), label)


def block_masks(open_bits: int, blocks: int) -> list[int]:
    """The set bits of ``open_bits`` cut into so many masks of about equal size, highest bits first."""
    bits = [1 << i for i in range(BITS - 1, -1, -1) if open_bits >> i & 1]
    cuts = [round(len(bits) * k / blocks) for k in range(blocks + 1)]
    return [sum(bits[lo:hi]) for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)]


def divided(nodes: DataFrame, blocks: int) -> DataFrame:
    """``mask, pattern, fp`` below each node (``mask, fp``), for each block of the bits that its mask leaves open."""
    full = (1 << BITS) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask, fp = (batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("mask", "fp"))
            for own in np.unique(mask).tolist():
                below = fp[mask == np.uint64(own)]
                for part in block_masks(full & ~own, blocks):
                    child = np.full(len(below), own | part, np.uint64)
                    yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (child, below & child, below)], ["mask", "pattern", "fp"])

    return nodes.select("mask", "fp").mapInArrow(tidy(run), "mask long, pattern long, fp long")


def search(rows: DataFrame, most: int, tasks: int) -> DataFrame:
    """``a, b`` from each fingerprint below a node (``mask, pattern``) to the first of its part, if another."""

    def edges(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        mask, pattern, fp = (np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in batches]) for c in ("mask", "pattern", "fp"))
        group = np.cumsum(np.append(False, (mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1])))
        index = GrayIndex(group, fp.view(np.uint64), most)
        label = index.parts()
        other = np.flatnonzero(label != np.arange(len(label)))
        words = index.words.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(words[other]), pa.array(words[label[other]])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        waiting = 0
        for whole in batches:
            if not whole.num_rows:
                continue
            mask, pattern = (whole.column(c).to_numpy(zero_copy_only=False) for c in ("mask", "pattern"))
            change = np.flatnonzero((mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1])) + 1
            if held and (held[-1].column("mask")[-1].as_py(), held[-1].column("pattern")[-1].as_py()) != (int(mask[0]), int(pattern[0])):
                change = np.append(0, change)
            # the last node may go on in the next batch
            if len(change) and waiting + whole.num_rows > 100_000:
                cut = int(change[-1])
                yield edges([*held, whole.slice(0, cut)] if cut else held)
                held, waiting = [whole.slice(cut)], whole.num_rows - cut
            else:
                held.append(whole)
                waiting += whole.num_rows
        if held:
            yield edges(held)

    dealt = rows.repartition(tasks, "mask", "pattern").sortWithinPartitions("mask", "pattern")
    return dealt.mapInArrow(tidy(run), "a long, b long").where("a <> b").distinct()


def links(nodes: DataFrame, folder: str, most: int, limit: int, tasks: int, least_open: int = 20) -> DataFrame:
    """Edges ``a, b`` that connect the same fingerprints (``fp``, distinct) as all pairs within ``most`` bits.

    Nodes are divided until they have ``limit`` fingerprints at most, or leave at most ``least_open`` bits open:
    2 ** 20 fingerprints, 8 MB.
    """
    spark = nodes.sparkSession
    rows = nodes.select(F.lit(0).cast("bigint").alias("mask"), "fp")
    found, level = None, 0
    while True:
        level += 1
        rows = divided(rows, most + 1)
        if level > 1:  # two nodes may have been divided into the same one
            rows = rows.distinct()
        rows.write.parquet(f"{folder}/rows-{level}")
        rows = spark.read.parquet(f"{folder}/rows-{level}")
        sizes = rows.groupBy("mask", "pattern").agg(F.count("*").alias("n"))
        sizes.where((F.col("n") > limit) & (F.bit_count("mask") < BITS - least_open)).drop("n").write.parquet(f"{folder}/big-{level}")
        big = spark.read.parquet(f"{folder}/big-{level}")
        done = big.isEmpty()
        small = rows if done else rows.join(big, ["mask", "pattern"], "left_anti")
        search(small, most, tasks).write.parquet(f"{folder}/links-{level}")
        edges = spark.read.parquet(f"{folder}/links-{level}")
        found = edges if found is None else found.union(edges)
        if done:
            return found
        rows = rows.join(big, ["mask", "pattern"], "left_semi")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = 4, shingle: int = SHINGLE, limit: int = 8192) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fp`` (long), ``fingerprint`` (16 hex digits), ``component_id`` (the smallest id that links reach, its own included).

    Words are runs of other bytes than the six ASCII blanks, A-Z lowered. A text of fewer than ``shingle``
    words is one shingle; a null text, or one without words, has fingerprint zero and is linked like any
    other. Repeated rows are copies. Null ids rank last: a component of null ids alone has a null one. An
    empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    folder = new_work_dir(spark, "simhash")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    fingerprints(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")), shingle).write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")).write.parquet(f"{folder}/nodes")
    nodes = spark.read.parquet(f"{folder}/nodes")
    linked = components(links(nodes.select("fp"), folder, most, limit, tasks), f"{folder}/parts")
    linked.write.parquet(f"{folder}/linked")
    linked = spark.read.parquet(f"{folder}/linked")
    rooted = nodes.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted.write.parquet(f"{folder}/rooted")
    rooted = spark.read.parquet(f"{folder}/rooted")
    rooted.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count("*").alias("members")).write.parquet(f"{folder}/firsts")
    named = hub_join(rooted, spark.read.parquet(f"{folder}/firsts"), "root", "members").select("fp", "n", "component_id")
    named.write.parquet(f"{folder}/named")
    out = hub_join(rows, spark.read.parquet(f"{folder}/named"), "fp")
    return out.select("doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
