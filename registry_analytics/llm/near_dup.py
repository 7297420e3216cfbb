"""N-gram Jaccard join of documents by the chosen-path method.

A document is the set of its word five-grams; two are linked at a Jaccard similarity of 0.8 or more.

1. Equal texts are one node; a node has 128 minimum hashes (its tokens) and two bits of each (its sketch).
2. Chosen paths: in every run each node is split on the tokens that a hash of its path samples, on
   average 1 / threshold of them, so similar nodes meet in a child. Buckets over ``limit`` nodes are
   split again, up to ``levels`` times; what is still larger is compared block against block. Runs are
   repeated until the target recall at two levels; nodes of buckets that go deeper have more runs, until
   the target recall at the deepest level.
3. Small buckets are compared by brute force on sketches; a bucket hands on one edge per node, to the
   root of its part, never all its pairs.
4. Inside each connected part of those candidates every pair is compared exactly on whole texts, in
   blocks of bounded size. That gives each node's number of links, and the edges of the final classes.

All intermediate tables are written to the shared folder: lost executors cost no recomputation, and
nothing passes through the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..session import new_work_dir
from .decontaminate import words_of
from .links import components, hub_join
from .spans import BASE, SpanHash, gather, mix, powers, string_bytes, text_slices, tidy, worker_cache

SHINGLE = 5
THRESHOLD = 0.8
TOKENS = 128
#: Sketches that estimate less than this are no candidates; a pair at 0.8 does with a chance of 6e-6.
LEAST_ESTIMATE = 0.59
#: Differing tokens that sketches of candidates have at most.
MOST_DIFFER = int((1 - LEAST_ESTIMATE) * 0.75 * TOKENS)
ROWS = "doc_id long, node binary, n_words long, tokens binary, sketch binary"


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of each row's five-grams in order, their offsets, word hashes, their offsets); a row of one to four words has one shingle."""
    folded, start, end = words_of(data, offsets)
    words = SpanHash(folded)(start, end) if len(start) else np.zeros(0, np.uint64)
    first = np.searchsorted(start, offsets)
    size = np.diff(first)
    n = np.where(size >= SHINGLE, size - SHINGLE + 1, np.minimum(size, 1))
    at = gather(first[:-1], n)
    room = np.repeat(first[1:], n) - at
    out = np.zeros(len(at), np.uint64)
    for i in range(SHINGLE):
        here = room > i
        out[here] = out[here] * BASE + words[at[here] + i]
    return mix(out), np.concatenate([[0], np.cumsum(n)]), words, first


def node_ids(words: np.ndarray, first: np.ndarray) -> list[bytes | None]:
    """128 bits of each row's word sequence; None without words."""
    up, down = powers(len(words) + 1)
    halves = []
    for values in (words, mix(words + np.uint64(1))):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[: len(words)])])
        halves.append(mix((sums[first[1:]] - sums[first[:-1]]) * down[first[:-1]] + np.diff(first).astype(np.uint64)))
    both = np.stack(halves, axis=1).astype(">u8").tobytes()
    return [both[16 * i : 16 * i + 16] if n else None for i, n in enumerate(np.diff(first).tolist())]


def minimum_hashes(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """``TOKENS`` minimum hashes of each row; rows without shingles are zero."""
    out = np.zeros((len(offsets) - 1, TOKENS), np.uint32)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        base = (hashes >> np.uint64(32)).astype(np.uint32)
        salt = mix(np.arange(1, 2 * TOKENS + 1, dtype=np.uint64) * BASE)
        for k in range(TOKENS):
            value = (base ^ np.uint32(salt[2 * k] >> np.uint64(32))) * np.uint32((int(salt[2 * k + 1]) >> 32) | 1)
            value ^= value >> np.uint32(15)
            out[full, k] = np.minimum.reduceat(value, offsets[full])
    return out


def sketches(tokens: np.ndarray) -> np.ndarray:
    """Two bits of a hash of each token, packed into four words a row."""
    two = (mix(tokens.astype(np.uint64) + np.arange(TOKENS, dtype=np.uint64) * BASE) >> np.uint64(62)).reshape(len(tokens), -1, 32)
    return (two << (2 * np.arange(32, dtype=np.uint64))).sum(axis=2, dtype=np.uint64)


def describe(docs: DataFrame) -> DataFrame:
    """``ROWS`` of (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("near_dup")
        for whole in batches:
            for part in text_slices(whole, "text"):
                hashes, offsets, words, first = shingles(*string_bytes(part.column("text")))
                tokens = minimum_hashes(hashes, offsets)
                bits = sketches(tokens)
                columns = [
                    part.column("doc_id"),
                    pa.array(node_ids(words, first), pa.binary()),
                    pa.array(np.diff(first), pa.int64()),
                    pa.array([t.tobytes() for t in tokens], pa.binary()),
                    pa.array([b.tobytes() for b in bits], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "node", "n_words", "tokens", "sketch"])

    return docs.mapInArrow(tidy(run), ROWS)


def matrix(column: pa.Array, kind: type) -> np.ndarray:
    """A binary column of equal lengths as rows of numbers."""
    data, offsets = string_bytes(column)
    return np.frombuffer(data.tobytes(), kind).reshape(len(offsets) - 1, -1)


def paths(nodes: DataFrame, threshold: float, runs: range = range(0)) -> DataFrame:
    """Children ``bucket, node, sketch`` of each row's path: of the roots of ``runs``, or of its ``bucket``."""
    limit = np.uint64(int(2**32 / (threshold * TOKENS)))
    names = ["bucket", "node", "sketch"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.arange(TOKENS, dtype=np.uint64) << np.uint64(32)
        for whole in batches:
            for at in range(0, whole.num_rows, 4000):
                part = whole.slice(at, 4000)
                tokens = matrix(part.column("tokens"), np.uint32).astype(np.uint64) | place
                if runs:
                    seeds = [np.full(len(tokens), mix(np.array([r + 1], np.uint64) * BASE)[0]) for r in runs]
                else:
                    seeds = [mix(part.column("bucket").to_numpy(zero_copy_only=False).view(np.uint64))]
                for seed in seeds:
                    chance = mix(tokens * BASE + seed[:, None])
                    row, token = np.nonzero((chance >> np.uint64(32)) < limit)
                    child = mix(chance[row, token] ^ seed[row])
                    yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), part.column("node").take(pa.array(row)), part.column("sketch").take(pa.array(row))], names)

    return nodes.mapInArrow(tidy(run), "bucket long, node binary, sketch binary")


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of each member's connected part."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def similar_sketches(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows (first before second) whose sketches agree enough, found block by block."""
    most = MOST_DIFFER
    low = np.uint64(0x5555555555555555)
    left, right = [], []
    step = max(1, 2_000_000 // max(len(bits), 1))
    for at in range(0, len(bits) - 1, step):
        block = bits[at : at + step]
        differs = np.zeros((len(block), len(bits) - at), np.uint16)
        for w in range(bits.shape[1]):
            x = block[:, w, None] ^ bits[None, at:, w]
            differs += np.bitwise_count((x | (x >> np.uint64(1))) & low)
        i, j = np.nonzero(differs <= most)
        keep = j > i
        left.append(i[keep] + at)
        right.append(j[keep] + at)
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def small_groups(group: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs inside sorted groups of up to ``most`` rows."""
    begin = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    size = np.diff(np.append(begin, len(group)))
    begin, size = begin[(size > 1) & (size <= most)], size[(size > 1) & (size <= most)]
    left, right = [], []
    for n in np.unique(size).tolist():
        i, j = np.triu_indices(n, 1)
        own = begin[size == n]
        left.append((own[:, None] + i).ravel())
        right.append((own[:, None] + j).ravel())
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def compare_buckets(rows: DataFrame, tasks: int) -> DataFrame:
    """Candidate edges ``a, b`` of buckets that fit a task: from each node to the root of its part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def edges(batch: pa.RecordBatch) -> pa.RecordBatch:
            group = batch.column("bucket").to_numpy(zero_copy_only=False)
            bits = matrix(batch.column("sketch"), np.uint64)
            a, b = small_groups(group, 16)
            x = bits[a] ^ bits[b]
            near = np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(0x5555555555555555)).sum(axis=1) <= MOST_DIFFER
            left, right = [a[near]], [b[near]]
            begin = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            size = np.diff(np.append(begin, len(group)))
            for at, n in zip(begin[size > 16].tolist(), size[size > 16].tolist(), strict=True):
                i, j = similar_sketches(bits[at : at + n])
                root = roots(n, i, j)
                other = np.flatnonzero(root != np.arange(n))
                left.append(other + at)
                right.append(root[other] + at)
            a, b = np.concatenate(left), np.concatenate(right)
            node = batch.column("node")
            return pa.RecordBatch.from_arrays([node.take(pa.array(a)), node.take(pa.array(b))], ["a", "b"])

        for whole in batches:
            if not whole.num_rows:
                continue
            group = whole.column("bucket").to_numpy(zero_copy_only=False)
            last = int(np.searchsorted(group, group[-1], "left"))  # the last bucket may go on in the next batch
            if last:
                yield edges(concat([*held, whole.slice(0, last)]))
                held = []
            elif held and held[-1].column("bucket")[-1].as_py() != int(group[0]):
                yield edges(concat(held))
                held = []
            held.append(whole.slice(last))
        if held:
            yield edges(concat(held))

    return rows.repartition(tasks, "bucket").sortWithinPartitions("bucket").mapInArrow(tidy(run), "a binary, b binary").where("a <> b").distinct()


def concat(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0] if len(batches) > 1 else batches[0]


def write(frame: DataFrame, folder: str, name: str) -> DataFrame:
    frame.write.parquet(f"{folder}/{name}")
    return frame.sparkSession.read.parquet(f"{folder}/{name}")


def chance(n: int, p: float) -> list[float]:
    """The binomial distribution."""
    return [math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(n + 1)]


def missed(threshold: float, runs: int, levels: int) -> float:
    """The chance that a pair at the threshold that is alone in its buckets meets in none of the runs, split ``levels`` times, or that its sketches differ too much."""
    total = 0.0
    for equal, p in enumerate(chance(TOKENS, threshold)):
        survive = 1.0  # the pair shares equal / (threshold * TOKENS) children a level on average
        for _ in range(levels):
            survive = 1 - math.exp(-survive * equal / (threshold * TOKENS))
        total += p * (1 - survive) ** runs
    return total + sum(chance(TOKENS, (1 - threshold) * 0.75)[MOST_DIFFER + 1 :])


def runs_for(threshold: float, recall: float, levels: int) -> int:
    """The fewest runs that find a pair at the threshold with ``recall``, by ``levels`` levels."""
    if missed(threshold, 10_000, levels) > 1 - recall:
        raise ValueError("the sketches are too short for this threshold and recall")
    return next(n for n in range(1, 10_001) if missed(threshold, n, levels) <= 1 - recall)


def candidate_edges(nodes: DataFrame, folder: str, threshold: float, recall: float, limit: int, levels: int, tasks: int) -> DataFrame:
    """Edges found by repeated chosen paths over ``nodes`` (``node, tokens, sketch``).

    A pair that meets in a bucket which goes deeper than two levels has both nodes in it: such nodes are
    given the further runs that the deepest level needs. It may not meet there, or not in the end: each has
    half of what may be missed.
    """
    recall = (1 + recall) / 2
    runs = runs_for(threshold, recall, min(2, levels))
    found, deep = path_edges(nodes, folder, "first", threshold, range(runs), limit, levels, tasks)
    if deep is not None:
        more = nodes.join(deep, "node", "left_semi")
        found += path_edges(more, folder, "more", threshold, range(runs, runs_for(threshold, recall, levels)), limit, levels, tasks)[0]
    edges = found[0]
    for other in found[1:]:
        edges = edges.union(other)
    return edges.distinct()


def path_edges(nodes: DataFrame, folder: str, name: str, threshold: float, runs: range, limit: int, levels: int, tasks: int) -> tuple[list[DataFrame], DataFrame | None]:
    """The edges of some runs by level, and the nodes of buckets split more than twice, if any."""
    rows, found, deep = paths(nodes, threshold, runs), [], None
    for level in range(1, levels + 1):
        big = write(rows.groupBy("bucket").count().where(F.col("count") > limit), folder, f"{name}-big-{level}")
        if big.isEmpty():
            found.append(write(compare_buckets(rows, tasks), folder, f"{name}-edges-{level}"))
            break
        found.append(write(compare_buckets(rows.join(big, "bucket", "left_anti"), tasks), folder, f"{name}-edges-{level}"))
        large = rows.join(big, "bucket")
        if level == 2 and level < levels:
            deep = write(large.select("node").distinct(), folder, f"{name}-deep")
        if level == levels:
            blocks = F.ceil(2 * F.col("count") / limit).cast("int")
            dealt = large.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
            dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            pair = F.xxhash64("bucket", F.least("block", F.col("other").cast("long")), F.greatest("block", F.col("other").cast("long")))
            found.append(write(compare_buckets(dealt.select(pair.alias("bucket"), "node", "sketch"), tasks), folder, f"{name}-edges-blocks"))
            break
        deeper = large.select("bucket", "node").join(nodes.select("node", "tokens", "sketch"), "node")
        rows = write(paths(deeper, threshold), folder, f"{name}-paths-{level}")
    return found, deep


LINKS = "a binary, b binary, n long"


def verify(members: DataFrame, threshold: float, tasks: int) -> DataFrame:
    """Exact links inside groups (``group, lo, hi, block, node, copies, payload``).

    Gives ``a, null, n`` (documents linked to node a by this group) and ``a, b, null`` (edges of the
    group's links, one per node). A group with lo < hi compares the two blocks, else all its nodes.
    """

    def links(keys: list[bytes], copies: np.ndarray, side: np.ndarray, across: bool, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(documents linked to each node, a, b)"""
        size = np.array([len(s) for s in sets])
        begin = np.cumsum(size) - size
        _, codes = np.unique(np.concatenate(sets), return_inverse=True)
        flag = np.zeros(codes.max() + 1, bool)
        total = np.zeros(len(keys), np.int64)
        left, right = [], []
        for i in range(len(keys)):
            own = codes[begin[i] : begin[i] + size[i]]
            flag[own] = True
            common = np.add.reduceat(flag[codes], begin, dtype=np.int64)
            flag[own] = False
            near = common >= threshold * (size + size[i] - common) - 1e-9
            if across:
                near &= side != side[i]
            near[i] = False
            j = np.flatnonzero(near)
            total[i] = copies[j].sum()
            left.append(np.full(len(j), i))
            right.append(j)
        a, b = np.concatenate(left), np.concatenate(right)
        root = roots(len(keys), a, b)
        other = np.flatnonzero(root != np.arange(len(keys)))
        return total, other, root[other]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        ready: list[tuple] = []
        waiting = 0

        def answer() -> pa.RecordBatch:
            out: list[tuple] = []
            unpack = zstandard.ZstdDecompressor()
            texts = pa.array([unpack.decompress(r[3]) for g in ready for r in g], pa.binary())
            hashes, offsets, _, _ = shingles(*string_bytes(texts))
            at = 0
            for g in ready:
                sets = [np.unique(hashes[offsets[k] : offsets[k + 1]]) for k in range(at, at + len(g))]
                at += len(g)
                keys = [r[1] for r in g]
                total, a, b = links(keys, np.array([r[2] for r in g]), np.array([r[0] for r in g]), g[0][4], sets)
                out.extend((k, None, n) for k, n in zip(keys, total.tolist(), strict=True) if n)
                out.extend((keys[i], keys[j], None) for i, j in zip(a.tolist(), b.tolist(), strict=True))
            ready.clear()
            columns = list(zip(*out, strict=True)) or [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.binary(), pa.binary(), pa.int64()), strict=True)], ["a", "b", "n"])

        for whole in batches:
            for group, lo, hi, block, node, copies, payload in zip(*(whole.column(c).to_pylist() for c in ("group", "lo", "hi", "block", "node", "copies", "payload")), strict=True):
                if (group, lo, hi) != now:
                    if len(held) > 1:
                        ready.append(tuple(held))
                    now, held = (group, lo, hi), []
                    if waiting > 1_000_000:
                        if ready:
                            yield answer()
                        waiting = 0
                held.append((int(block != lo), node, copies, payload, lo < hi))
                waiting += len(payload)
        if len(held) > 1:
            ready.append(tuple(held))
        if ready:
            yield answer()

    return members.repartition(tasks, "group", "lo", "hi").sortWithinPartitions("group", "lo", "hi").mapInArrow(tidy(run), LINKS)


def texts_of(docs: DataFrame) -> DataFrame:
    """``doc_id, node, payload`` (compressed text) of each row of ``docs`` (``doc_id, text``) with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for whole in batches:
            for part in text_slices(whole, "text"):
                data, offsets = string_bytes(part.column("text"))
                folded, start, end = words_of(data, offsets)
                words = SpanHash(folded)(start, end) if len(start) else np.zeros(0, np.uint64)
                keys = node_ids(words, np.searchsorted(start, offsets))
                raw = data.tobytes()
                ids = part.column("doc_id").to_pylist()
                rows = [(i, k, pack.compress(raw[a:b])) for i, k, a, b in zip(ids, keys, offsets[:-1].tolist(), offsets[1:].tolist(), strict=True) if k]
                columns = list(zip(*rows, strict=True)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.binary()), strict=True)], ["doc_id", "node", "payload"])

    return docs.select("doc_id", "text").mapInArrow(tidy(run), "doc_id long, node binary, payload binary")


def classes(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
    recall: float = 0.9999,
    limit: int = 4096,
    levels: int = 5,
    block_nodes: int = 256,
    block_words: int = 400_000,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, class_id`` (smallest id of its class, the documents that links
    connect), ``n_links`` (other rows at ``threshold`` or more, copies included) ``node`` (its text's
    key) and ``root`` (the key of its class).

    Words are runs of ASCII letters, digits and non-ASCII characters, A-Z in lower case. A text of one to
    four words is one shingle; a null text or one without words has no links and is a class alone. Null
    ids rank last: a class of null ids alone has a null id. Repeated rows are copies of each other. An
    empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    folder = new_work_dir(spark, "near-dup")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    read = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = write(describe(read), folder, "rows")
    grouped = rows.where("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), F.first("n_words").alias("n_words"), F.first("tokens").alias("tokens"), F.first("sketch").alias("sketch")
    )
    nodes = write(grouped, folder, "nodes")
    near = components(candidate_edges(nodes.select("node", "tokens", "sketch"), folder, threshold, recall, limit, levels, tasks), f"{folder}/near")
    members = write(near.join(nodes.select("node", "first_id", "copies", "n_words"), "node"), folder, "members")
    sizes = members.groupBy("root").agg(F.count("*").alias("n"), F.sum("n_words").alias("words"))
    blocks = F.greatest(F.ceil(F.col("n") / block_nodes), F.ceil(F.col("words") / block_words)).cast("int")
    dealt = hub_join(members, write(sizes.select("root", "n", blocks.alias("blocks")), folder, "sizes"), "root")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # by key and smallest id, so the copies of one text do not meet; merged at every size: the members grow with the input, and a broadcast of few would only hide what many cost
    held = dealt.select(F.col("node").alias("member"), "first_id", "root", "copies", "blocks", "block").hint("merge")
    one = texts_of(read).join(held, (F.col("node") == F.col("member")) & F.col("doc_id").eqNullSafe(F.col("first_id"))).dropDuplicates(["node"])
    paired = one.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    paired = paired.select(F.col("root").alias("group"), F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "node", "copies", "payload")
    checked = write(verify(paired, threshold, tasks), folder, "checked")
    links = checked.where("n IS NOT NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    joined = components(checked.where("b IS NOT NULL").select("a", "b"), f"{folder}/class")
    named = nodes.select("node", "first_id", "copies").join(joined, "node", "left").join(links.withColumnRenamed("n", "linked"), "node", "left")
    named = write(named.withColumn("root", F.coalesce("root", "node")), folder, "named")
    ids = write(named.groupBy("root").agg(F.min("first_id").alias("class_id"), F.count("*").alias("n")), folder, "ids")
    n_links = F.col("copies") - 1 + F.coalesce("linked", F.lit(0))
    found = write(hub_join(named, ids, "root").select("node", "root", "class_id", n_links.alias("n_links"), "copies"), folder, "found")
    alike = hub_join(rows.where("node IS NOT NULL").select("doc_id", "node"), found, "node", "copies")
    alone = rows.where("node IS NULL").select("doc_id", "node", F.lit(None).cast("binary").alias("root"), F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return alike.unionByName(alone).select("doc_id", "class_id", "n_links", "node", "root")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options: float) -> DataFrame:
    """One row of each class of ``docs``, that of the smallest id (ties: the lowest row hash), all columns as they
    were; rows without words are all kept. ``options`` go to ``classes``."""
    found = classes(docs, doc_id, text, **options).where("node IS NOT NULL").select("root", "doc_id", "node").distinct()
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "node")).alias("first")).select("first.doc_id", "first.node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in text_slices(whole, "text"):
                _, _, words, start = shingles(*string_bytes(part.column("text")))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(node_ids(words, start), pa.binary()), part.column("row")], ["doc_id", "node", "row"])

    whole = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.struct("*").alias("row"))
    keyed = whole.mapInArrow(tidy(run), T.StructType([whole.schema["doc_id"], T.StructField("node", T.BinaryType()), whole.schema["row"]]))
    held = keyed.where("node IS NOT NULL").alias("k").join(first.alias("f"), F.col("k.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("k.node") == F.col("f.node")), "left_semi")
    order = Window.partitionBy("doc_id", "node").orderBy(F.xxhash64("row"))
    once = held.withColumn("nth", F.row_number().over(order)).where("nth = 1").select("row.*")
    return once.unionByName(keyed.where("node IS NULL").select("row.*"))
