"""Vector codes, whitening and SimHash against brute force, with nulls, ties, repeats, empty tables and clashing columns."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from registry_analytics.llm import bidiagonal_qd, links, queries, simhash, vector_codes, whitening
from registry_analytics.session import new_work_dir

SF = "/root/testdata/sf0.01"
VECTORS = "vec_id long, embedding array<float>, label int, x string, error int, n int"


def odd_vectors(n=120, size=16, seed=3):
    r = random.Random(seed)
    rows = [(i * 3, [r.gauss(0, 1) for _ in range(size)], r.choice([1, 2, None])) for i in range(n)]
    rows += [rows[2], rows[2], (7, rows[2][1], 1), (None, rows[-1][1], None), (None, [0.5] * size, 2)]
    rows += [(400 + i, [float(i // 2)] * size, 3) for i in range(min(n, 9))]
    rows += [(1, None, 1), (2, [None] * size, 1), (4, [1.0] * (size - 1) + [float("nan")], 1), (5, [math.inf] + [0.0] * (size - 1), 2), (-1, rows[0][1], 1)]
    r.shuffle(rows)
    return [(i, v, label, "x", 1, 2) for i, v, label in rows]


def kept(rows):
    return [(r[0], r[1], r[2]) for r in rows if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])]


def brute_codes(rows, parts=8, entries=16, rounds=6):
    """The contract in plain Python: (row, code, error) of each kept row, and the digest."""
    rows = [(i, [math.floor(4096 * float(np.float32(c))) for c in v], label) for i, v, label in kept(rows)]
    by_id = {}
    for i, v, _ in rows:
        by_id[i] = min(v, by_id.get(i, v))
    first = sorted(by_id, key=lambda i: (i is None, i or 0))[:entries]
    width = len(rows[0][1]) // parts
    books = [[by_id[i][p * width : (p + 1) * width] for i in first] for p in range(parts)]

    def nearest(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        groups = [defaultdict(list) for _ in range(parts)]
        for _, v, _ in rows:
            for p in range(parts):
                part = v[p * width : (p + 1) * width]
                groups[p][nearest(p, part)[1]].append(part)
        for p in range(parts):
            for k, members in groups[p].items():
                books[p][k] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    out, per_label = [], defaultdict(int)
    for i, v, label in rows:
        found = [nearest(p, v[p * width : (p + 1) * width]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label))
        per_label[label] += out[-1][2]
    digest = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    return sorted([(i, code, error, per_label[label]) for i, code, error, label in out], key=repr), digest


@pytest.mark.parametrize("n", [120, 3])
def test_codes_match_brute_force(spark, n):
    rows = odd_vectors(n)
    codes = vector_codes.encode(spark.createDataFrame(rows, VECTORS).repartition(5))
    want, digest = brute_codes(rows)
    got = [(r.vec_id, r.code, r.error, r.label_error) for r in codes.rows.collect()]
    assert sorted(got, key=repr) == want and codes.digest() == digest


def test_codes_of_a_given_table_match_brute_force(spark):
    rows = [tuple(r) for r in queries.table(spark, SF, "embeddings").select("vec_id", "embedding", "label").collect()]
    want, digest = brute_codes(rows)
    got = queries.op11_vector_codes(spark, SF).collect()
    assert sorted([(r.vec_id, r.code, r.error, r.label_error) for r in got], key=repr) == want
    assert {r.codebooks_sha256 for r in got} == {digest}


def test_codes_of_empty_tables_and_vectors(spark):
    none = vector_codes.encode(spark.createDataFrame([], VECTORS))
    assert none.rows.count() == 0 and none.digest() == hashlib.sha256(b"").hexdigest()
    bare = vector_codes.encode(spark.createDataFrame([(1, [], 1, "x", 1, 2), (2, [], None, "x", 1, 2)], VECTORS))
    assert {(r.code, r.error) for r in bare.rows.collect()} == {("00" * 8, 0)}
    with pytest.raises(ValueError, match="different lengths"):
        vector_codes.encode(spark.createDataFrame([(1, [1.0] * 8, 1, "x", 1, 2), (2, [1.0] * 16, 1, "x", 1, 2)], VECTORS))


def test_memoised_cells_find_the_nearest_entry():
    r = np.random.default_rng(5)
    for size, scale in ((1, 5), (3, 40), (8, 2000), (2, 1 << 40)):
        book = r.integers(-scale, scale, (16, size))
        book[7] = book[2]
        rows = np.concatenate([r.integers(-scale, scale, (800, size)), book, r.integers(-20 * scale, 20 * scale, (50, size))])
        memo = {}
        for _ in range(2):  # the second time from the memo
            index, distance = vector_codes.NearestEntry(book, memo)(rows)
            exact = ((rows[:, None].astype(object) - book[None].astype(object)) ** 2).sum(axis=2)
            assert (distance == exact.min(axis=1)).all()
            assert index.tolist() == [row.index(min(row)) for row in exact.tolist()]
        assert memo
    near = vector_codes.NearestEntry(np.array([[0, 0], [1000, 1000], [5000, 0]]), {})
    assert near.candidates(np.array([[0, 0]])).tolist() == [3]  # the far entry is dominated


def brute_whitening(rows, components=16):
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v, _ in kept(rows)])
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(axis=0)
    centred = (n * fit - total) / n
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1], v[:, ::-1]
    k = min(components, int((e > 1e-9 * e[0]).sum()))
    exact = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, total, strict=True)) for row in x]
    return n, exact, ((n * x - total) / n) @ v[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


@pytest.mark.parametrize("n", [120, 6])
def test_whitening_matches_eigenvectors(spark, n):
    rows = odd_vectors(n)
    table = spark.createDataFrame(rows, VECTORS).repartition(40)
    got = whitening.whiten(table).collect()
    count, exact, white, explained = brute_whitening(rows)
    assert {r.n for r in got} == {count} and len(got) == len(exact) * white.shape[1]
    assert {r.component for r in got} == set(range(1, white.shape[1] + 1))
    assert max(r.identity_error for r in got) < 1e-9
    for k in range(1, white.shape[1] + 1):
        mine = sorted((r.whitened, int(r.deviation)) for r in got if r.component == k)
        sign = [sorted(zip((s * white[:, k - 1]).tolist(), exact, strict=True)) for s in (1, -1)]
        close = [all(abs(a - b) < 1e-6 for (a, _), (b, _) in zip(mine, s, strict=True)) for s in sign]
        assert any(close)
        assert sorted(d for _, d in mine) == sorted(exact)
        assert all(abs(r.explained - explained[k - 1]) < 1e-9 for r in got if r.component == k)


def test_whitening_of_a_given_table(spark):
    rows = [tuple(r) for r in queries.table(spark, SF, "embeddings").select("vec_id", "embedding", "label").collect()]
    n, exact, white, explained = brute_whitening(rows)
    got = sorted(queries.op12_whitening(spark, SF).collect(), key=lambda r: (r.vec_id, r.component))
    mine = np.array([r.whitened for r in got]).reshape(len(rows), 16)
    order = np.argsort([r[0] for r in rows])
    white = white[order]
    white *= np.sign((mine * white).sum(axis=0))
    assert np.abs(mine - white).max() < 1e-8
    assert [r.deviation for r in got[::16]] == [exact[i] for i in order]
    assert {r.n for r in got} == {n} and got[0].identity_error < 1e-10
    assert np.allclose([r.explained for r in got[:16]], explained, rtol=1e-9)


def test_whitening_without_variance(spark):
    assert whitening.whiten(spark.createDataFrame([], VECTORS)).count() == 0
    same = [(i, [0.25, 0.5], 1, "x", 1, 2) for i in range(4)]
    assert whitening.whiten(spark.createDataFrame(same, VECTORS)).count() == 0
    one = whitening.whiten(spark.createDataFrame([*same, (9, [0.75, 0.5], 1, "x", 1, 2)], VECTORS)).collect()
    assert len(one) == 5 and sorted(round(abs(r.whitened), 9) for r in one) == [1.0] * 5 and {r.n for r in one} == {2}


def test_bidiagonal_solver_on_hard_matrices():
    r = np.random.default_rng(1)
    graded = r.standard_normal((200, 24)) * 10.0 ** -np.arange(0, 12, 0.5)
    orthogonal = np.linalg.qr(r.standard_normal((24, 24)))[0]
    repeated = np.linalg.qr(r.standard_normal((60, 24)))[0] * np.repeat([3.0, 2.0, 1.0], 8) @ orthogonal
    tied = np.linalg.cholesky(np.diag(np.abs(np.arange(21) - 10.0) + 3) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)).T
    for a in (graded, repeated, tied, np.eye(9), np.eye(12) - 1 / 12, np.outer(r.standard_normal(9), r.standard_normal(5)), r.standard_normal((40, 1)), r.standard_normal((3, 11))):
        size = a.shape[1]
        s = np.zeros(size)
        s[: min(a.shape)] = np.linalg.svd(a, compute_uv=False)
        squares, v = bidiagonal_qd.right_singular(whitening.triangle(a, size))
        k = int((s > 1e-9 * s[0]).sum())
        assert np.abs(np.sqrt(squares[:k]) - s[:k]).max() <= 1e-11 * s[0]
        assert np.abs(np.sqrt(squares[:k]) / s[:k] - 1).max() < 1e-9
        white = a @ v[:, :k] / np.sqrt(squares[:k])
        assert np.abs(white.T @ white - np.eye(k)).max() < 1e-9


def brute_fingerprint(text, shingle=4):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(blank, " ")
    words = [w for w in lowered.split(" ") if w]
    spans = [words[i : i + shingle] for i in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), seed=42) for s in spans]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(rows):
    prints = [brute_fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                label[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        ids[find(i)].append(doc)
    return sorted([(doc, f"{prints[i]:016x}", min((d for d in ids[find(i)] if d is not None), default=None)) for i, (doc, _) in enumerate(rows)], key=repr)


LONG = " ".join(f"Word{i * 7919 % 1013}" for i in range(30_000))
TEXTS = [None, "", " \t\n", "one", "One\ttwo", "one  two three", "a b c d", "a b c d e", LONG, LONG + " end", "été ñandú\x00 \x85z   q w", "ÀÉ x", "x\x1fy z\x0bw v"]


def test_simhash_matches_brute_force(spark):
    rows = list(enumerate(TEXTS)) + [(None, "one"), (None, "no other text is like this one"), (99, TEXTS[7]), (99, TEXTS[7])]
    rows += [(50 + i, f"the same long sentence about a thing of number {'seven' if i % 2 else 'eight'} that goes on and on until it ends at last somewhere far away from here") for i in range(6)]
    docs = spark.createDataFrame([(i, t, 1, "fp", 2, "root") for i, t in rows], "doc_id long, text string, n int, fp string, node int, root string").repartition(4)
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash.classes(docs).collect()]
    assert sorted(got, key=repr) == brute_classes(rows)
    assert simhash.classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_simhash_of_a_given_table_matches_brute_force(spark):
    docs = queries.table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in queries.op13_simhash(spark, "/root/testdata/sf0.001").collect()]
    assert sorted(got, key=repr) == brute_classes([tuple(d) for d in docs])


def clustered(n, seed):
    """Fingerprints of which many are a few bits from another one."""
    r = np.random.default_rng(seed)
    words = r.integers(0, 1 << 63, n // 4, dtype=np.uint64) * np.uint64(2) + r.integers(0, 2, n // 4).astype(np.uint64)
    out = [words]
    for _ in range(3):
        flips = np.zeros(len(words), np.uint64)
        for _ in range(int(r.integers(1, 6))):
            flips ^= np.uint64(1) << r.integers(0, 64, len(words)).astype(np.uint64)
        out.append(words[r.integers(0, len(words), len(words))] ^ flips)
    dense = np.uint64(0x0123456789ABCDEF) ^ r.integers(0, 1 << 10, n // 4, dtype=np.uint64)
    return np.unique(np.concatenate([*out, dense, np.arange(8, dtype=np.uint64)]))


def brute_parts(words, most=4):
    label = np.arange(len(words))
    while True:
        before = label.copy()
        for i in range(len(words)):
            near = np.bitwise_count(words ^ words[i]) <= most
            label[near] = label[near].min()
        if (label == before).all():
            return label


def same_partition(a, b):
    return len(set(zip(a, b, strict=True))) == len(set(a)) == len(set(b))


@pytest.mark.parametrize("fan", [2, 16])
def test_gray_index_finds_all_parts(fan):
    words = clustered(1200, fan)
    index = simhash.GrayIndex(np.zeros(len(words), np.int64), words, 4, fan)
    assert (np.diff(simhash.gray_rank(index.words).astype(object)) > 0).all()
    assert same_partition(index.parts().tolist(), brute_parts(index.words).tolist())
    assert index.compared < len(words) ** 2 / 2  # groups have been pruned or skipped
    groups = np.arange(len(words)) % 7
    index = simhash.GrayIndex(groups, words, 4, fan)
    label = index.parts()
    for g in range(7):
        here = groups[index.order] == g
        assert same_partition(label[here].tolist(), brute_parts(index.words[here]).tolist())


@pytest.mark.parametrize("limit", [8192, 40, 3])
def test_divided_nodes_lose_no_link(spark, limit):
    words = clustered(600, 9)
    nodes = spark.createDataFrame([(int(w),) for w in words.view(np.int64)], "fp long")
    folder = new_work_dir(spark, "test-simhash")
    edges = simhash.links(nodes, folder, 4, limit, 4)
    found = dict(links.components(edges, f"{folder}/parts").collect())
    root = [found.get(int(w), int(w)) for w in words.view(np.int64)]
    assert same_partition(root, brute_parts(words).tolist())
    assert all(bin((int(r.a) ^ int(r.b)) & (1 << 64) - 1).count("1") <= 64 for r in edges.collect())


def test_components_and_hub_join_with_a_hub(spark):
    r = random.Random(2)
    pairs = [(0, i) for i in range(1, 400)] + [(i, i + 1) for i in range(500, 560)] + [(r.randrange(600, 900), r.randrange(600, 900)) for _ in range(150)] + [(560, 399), (7, 7)]
    label = {}

    def find(x):
        label.setdefault(x, x)
        while label[x] != x:
            x = label[x]
        return x

    for a, b in pairs:
        if a != b:
            label[max(find(a), find(b))] = min(find(a), find(b))
    got = links.components(spark.createDataFrame(pairs, "a long, b long"), new_work_dir(spark, "test-links")).collect()
    assert {x.node: x.root for x in got} == {x: find(x) for x in label} and len(got) == len(label)
    assert links.components(spark.createDataFrame([], "a long, b long"), new_work_dir(spark, "test-links")).count() == 0
    rows = spark.createDataFrame([(1, i) for i in range(3000)] + [(None, i) for i in range(2000)] + [(10 + i, i) for i in range(2000)], "k long, v long")
    per_key = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("v").alias("most"))
    joined = links.hub_join(rows, per_key, "k")
    assert joined.columns == ["k", "v", "most"] and joined.count() == 7000
    assert joined.where("k IS NULL AND most = 1999").count() == 2000 and joined.where("k = 1 AND most = 2999").count() == 3000
