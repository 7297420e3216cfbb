"""Paths that only large inputs take, and the toxicity model against a plain recomputation."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from registry_analytics.llm import decontaminate, near_dup, suffix_dedup, toxicity

SF = "/root/testdata/sf0.01"


def test_seen_words_against_a_set():
    rng = np.random.default_rng(3)
    seen, plain = toxicity.Seen(), set()
    for n in (0, 5, 1, 400, 3, 3, 3, 1000, 0, 50, 2000):
        values = np.unique(rng.integers(0, 5000, n).astype(np.uint64))
        known = seen.has(values)
        assert known.tolist() == [v in plain for v in values.tolist()]
        seen.add(values[~known])
        plain.update(values.tolist())
        assert seen.size == len(plain)
        assert all(len(a) >= 2 * len(b) for a, b in zip(seen.runs, seen.runs[1:], strict=False))
    seen.clear()
    assert not seen.has(np.arange(9, dtype=np.uint64)).any()


def test_a_benchmark_as_a_table_finds_the_same(spark):
    documents, benchmark = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "benchmark"))
    shared = "which of the following is the correct answer to the question below"
    short = documents.where("text IS NOT NULL").select(F.substring_index("text", " ", 3).alias("text")).limit(5)
    items = benchmark.select("item_id", "text").union(short.select(F.xxhash64("text"), "text"))
    items = items.union(spark.range(40).select((F.col("id") + 900_000).alias("item_id"), F.concat(F.lit(shared + " "), F.col("id").cast("string")).alias("text")))
    copies = spark.range(60).select((F.col("id") + 800_000).alias("doc_id"), F.concat(F.lit("So, "), F.lit(shared), F.lit(". "), F.col("id").cast("string")).alias("text"))
    rows = documents.select("doc_id", "text").union(copies).union(copies.limit(3))
    whole = Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in decontaminate.hits(rows, items).collect())
    table = Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in decontaminate.hits(rows, items, lot_bytes=0).collect())
    assert table == whole
    assert sum(n for key, n in whole.items() if len(key[3]) >= 40) == 63
    kept = decontaminate.keep_clean(rows, items, lot_bytes=0)
    assert kept.columns == rows.columns and kept.count() == sum(n for key, n in whole.items() if not key[2])


def test_the_map_of_crowded_minimisers_has_a_fixed_size(spark):
    footer = " ".join(f"footer{k * 31 % 17}" for k in range(12))
    rows = [(0, k, " ".join(f"{k * 7919 + j * j}" for j in range(20)) + footer + f"{k * 104729 % 99991}") for k in range(1500)]
    frame = spark.createDataFrame(rows, "tag long, doc_id long, text string")
    bits, total = suffix_dedup.crowded_map(frame, 50, 300, flush=20_000)
    assert total == sum(len(t) for _, _, t in rows)
    assert len(bits) == 1 << (suffix_dedup.MAP_BITS - 3)
    assert 0 < int(np.bitwise_count(bits).sum()) < 30
    none, same = suffix_dedup.crowded_map(frame, 50, 10**9, flush=20_000)
    assert len(none) == 0 and same == total
    nothing, zero = suffix_dedup.crowded_map(frame.limit(0), 50, 300)
    assert len(nothing) == 0 and zero == 0


def test_a_group_of_copies_and_a_star_of_near_copies(spark):
    base = [f"word{k * k % 997}" for k in range(60)]
    rows = [(k, " ".join(base)) for k in range(400)]
    rows += [(1000 + k, " ".join([*base, f"tail{k}"])) for k in range(80)]
    rows += [(None, " ".join(base)), (None, None), (5000, None), (5001, ""), (5001, ""), (6000, "apart from all the others here")]
    got = near_dup.classes(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "class_id", "n_links").collect()
    want = Counter()
    for i, t in rows:
        alike = bool(t) and t.startswith("word0 ")
        want[(i, 0 if alike else i, 480 if alike else 0)] += 1
    assert Counter(map(tuple, got)) == want


def plain_words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" or "À" <= c <= "Þ" and c != "×" else c for c in text)
    return [(m.start() + len(m[0]) - len(m[0].lstrip("@$*")), w) for m in re.finditer(r"[0-9a-z@$*\u0080-\U0010ffff]+", low) if (w := m[0].strip("@$*"))]


def edits(a, b):
    """0, 1 or 2 for more."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > 1:
        return 2
    k = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return 1 if a[k + 1 :] == b[k + 1 :] or a[k:] == b[k + 1 :] or a[k + 1 :] == b[k:] else 2


def closest(word, entries):
    best = None
    for i, e in enumerate(entries):
        n = len(e.text)
        own = min((edits(word[:k], e.text) for k in range(max(n - 1, 0), min(n + 1, len(word)) + 1)), default=2) if e.stem else edits(word, e.text)
        if own > 1 or own and n < toxicity.MISSPELL_FROM:
            continue
        key = (own, e.stem, -(e.misspelled if own else e.exact), e.text)
        if best is None or key < best[0]:
            best = (key, i)
    return best and (best[0][0], best[1])


def plain_model(rows):
    seen = defaultdict(dict)
    for text, toxic in rows:
        own = ["", *(w for _, w in plain_words(text)), ""]
        for before, word, after in zip(own, own[1:], own[2:], strict=False):
            if len(word.encode()) >= 3:
                seen[word][before, after] = max(toxic, seen[word].get((before, after), 0))
    counted = {w: (sum(n.values()), len(n)) for w, n in seen.items()}

    def share(hits, total, z=2.0):
        p = hits / total
        return (p + z * z / (2 * total) - z * math.sqrt((p * (1 - p) + z * z / (4 * total)) / total)) / (1 + z * z / total)

    found = [(w, False, t, n) for w, (t, n) in counted.items() if len(w) >= 3 and t >= 5 and share(t, n) >= 0.7]
    stems = defaultdict(list)
    for w, own in counted.items():
        for n in toxicity.STEM_LENGTHS:
            if len(w) > n:
                stems[w[:n]].append(own)
    for w, own in stems.items():
        t, n = sum(x for x, _ in own), sum(x for _, x in own)
        if len(own) >= 3 and t >= 10 and share(t, n) >= 0.8 and t >= 0.9 * n:
            found.append((w, True, t, n))
    vague = {a[0] for a in found for b in found if a[1] and b[1] and len(b[0]) > len(a[0]) and b[0].startswith(a[0]) and b[2] >= 0.7 * a[2] and b[2] * a[3] >= a[2] * b[3]}
    found = [x for x in found if not (x[1] and x[0] in vague)]
    kept = []
    for x in sorted(found, key=lambda x: (len(x[0]), x[0])):
        if not any(k[1] and x[0].startswith(k[0]) for k in kept):
            kept.append(x)
    entries = [toxicity.Entry(w, s, (t + 0.2) / (n + 0.4), 0.0) for w, s, t, n in kept]
    sums, clean = defaultdict(lambda: [0, 0]), set()
    for w, (t, n) in counted.items():
        near = closest(w, entries)
        if near and near[0]:
            sums[near[1]][0] += t
            sums[near[1]][1] += n
        if near and (near[0] or entries[near[1]].stem) and 2 * t < n:
            clean.add(w)
    return [e._replace(misspelled=e.exact * (3 + sums[i][0]) / (4 + sums[i][1])) for i, e in enumerate(entries)], clean


def plain_score(text, entries, clean, answers):
    weights = defaultdict(float)
    for at, word in plain_words(text):
        if word not in answers:
            near = closest(word, entries)
            spared = near and (near[0] or entries[near[1]].stem) and word in clean
            answers[word] = None if not near or spared else entries[near[1]].misspelled if near[0] else entries[near[1]].exact
        if answers[word] is not None:
            weights[word] = max(weights[word], answers[word] * toxicity.context_weight(text, at, at + len(word)))
    return 1 - (1 - toxicity.BASE_SCORE) * math.prod(1 - min(w, 0.999) for w in weights.values())


def test_toxicity_against_a_plain_recomputation(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where("doc_id < 700 AND length(text) < 5000")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    extra = [(10_000 + k, f"You {b} {w} number {k}, go {k * 7 % 13} away") for k, (b, w) in enumerate((b, w) for b in ("utter", "old", "big", "sad") for w in ("grobnik", "grobniks", "grobnak", "grobber", "grobbing", "zzyx"))]
    rows = documents.union(spark.createDataFrame([*extra, (20_000, ""), (20_001, None)], "doc_id long, text string"))
    marked = labels.union(spark.createDataFrame([(i, 1) for i, _ in extra], "doc_id long, toxic int"))
    model = toxicity.fit(rows, marked)
    taught = rows.join(marked.where("toxic IS NOT NULL").distinct(), "doc_id").where("text IS NOT NULL").collect()
    entries, clean = plain_model([(r.text, r.toxic) for r in taught])
    assert [e[:2] for e in model.entries] == [e[:2] for e in entries] and len(entries) >= 3
    for got, want in zip(model.entries, entries, strict=True):
        assert got[2:] == pytest.approx(want[2:])
    assert model.clean == clean
    answers = {}
    wanted = {r.doc_id: plain_score(r.text or "", entries, clean, answers) for r in rows.collect()}
    for r in toxicity.score(rows, model).collect():
        assert r.score == pytest.approx(wanted[r.doc_id]), r.doc_id


def test_words_that_say_nothing_stay_so_where_the_sample_takes_more_of_the_toxic_rows(spark):
    assert toxicity.label_weights({0: 2000, 1: 200}, 5000) == toxicity.label_weights({1: 900}, 50) == toxicity.label_weights({}, 50) == (1.0, 1.0)
    assert toxicity.label_weights({0: 200, 1: 2000}, 200) == (1.0, 1.0)
    assert toxicity.label_weights({0: 2000, 1: 200}, 200) == pytest.approx((10, 0.55))

    toxic = range(0, 2200, 11)
    clean = [r.id for r in spark.range(2200).where("id % 11 > 0").orderBy(F.xxhash64("id"), "id").collect()]  # the first 200 are the sample's
    texts = {i: f"n{i % 83} some n{i % 89} words n{i % 97}" for i in [*clean, *toxic]}
    for k, i in enumerate([*toxic, *clean]):
        if k % 10 < (8 if i in toxic else 6):  # one letter from a toxic word, in most texts of either kind
            texts[i] += f" grobni x{i} zaxto"
    for i in toxic:
        texts[i] += f" grobnik x{i + 1} zaxtor x{i + 2}"
    rare = [*list(toxic)[:10], *clean[200:290]]  # as frequent in either, but the sample has it in toxic texts only
    for i in rare:
        texts[i] += f" dunpel x{i + 3}"
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i in toxic)) for i in texts], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, most_rows=200)
    assert {e.text for e in model.entries} == {"grobnik", "zaxtor"}
    assert {"grobni", "zaxto"} <= model.clean
    marked = {r.doc_id for r in toxicity.score(docs, model).where("score >= 0.7").collect()}
    assert marked == set(toxic)
    assert {r.doc_id for r in toxicity.keep_clean(docs, model).collect()} == set(clean)
