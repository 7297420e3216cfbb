"""Operators of the llm subpackage against brute force, on small tables with nulls, ties, repeats and clashing columns."""

import hashlib
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from registry_analytics.llm import decontaminate, langid, near_dup, packing, quality, queries, suffix_dedup, token_store, toxicity, url_filter, wrapper
from registry_analytics.session import new_work_dir

SF = "/root/testdata/sf0.01"
LONG = " ".join(f"word{i * 7919 % 1013}" for i in range(60_000))
PASSAGE = " ".join(f"passage{i}" for i in range(70))
ODD = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from it all"),
    (2, None),
    (3, ""),
    (4, LONG),
    (5, "The quick brown fox jumps over the lazy dog and runs away from it all"),
    (5, "The quick brown fox jumps over the lazy dog and runs away from it all"),
    (6, "x " + PASSAGE + " y"),
    (7, PASSAGE + " été ñandú z"),
    (7, "another text under the same id " + PASSAGE),
    (None, "some text without an id " + PASSAGE),
    (8, "  \n\t "),
    (9, "ééééé" * 30),
    (10, "à" + "ééééé" * 30),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Columns beside doc_id and text have names that operators use inside."""
    rows = [(i, t, "row", 1, "node", b"payload") for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, row string, part int, node string, payload binary")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path())


def ids_of(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def test_packing_cuts_every_document_once(odd, empty, tokenizer):
    pieces = packing.pack(odd, queries.tokenizer_path(), capacity=256, most_open=4).collect()
    by_doc: dict = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        by_doc.setdefault((p.doc_id, p.doc_tokens), []).append((p.start, np.frombuffer(bytes(p.ids), "<u4")))
    for i, t in set(ODD):
        ids, copies = ids_of(tokenizer, t), ODD.count((i, t))
        parts = sorted(by_doc[i, len(ids)], key=lambda x: x[0])
        if Counter((i, len(ids_of(tokenizer, t))) for i, t in ODD)[i, len(ids)] == 1:
            assert (np.concatenate([x for _, x in parts]) == ids).all()
        assert sum(len(x) for _, x in parts) >= copies * len(ids)
    fill = Counter()
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == fill[p.sequence_id] and p.length == len(bytes(p.ids)) // 4
        fill[p.sequence_id] += p.length
    assert sum(fill.values()) == sum(len(ids_of(tokenizer, t)) for _, t in ODD)
    assert all(n <= 256 and (n & (n - 1)) == 0 for n in fill.values())
    assert packing.pack(empty, queries.tokenizer_path()).count() == 0


def test_token_store_round_trip(spark, odd, empty, tokenizer):
    folder = new_work_dir(spark, "test-store")
    token_store.write_store(odd, folder, queries.tokenizer_path(), block_bytes=1000)
    rows = token_store.with_starts(token_store.documents(spark, folder), folder).orderBy("start").collect()
    assert [r.doc_id for r in rows] == sorted((i for i, _ in ODD), key=lambda i: (i is not None, i))
    assert Counter((r.doc_id, zlib.crc32(bytes(r.ids))) for r in rows) == Counter((i, zlib.crc32(ids_of(tokenizer, t).tobytes())) for i, t in ODD)
    at = 0
    for r in rows:
        assert r.start == at and r.n_tokens == len(bytes(r.ids)) // 4
        at += r.n_tokens
    one = token_store.fetch(spark, folder, [4]).collect()
    assert [bytes(r.ids) for r in one] == [ids_of(tokenizer, LONG).tobytes()]
    payload = bytes(spark.read.parquet(f"{folder}/blocks").first()["payload"])
    with pytest.raises(ValueError):
        token_store.open_block(payload, b"another dictionary")
    folder = new_work_dir(spark, "test-store")
    token_store.write_store(empty, folder, queries.tokenizer_path())
    assert token_store.documents(spark, folder).count() == 0


def test_quality_and_decontamination_match_sql_on_odd_rows(spark, odd, empty):
    plain = odd.select("doc_id", "text")
    items = [(1, PASSAGE), (2, None), (3, ""), (4, "quick Brown"), (None, "lazy dog"), (10, "lazy dog"), (2, " ".join(PASSAGE.split()[:30]))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    con = duckdb.connect()
    con.register("documents", plain.toPandas().astype({"doc_id": "Int64"}))
    con.register("benchmark", benchmark.toPandas().astype({"item_id": "Int64"}))
    for frame, sql in (
        (quality.judge(odd).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"), quality.judge_sql()),
        (with_digest(decontaminate.hits(odd, benchmark)), decontaminate.DECONTAMINATION_SQL),
        (with_digest(decontaminate.hits(odd, benchmark, lot_bytes=10)), decontaminate.DECONTAMINATION_SQL),
    ):
        assert Counter(map(tuple, frame.collect())) == Counter(con.execute(sql).fetchall())
    assert quality.judge(empty).count() == 0 and decontaminate.hits(empty, benchmark).count() == 0
    assert decontaminate.hits(odd, benchmark.limit(0)).where("n_hit > 0").count() == 0


def with_digest(found):
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long"), decontaminate.items_digest(F.col("items")), F.col("n_hit") > 0)


def brute_repeats(rows, length=50):
    first: dict[bytes, int] = {}
    for i, t in rows:
        raw = (t or "").encode()
        for k in range(len(raw) - length + 1):
            key = raw[k : k + length]
            first[key] = min(first.get(key, 1 << 62), 1 << 62 if i is None else i)
    out = Counter()
    for i, t in rows:
        raw = (t or "").encode()
        mark = bytearray(len(raw))
        for k in range(len(raw) - length + 1):
            if first[raw[k : k + length]] < ((1 << 62) if i is None else i):
                mark[k : k + length] = b"\1" * length
        kept = bytes(c for c, m in zip(raw, mark, strict=True) if not m)
        out[i, len(raw), sum(mark), len(re.findall(rb"\x01+", bytes(mark))), hashlib.sha256(kept).hexdigest()] += 1
    return out


def test_suffix_dedup_matches_brute_force(spark, odd, empty):
    got = suffix_dedup.remove_repeats(odd, carry=("row", "part")).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    assert Counter(map(tuple, got.collect())) == brute_repeats(ODD)
    assert suffix_dedup.remove_repeats(empty).count() == 0


def removed_by_brute_force(spark, rows, slices, **options):
    """Each row in a partition of its own, so that repeats meet in the buckets only."""
    frame = spark.createDataFrame(spark.sparkContext.parallelize(rows, slices), "doc_id long, text string")
    got = suffix_dedup.remove_repeats(frame, **options).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    assert Counter(map(tuple, got.collect())) == brute_repeats(rows)


def test_suffix_dedup_of_a_document_that_repeats_itself(spark):
    line = " ".join(f"line{k}" for k in range(25)) + "\n"
    rows = [(900, line * 20), (5, line * 20), (901, "own words before " + line * 3 + "between " + line * 2), (902, " " * 700), (7, " " * 300), (None, line * 4), (None, "x" + line * 2), (903, line * 3), (903, "y" + line * 5)]
    removed_by_brute_force(spark, rows, len(rows))
    removed_by_brute_force(spark, rows, 3)


def test_suffix_dedup_of_texts_longer_than_a_piece(spark):
    words = " ".join(f"w{k * k % 9973}" for k in range(700))
    rows = [(1, words), (2, "before " + words[1000:3000] + " after"), (3, words + words), (4, words[:120]), (5, None)]
    removed_by_brute_force(spark, rows, 3, piece=173)
    removed_by_brute_force(spark, rows, 1, piece=4000)


def test_suffix_dedup_of_a_text_over_16_mib(spark):
    rng = np.random.default_rng(8)
    raw = rng.integers(97, 123, (1 << 24) + 5000).astype(np.uint8).tobytes().decode()
    rows = [(1, raw[-3000:]), (2, raw)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_dedup.remove_repeats(frame).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    assert Counter(map(tuple, got.collect())) == Counter([(1, 3000, 0, 0, hashlib.sha256(rows[0][1].encode()).hexdigest()), (2, len(raw), 3000, 1, hashlib.sha256(raw[:-3000].encode()).hexdigest())])


def test_suffix_dedup_splits_a_crowded_minimiser(spark):
    footer = " ".join(f"footer{k * 31 % 17}" for k in range(12))
    rows = [(k, " ".join(f"{k * 7919 + j * j}" for j in range(20)) + footer + f"{k * 104729 % 99991} end {k}") for k in range(1500)]
    removed_by_brute_force(spark, rows[:300], 4, crowd=64)
    frame = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2), "doc_id long, text string").withColumn("tag", F.lit(0))

    def most(crowd):
        dealt = suffix_dedup.deal_records(frame.select("tag", "doc_id", "text"), 50, 64, 16, crowd).where("bucket >= 0").collect()
        held = Counter()
        for r in dealt:
            held[r.bucket] += len(suffix_dedup.unpack_records(bytes(r.payload))[0])
        return max(held.values()), sum(held.values())

    whole, _ = most(10**9)
    split, records = most(300)
    assert whole > 1500 and split < 3 * records / 64


def test_suffix_sort_of_ties_matches_sorted():
    rng = np.random.default_rng(5)
    text = np.concatenate([rng.integers(97, 99, 400), np.tile(rng.integers(97, 100, 60), 9), np.zeros(78)]).astype(np.uint8)
    at = np.arange(len(text) - 78 - 50)
    docs = at // 100
    raw = text.tobytes()
    least: dict[bytes, int] = {}
    for a, d in zip(at.tolist(), docs.tolist(), strict=True):
        least[raw[a : a + 50]] = min(least.get(raw[a : a + 50], 99), d)
    assert suffix_dedup.repeated(text, at, docs, 50).tolist() == [least[raw[a : a + 50]] < d for a, d in zip(at.tolist(), docs.tolist(), strict=True)]


def brute_classes(rows):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    sets = []
    for _, t in rows:
        w = word.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    near = [[j for j in range(len(rows)) if j != i and sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])] for i in range(len(rows))]
    out = []
    for i in range(len(rows)):
        seen, stack = {i}, [i]
        while stack:
            for j in near[stack.pop()]:
                if j not in seen:
                    seen.add(j)
                    stack.append(j)
        known = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], min(known) if known else None, len(near[i])))
    return Counter(out)


def near_copies():
    base = [f"w{k}" for k in range(120)]
    rows = list(ODD)
    for n in range(40):  # a group that is larger than the limits given below
        words = list(base)
        words[n * 3] = f"changed{n}"
        rows.append((100 + n, " ".join(words)))
    return rows


def test_jaccard_join_matches_brute_force(spark, empty):
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dup.classes(docs, limit=16, levels=2, block_nodes=16).select("doc_id", "class_id", "n_links")
    assert Counter(map(tuple, got.collect())) == brute_classes(rows)
    kept = near_dup.keep_one(docs.withColumn("node", F.lit("x"))).collect()
    wordless = sum(not re.search(r"\w", t or "") for _, t in rows)
    assert len(kept) == wordless + len({c for (_, c, _) in brute_classes([r for r in rows if re.search(r"\w", r[1] or "")])})
    assert near_dup.classes(empty).count() == 0


def test_candidate_recall_at_the_deepest_level(spark):
    """Pairs at 0.8, each alone in buckets that all count as large."""
    rng = np.random.default_rng(1)
    n = 4000
    left = rng.integers(0, 1 << 32, (n, near_dup.TOKENS), np.uint32)
    right = np.where(rng.random(left.shape) < 0.8, left, rng.integers(0, 1 << 32, left.shape, np.uint32))
    rows = [(f"{side}{k:05}".encode(), t.tobytes(), b.tobytes()) for side, tokens in (("a", left), ("b", right)) for k, (t, b) in enumerate(zip(tokens, near_dup.sketches(tokens), strict=True))]
    folder = new_work_dir(spark, "test-recall")
    spark.createDataFrame(rows, "node binary, tokens binary, sketch binary").repartition(8).write.parquet(f"{folder}/nodes")
    nodes = spark.read.parquet(f"{folder}/nodes")
    edges = near_dup.candidate_edges(nodes, folder, 0.8, 0.9999, 1, 5, 8).collect()
    met = {bytes(e.a)[1:] for e in edges if bytes(e.a)[1:] == bytes(e.b)[1:]}
    assert len(met) >= n - 2
    assert near_dup.missed(0.8, near_dup.runs_for(0.8, 0.9999, 5), 5) <= 1e-4


def test_links_of_long_texts_in_blocks_without_nodes(spark):
    base = [f"w{k * k % 7919}" for k in range(900)]
    rows = []
    for n in range(8):
        for copy in range(3):
            words = [f"{w}x{n}" for w in base]
            words[100 * copy + 50] = "changed"
            rows.append((10 * n + copy, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for block_words in (1500, 400):
        got = near_dup.classes(docs, block_words=block_words).select("doc_id", "class_id", "n_links")
        assert Counter(map(tuple, got.collect())) == brute_classes(rows)


def test_toxicity_lexicon_misspelling_and_quotation(spark, empty):
    clean = [f"fine words number {k} and calm talk {k % 7} here" for k in range(60)]
    bad = [f"you w{k} blockhead v{k} go away {k % 5} now" for k in range(60)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(clean + bad)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k >= 60)) for k in range(120)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert "blockhead" in [e.text for e in model.entries] or any("blockhead".startswith(e.text) for e in model.entries)
    only = toxicity.Model((toxicity.Entry("blockhead", False, 0.98, 0.74),), frozenset())
    texts = ["what a blockhead", "what a blokhead", "BLOCKHEAD!", 'she said "blockhead" and left', "a fine day", "", None, "blockhead " + LONG]
    scored = toxicity.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), only)
    got = {r.doc_id: r.score for r in scored.collect()}
    assert [got[k] >= 0.7 for k in range(8)] == [True, True, True, False, False, False, False, True]
    assert toxicity.score(empty, only).count() == 0
    none = toxicity.fit(docs, labels.limit(0))
    assert none.entries == () and toxicity.score(docs, none).where("score >= 0.7").count() == 0
    assert toxicity.keep_clean(docs.withColumn("row", F.lit(1)), only).columns == ["doc_id", "text", "row"]


def test_levenshtein_walk_matches_edit_distance():
    trie = toxicity.Trie((toxicity.Entry("moron", False, 0.9, 0.7), toxicity.Entry("stupid", False, 0.9, 0.7)))
    letters = "abmnorstudip"
    rng = np.random.default_rng(3)
    for _ in range(400):
        word = list(["moron", "stupid"][rng.integers(2)])
        for _ in range(rng.integers(3)):
            k = int(rng.integers(len(word) + 1))
            word[k : k + int(rng.integers(2))] = letters[int(rng.integers(12))] * int(rng.integers(2))
        word = "".join(word)
        best = min(distance(word, e.text) for e in trie.entries)
        found = trie.find(word)
        assert (found[0] if found else 2) == min(best, 2), word


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_language_by_compression(spark, odd, empty):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = queries.remainder("doc_id", 5) == 0
    model = langid.fit(docs.where(~held))
    truth = docs.where(held & (F.length("text") > 100)).select("doc_id", "lang")
    right = langid.predict(docs, model).join(truth, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.97
    got = [(r.doc_id, r.lang_pred) for r in langid.predict(odd, model).collect()]
    assert len(got) == len(ODD) and {p for i, p in got if i in (2, 3, 8)} == {"und"}
    nothing = langid.fit(empty.withColumn("lang", F.lit("en")))
    assert nothing.languages == () and langid.predict(odd, nothing).where("lang_pred <> 'und'").count() == 0


def test_language_with_a_rare_label(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    held = queries.remainder("doc_id", 5) == 0
    truth = docs.where(held & (F.length("text") > 100)).select("doc_id", "lang")

    def right(more):
        rows = spark.createDataFrame([(-1 - k, t, x) for k, (x, t) in enumerate(more)], "doc_id long, text string, lang string")
        model = langid.fit(docs.where(~held).union(rows))
        assert len(model.languages) == 4 + len({x for x, _ in more})
        guesses = langid.predict(truth.join(docs.drop("lang"), "doc_id"), model).join(truth, "doc_id")
        return guesses.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0], model

    plain, _ = right([("qq", "z")])
    rare = "mi luko e lipu suli pi toki pona lon tomo"
    both, model = right([("xx", rare), ("qq", "z")])
    assert plain >= 0.97 and both >= 0.97 and min(len(d) for x, d in zip(model.languages, model.dictionaries) if x not in ("xx", "qq")) > 20_000
    said = langid.predict(spark.createDataFrame([(1, "toki pona li pona, mi luko e lipu suli pi toki pona")], "doc_id long, text string"), model)
    assert said.first().lang_pred == "xx"


def test_url_rules_and_model(spark):
    urls = ["HTTP://A.Example.ORG/es/1?x", "http://example.org/en/12", "http://notexample.org/es/", "http://b.com/fr/x#y", "http://com/de/", "http://x.org", "no scheme", None, "http://n.net/a/://b"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    model = url_filter.train(queries.rule_labels(pages, queries.URL_RULES))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, queries.URL_RULES, model).collect()}
    assert got[0] == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert got[1] == ("example.org", "/en/12", "example.org/en/1", "block")
    assert got[2] == ("notexample.org", "/es/", "org/", "allow")
    assert got[3] == ("b.com", "/fr/x", "com/fr/", "allow") and got[4] == ("com", "/de/", "com/de/", "block")
    assert [got[k][:3] for k in (5, 6, 7, 8)] == [("x.org", "", None), ("", "", None), ("", "", None), ("n.net", "/a/://b", None)]
    assert url_filter.judge(pages.limit(0), queries.URL_RULES, model).count() == 0


def test_wrapper_keeps_the_article_alone(spark):
    page = (
        "<html><head><title>t</title><style>p{{}}</style></head><body><header><h1>Site</h1></header><nav><a href=/>Home</a></nav>"
        "<div class='cookie-notice'>We use cookies</div><div class=c><p>Always the same line here.</p><h2>Title {0}</h2><p>First &amp; <b>bold</b>\n text {0}.<p>Second text {0}"
        "<ul><li>one {0}</li><li>two {0}</ul></div><div id=comments><p>I disagree {0}</p></div><form>Search</form><footer>&copy; 2020</footer><script>var x='<p>no</p>';</script></body></html>"
    )
    rows = [(k, f"http://h.example/{k}", page.format(k)) for k in range(6)] + [(6, "http://h.example/6", None), (7, None, "<p>alone"), (8, "http://z.example/", "<div>" * 3000 + "deep")]
    got = {r.page_id: r.text for r in wrapper.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in range(6):
        assert got[k] == f"Title {k}\nFirst & bold text {k}.\nSecond text {k}\none {k}\ntwo {k}"
    assert (got[6], got[7], got[8]) == ("", "alone", "deep")
    assert wrapper.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_wrapper_names_do_not_empty_a_page(spark):
    text = "The main text of the page is some words longer than all else."
    side = "<div class=sidebar><p>Aside words</p></div><div id=comments><p>I disagree</p></div><div class='cookie-notice'>We use cookies</div>"
    pages = [
        f"<html><body class='no-sidebar'><div class=c><p>{text}</p></div>{side}</body></html>",
        f"<html class='has-sidebar'><body><article><p>{text}</p></article>{side}</body></html>",
        f"<body><div class='content-with-sidebar'><div><p>{text}</p></div>{side}</div>",
        f"<body><div class='footer-widgets'><main><p>{text}</p></main>{side}</div>",
        f"<body><div id='search-results'><article class=post><p>Short</p></article></div><div class=sidebar><p>{text}</p></div>",
        f"<body><div class='page has-header sidebar'><div class=c><p>{text}</p></div>{side}</div>",
        f"<body><div id=sidebar><p>Aside words</p></div><div id=content><p>{text}</p></div>",
        f"<body><aside><article><p>Aside words</p></article></aside><div class=related><article>One</article><article>Two</article></div><div><p>{text}</p></div>",
    ]
    rows = [(k, f"http://h{k}.example/", page) for k, page in enumerate(pages)]
    got = {r.page_id: r.text for r in wrapper.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {k: "Short" if k == 4 else text for k in range(len(pages))}


def test_wrapper_template_of_every_layout(spark):
    """Notices on most pages, two layouts, and empty pages: whichever page is looked at first, all template goes."""
    rows = []
    for k in range(20):
        note = "<div class=info><p>We move house in May.</p></div>" if k % 5 < 3 else ""
        own = f"<h2>Title {k}</h2><p>Text number {k} of the page.</p>"
        first = f"<div class=c><p>Always the same line here.</p>{own}</div><div class=end><p>Written by the team.</p></div>"
        second = f"<section class=d><p>Another line of this layout.</p><div class=x>{own}<p>Shared by the second layout.</p></div></section>"
        rows.append((k, f"http://h.example/{k}", f"<html><body>{note}{second if k % 4 == 0 else first}</body></html>"))
    rows += [(100 + k, f"http://h.example/{k}", ["", None, "<html></html>"][k % 3]) for k in range(30)]
    got = {r.page_id: r.text for r in wrapper.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {k: f"Title {k}\nText number {k} of the page." if k < 100 else "" for k, _, _ in rows}


def test_pipeline_stages_against_brute_force(spark):
    import corpus_pipeline

    documents = spark.read.parquet(f"{SF}/documents.parquet").limit(300)
    stages = dict(corpus_pipeline.STAGES)
    near = stages["near_duplicates"](spark, documents, SF)
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert near.columns == documents.columns and {r.doc_id for r in near.collect()} == {c for _, c, _ in brute_classes(rows)}
    cut = stages["suffix_dedup"](spark, documents, SF)
    assert cut.columns == documents.columns
    assert Counter((r.doc_id, r.n_chars) for r in cut.collect()) == Counter((r.doc_id, len(r.text)) for r in cut.collect())
    assert sum(len(r.text.encode()) for r in cut.collect()) <= sum(k[1] - k[2] for k in brute_repeats(rows).elements())
