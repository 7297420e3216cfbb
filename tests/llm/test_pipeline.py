"""The whole pipeline against its stages done by hand."""

import re
import zlib
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from registry_analytics.llm import queries, toxicity

from .test_operators import brute_classes, ids_of

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def without_repeats(rows, length=50):
    """Texts without the bytes of strings that also start in a smaller document; halves of characters go."""
    first = {}
    for i, t in rows:
        raw = t.encode()
        for k in range(len(raw) - length + 1):
            first[raw[k : k + length]] = min(first.get(raw[k : k + length], i), i)
    out = []
    for i, t in rows:
        raw, gone = t.encode(), set()
        for k in range(len(raw) - length + 1):
            if first[raw[k : k + length]] < i:
                gone.update(range(k, k + length))
        out.append((i, bytes(c for k, c in enumerate(raw) if k not in gone).decode("utf-8", "ignore")))
    return out


def test_run_against_stages_by_hand(spark, tmp_path):
    import corpus_pipeline

    labels, benchmark = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("labels", "benchmark"))
    documents = spark.read.parquet(f"{SF}/documents.parquet").where(F.length("text") < 20_000)
    toxic = documents.join(labels.where("toxic = 1").select("doc_id"), "doc_id", "left_semi")
    documents.where("doc_id < 220").union(toxic.where("doc_id >= 220")).select(documents.columns).write.parquet(f"{tmp_path}/documents.parquet")
    for name, frame in (("labels", labels), ("benchmark", benchmark)):
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    documents = spark.read.parquet(f"{tmp_path}/documents.parquet")
    rows = sorted((r.doc_id, r.text or "") for r in documents.collect())

    # the lexicon is learned, so its scores are the operator's own; all that follows is plain Python
    scores = {r.doc_id: r.score for r in toxicity.score(documents, toxicity.fit(documents, labels)).collect()}
    clean = [(i, t) for i, t in rows if scores[i] < 0.7]
    classes = {c for _, c, _ in brute_classes(clean)}
    single = [(i, t) for i, t in clean if i in classes]
    windows = set()
    for r in benchmark.collect():
        item = words(r.text)
        windows.update(tuple(item[k : k + 10]) for k in range(max(len(item) - 9, min(len(item), 1))))
    sizes = {len(w) for w in windows}
    left = {}
    for i, t in without_repeats(single):
        own = words(t)
        if not any(tuple(own[k : k + n]) in windows for n in sizes for k in range(len(own) - n + 1)):
            left[i] = t
    assert len(rows) > len(clean) > len(single) > len(left) > 0

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    ids = {i: ids_of(tokenizer, t) for i, t in left.items()}
    pieces = defaultdict(list)
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == zlib.crc32(part.tobytes())
        pieces[r.doc_id].append((r.start, r.length))
    assert set(pieces) == set(ids)
    for i, found in pieces.items():
        assert sum(n for _, n in found) == len(ids[i])
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(found), sorted(found)[1:]))


def test_batches_of_wide_rows_are_bounded_by_bytes(spark):
    import corpus_pipeline

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "bytes"])

    corpus_pipeline.small_batches(spark)
    wide = spark.range(0, 600, 1, 1).select(F.repeat(F.lit("x"), 50_000).cast("binary").alias("payload"))
    found = wide.mapInArrow(sizes, "n long, bytes long").collect()
    assert sum(r.n for r in found) == 600
    assert max(r.bytes for r in found) <= corpus_pipeline.BATCH_BYTES + 100_000  # the row that reaches the bound is in the batch
