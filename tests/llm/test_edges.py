"""Cases at the edges of parameters: many languages, wide ids, little to learn from, copied pages."""

import random

import numpy as np
from pyspark.sql import functions as F

from registry_analytics.llm import langid, queries, token_store, wrapper
from registry_analytics.session import new_work_dir


def made_up_language(i):
    """Words of a few syllables that only this language has."""
    r = random.Random(i)
    syllables = ["".join(r.choice("bcdfghjklmnprstvz") + r.choice("aeiou") for _ in range(2)) for _ in range(40)]
    return lambda n, seed: " ".join("".join(random.Random(seed * 1000 + k).choices(syllables, k=2)) for k in range(n))


def test_six_hundred_languages_predict(spark):
    talk = [made_up_language(i) for i in range(600)]
    taught = [(i, talk[i](60, 1), f"l{i:03}") for i in range(600)]
    model = langid.fit(spark.createDataFrame(taught, "doc_id long, text string, lang string"))
    assert len(model.languages) == 600 > langid.LOT
    asked = [(i, talk[i](30, 2)) for i in range(0, 600, 29)] + [(9000, None), (9001, "12 34")]
    got = {r.doc_id: r.lang_pred for r in langid.predict(spark.createDataFrame(asked, "doc_id long, text string").repartition(2), model).collect()}
    right = sum(got[i] == f"l{i:03}" for i in range(0, 600, 29))
    assert right >= 0.9 * len(range(0, 600, 29)) and got[9000] == got[9001] == "und"


def test_equal_tables_teach_equal_models(spark):
    talk = made_up_language(1)
    rows = [(i % 9, talk(8, i), "x" if i % 2 else "y") for i in range(60)] * 2  # ids and rows repeat
    models = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        models.add(langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5), per_language=7))
    assert len(models) == 1
    small = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), total_bytes=600)
    assert all(0 < len(d) <= 300 for d in small.dictionaries)


def test_store_with_wide_ids_and_little_to_learn_from(spark):
    rows = [(i, f"text number {i}" if i else "") for i in range(12)]
    for end_id, width in ((1, 2), (70_000, 4)):
        folder = new_work_dir(spark, "test-store")
        token_store.write_store(spark.createDataFrame(rows, "doc_id long, text string"), folder, queries.tokenizer_path(), end_id=end_id)
        assert token_store.id_width(queries.tokenizer_path(), end_id) == width
        made = spark.read.parquet(f"{folder}/dictionary").first()
        assert made.kind == "raw" and len(made.bytes) > 0  # too little for the trainer: the samples are the dictionary
        got = {r.doc_id: np.frombuffer(bytes(r.ids), "<u4") for r in token_store.documents(spark, folder).collect()}
        assert len(got) == 12 and all(ids[-1] == end_id for ids in got.values()) and got[0].tolist() == [end_id]
    folder = new_work_dir(spark, "test-store")
    token_store.write_store(spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string"), folder, queries.tokenizer_path())
    assert spark.read.parquet(f"{folder}/dictionary").first().kind == "none"
    assert token_store.documents(spark, folder).count() == 2


ARTICLE = "<article><h1>Title {0}</h1><p>First words of the story {0} that nobody else tells.</p><p>More about {0} at last.</p></article>"


def page(i, side="All about us"):
    return f"<html><body><div>{side}</div>{ARTICLE.format(i)}<div>Printed in town</div></body></html>"


def texts(spark, rows):
    frame = spark.createDataFrame([(i, f"http://h.example/{i}", h) for i, h in rows], "page_id long, url string, html string").repartition(3)
    return {r.page_id: r.text for r in wrapper.extract(frame).collect()}


def story(i):
    return f"Title {i}\nFirst words of the story {i} that nobody else tells.\nMore about {i} at last."


def test_copied_pages_keep_their_article(spark):
    assert texts(spark, [(i, page("x")) for i in range(6)]) == {i: story("x") for i in range(6)}
    mixed = [(i, page("x" if i < 6 else i)) for i in range(10)]
    assert texts(spark, mixed) == {i: story("x" if i < 6 else i) for i in range(10)}
    assert texts(spark, [(1, None), (1, None), (2, ""), (3, page(3)), (3, page(3))]) == {1: "", 2: "", 3: story(3)}


def test_a_copy_counts_once_for_the_template(spark):
    """Without an article element only the counts tell what is template: copies neither make nor unmake it."""
    plain = lambda i: f"<html><body><div>All about us here</div><section><p>Story {i} of its own kind.</p></section><p>Printed in town</p></body></html>"
    rows = [(i, plain(i)) for i in range(5)] + [(10 + i, plain(0)) for i in range(20)]
    got = texts(spark, rows)
    assert set(got.values()) == {f"Story {i} of its own kind." for i in range(5)} and got[19] == got[0]
    weights = wrapper.weighed_pages(spark.createDataFrame([("h", h) for _, h in rows], "host string, html string"), new_work_dir(spark, "test-wrapper"))
    assert weights.agg(F.sum("weight")).first()[0] == 5
