"""Bounded samples against a plain sort, and the url model against a dense loop."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from registry_analytics.llm import url_filter
from registry_analytics.llm.samples import lowest


def test_lowest_rows_against_a_plain_sort(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 2500).alias("k"), (F.col("id") % 2).alias("x"))
    hashed = sorted({(r.h, r.k, r.x) for r in rows.select(F.xxhash64("k").alias("h"), "k", "x").collect()})
    for most in (1, 40, 1700, 10_000):
        got = [(r.k, r.x) for r in lowest(rows, ("k",), most).collect()]
        assert got == [(k, x) for _, k, x in hashed[:most]]
    assert lowest(rows.limit(0), ("k",), 5).count() == 0


def test_few_copied_rows_are_all_found(spark):
    """One row has nearly all copies: the share of the hash range is found all the same."""
    rows = spark.range(20_000).select(F.least(F.col("id"), F.lit(12)).alias("k"))
    assert sorted(r.k for r in lowest(rows, ("k",), 10).collect()) == sorted(r.k for r in rows.distinct().orderBy(F.xxhash64("k"), "k").limit(10).collect())


def dense(hosts, paths):
    """A row per url and a column per slot: n-grams counted one by one, rows of length one by their number."""
    out = np.zeros((len(hosts), 1 << url_filter.BITS))
    for i, parts in enumerate(zip(hosts, paths, strict=True)):
        n_grams = 0
        for salt, part in enumerate(parts, 1):
            raw = part.encode()
            for n in url_filter.GRAMS:
                for at in range(len(raw) - n + 1):
                    # the longest gram of a text of its own length
                    _, slots = url_filter.gram_slots(pa.array([raw[at : at + n].decode()]), salt)
                    out[i, slots[-1]] += 1
                    n_grams += 1
        out[i] /= np.sqrt(max(n_grams, 1))
    return out


def test_url_regression_against_a_dense_loop(spark):
    urls = [(f"http://{h}.example/{p}/{k}", b) for k in range(6) for h, p, b in (("news", "en/story", False), ("spam", "win/now", True), ("shop", "en/win", k % 2 == 0))]
    urls += [(urls[1][0], True)] * 30 + [(None, True), ("http://x.example/", None)]
    model = url_filter.train(spark.createDataFrame(urls, "url string, blocked boolean").repartition(5), steps=40)
    different = sorted({(u, b) for u, b in urls if u is not None and b is not None})
    hosts, paths = zip(*((u.split("/")[2], "/" + u.split("/", 3)[3]) for u, _ in different), strict=True)
    x, y = dense(hosts, paths), np.array([b for _, b in different], float)
    weight = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / len(y)
    w, bias = np.zeros(x.shape[1]), 0.0
    for _ in range(40):
        error = (1 / (1 + np.exp(-(x @ w + bias))) - y) * weight
        w, bias = w - 8.0 * (error @ x + 1e-4 * w), bias - 8.0 * error.sum()
    assert np.allclose(model.weights, w, atol=1e-9) and abs(model.bias - bias) < 1e-9
    asked = ["http://spam.example/win/9", "http://news.example/en/story/9", "http://new.example/"]
    got = url_filter.judge(spark.createDataFrame(list(enumerate(asked)), "page_id long, url string"), [], model).collect()
    want = 1 / (1 + np.exp(-(dense(*zip(*((u.split("/")[2], "/" + u.split("/", 3)[3]) for u in asked), strict=True)) @ w + bias)))
    assert np.allclose([r.blocked_score for r in sorted(got, key=lambda r: r.page_id)], want) and [r.verdict for r in sorted(got, key=lambda r: r.page_id)][:2] == ["block", "allow"]
