"""URL filters: host and path rules, and a logistic regression on hashed character n-grams for the rest.

The model is trained on the driver from a small labelled URL table of bounded size; pages are judged in
one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .samples import lowest
from .spans import SpanHash, rows_of, string_bytes, text_slices

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GRAMS = (3, 4, 5)
BITS = 16
ALLOW, BLOCK = "allow", "block"


class Rule(NamedTuple):
    """``place`` is a host and a path prefix, like ``example.org/en/1``."""

    verdict: str
    place: str


class Model(NamedTuple):
    weights: np.ndarray
    bias: float


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"\A(?s:.*?)://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"\A(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def fits(rule: Rule, host: Column, path: Column) -> Column:
    name, slash, rest = rule.place.partition("/")
    return ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)


def longest_rule(rules: list[Rule], host: Column, path: Column) -> Column:
    """The place of the longest rule that fits, or null; of equal lengths the first by name."""
    tests = [F.when(fits(r, host, path), F.lit(r.place)) for r in sorted(rules, key=lambda r: (-len(r.place), r.place))]
    return F.coalesce(*tests) if tests else F.lit(None).cast("string")


def gram_slots(column: pa.Array, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, slot) of every n-gram of bytes of a string column."""
    data, offsets = string_bytes(column)
    rows, slots = [], []
    if len(data):
        spans = SpanHash(data)
        row = rows_of(np.arange(len(data)), offsets)
        for n in GRAMS:
            at = np.arange(max(len(data) - n + 1, 0))
            at = at[at + n <= offsets[row[at] + 1]]
            rows.append(row[at])
            slots.append(((spans(at, at + n) ^ np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(slots).astype(np.int64)


def features(host: pa.Array, path: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, slot, value): n-grams of host and path apart, each row scaled to length one."""
    parts = [gram_slots(host, 1), gram_slots(path, 2)]
    row, slot = (np.concatenate(x) for x in zip(*parts, strict=True))
    count = np.bincount(row, minlength=len(host)) if len(row) else np.zeros(len(host))
    return row, slot, 1 / np.sqrt(np.maximum(count, 1))[row]


def score(model: Model, host: pa.Array, path: pa.Array) -> np.ndarray:
    row, slot, value = features(host, path)
    z = np.bincount(row, weights=model.weights[slot] * value, minlength=len(host)) + model.bias
    return 1 / (1 + np.exp(-z))


def train(labelled: DataFrame, most_rows: int = 20_000, steps: int = 150, rate: float = 8.0, ridge: float = 1e-4) -> Model:
    """Fit on at most ``most_rows`` different rows (lowest hash first) of ``url, blocked``; both labels weigh the same.

    Rows without url or label are left out, and rows of equal host, path and label count once; a table with
    one label or none gives weights of zero and a bias that allows.
    """
    rows = labelled.where(F.col("url").isNotNull() & F.col("blocked").isNotNull()).select("blocked", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    held = lowest(rows, ("host", "path"), most_rows).toArrow().combine_chunks()
    target = np.array(held.column("blocked").to_pylist(), np.float64)
    weights, bias = np.zeros(1 << BITS), 0.0
    share = target.mean() if len(target) else 0.0
    if not 0 < share < 1:
        return Model(weights, -1.0)
    whole = [c.chunk(0) if c.num_chunks else pa.array([], pa.string()) for c in (held.column("host"), held.column("path"))]
    row, slot, value = features(*whole)
    weight = np.where(target > 0, 0.5 / share, 0.5 / (1 - share)) / len(target)
    for _ in range(steps):
        z = np.bincount(row, weights=weights[slot] * value, minlength=len(target)) + bias
        error = (1 / (1 + np.exp(-z)) - target) * weight
        weights -= rate * (np.bincount(slot, weights=error[row] * value, minlength=len(weights)) + ridge * weights)
        bias -= rate * error.sum()
    return Model(weights, float(bias))


def judge(pages: DataFrame, rules: list[Rule], model: Model, page_id: str = "page_id", url: str = "url", threshold: float = 0.5) -> DataFrame:
    """One row per row of ``pages``: ``page_id, host, path, rule`` (the longest that fits, or null),
    ``blocked_score`` (the model's, for every row) and ``verdict`` (the rule's, else the model's).

    A null url, or one without ``://``, has an empty host and path: no rule fits and the model judges by
    its bias. Rows are judged one by one; an empty table gives no rows; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in text_slices(whole, "path"):
                found = score(model, part.column("host"), part.column("path"))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found)], [*part.schema.names, "blocked_score"])

    parts = pages.select(F.col(page_id).cast("long").alias("page_id"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    scored = parts.mapInArrow(run, "page_id long, host string, path string, blocked_score double")
    ruled = scored.withColumn("rule", longest_rule(rules, F.col("host"), F.col("path")))
    verdicts = F.coalesce(*[F.when(F.col("rule") == r.place, F.lit(r.verdict)) for r in rules], F.when(F.col("blocked_score") >= threshold, F.lit(BLOCK)).otherwise(F.lit(ALLOW)))
    return ruled.withColumn("verdict", verdicts)
