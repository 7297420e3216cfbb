"""Quality rules: a threshold table compiled into one projection of Spark functions.

Counts are built once per text from arrays of its words and lines; the rules are comparisons of
whole numbers, so they have no rounding. No Python runs on the executors.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

#: Fixed values of the contract: white space of words, symbols, words in a window.
SPACE = "\\x20\\x09-\\x0D"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: Frequent short words of the languages covered.
STOP_WORDS = (
    "the of and to in is that was for with it be "
    "der die und das von zu ist mit den ein "
    "le la les de des et que un une est "
    "el los las y en del se por para con"
).split()


class Threshold(NamedTuple):
    """A text fails when ``100 * count`` is below ``low`` or above ``high`` percent of ``total``."""

    name: str
    count: str
    total: str
    low: int | None
    high: int | None


#: Percentages; counts and totals are columns of ``counts``.
RULES = (
    Threshold("word_length", "word_chars", "n_words", 200, 1200),
    Threshold("symbols", "n_symbols", "word_chars", None, 10),
    Threshold("exclamations", "n_exclamations", "n_words", None, 25),
    Threshold("duplicate_lines", "n_dup_lines", "n_lines", None, 50),
    Threshold("stop_words", "n_stop_words", "n_words", 2, None),
    Threshold("separators", "n_separators", "n_words", None, 10),
    Threshold("upper_case", "n_upper", "word_chars", None, 50),
)


def among(text: str, chars: str) -> Column:
    """Code points of a text that are in a character class of ASCII."""
    return F.regexp_count(text, F.lit(f"[{chars}]")).cast("long")


def counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and the counts of each whole text; a null text has none of anything.

    Repeated words: every run of eight words is hashed (64 bits, pairs of pairs of pairs of word hashes). Only where some hash occurs twice, the
    hashes are sorted with their places, equal neighbours mark the places, and a fold adds up the words
    they cover. Stop words are compared as written.
    """
    base = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    base = base.select("doc_id", "text", F.filter(F.split("text", f"[{SPACE}]+"), lambda w: w != "").alias("words"))
    lines = lambda f: f(F.filter(F.split("text", "\n"), lambda x: x.rlike(f"[^{SPACE}]")))
    once = lambda value, f: F.element_at(F.transform(F.array(value), f), 1)  # noqa: E731  # evaluates value once
    n = F.size("words")
    pair = lambda h, gap: F.zip_with(F.slice(h, 1, F.size(h) - gap), F.slice(h, gap + 1, F.size(h)), lambda a, b: F.xxhash64(a, b))
    hashes = F.transform("words", lambda w: F.xxhash64(w))
    windows = F.when(n < WINDOW, F.array().cast("array<bigint>")).otherwise(once(hashes, lambda h: once(pair(h, 1), lambda h2: once(pair(h2, 2), lambda h4: pair(h4, 4)))))
    base = base.select("doc_id", "text", "words", windows.alias("windows"))
    same = lambda s, i, x: F.coalesce(F.get(s, i)["h"] == x["h"], F.lit(False))
    twice = once(
        F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("at")))),
        lambda s: F.sort_array(F.transform(F.filter(s, lambda x, i: same(s, i - 1, x) | same(s, i + 1, x)), lambda x: x["at"])),
    )
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    fold = F.aggregate(
        twice,
        zero,
        lambda acc, at: F.struct((at + WINDOW).alias("end"), (acc["n"] + F.least(F.lit(WINDOW), at + WINDOW - acc["end"])).alias("n")),
        lambda acc: acc["n"],
    )
    covered = F.when(F.size(F.array_distinct("windows")) == F.size("windows"), F.lit(0).cast("long")).otherwise(fold)
    return base.select(
        "doc_id",
        n.cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        among("text", SYMBOLS).alias("n_symbols"),
        lines(lambda x: once(x, lambda y: F.size(y) - F.size(F.array_distinct(y)))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        lines(F.size).cast("long").alias("n_lines"),
        F.size(F.filter("words", lambda w: w.isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.size(F.filter("words", lambda w: w == "|")).cast("long").alias("n_separators"),
        among("text", "!").alias("n_exclamations"),
        among("text", "A-Z").alias("n_upper"),
    )


def fails(rule: Threshold) -> Column:
    count, total = 100 * F.col(rule.count), F.col(rule.total)
    tests = [t for t in (None if rule.low is None else count < rule.low * total, None if rule.high is None else count > rule.high * total) if t is not None]
    return tests[0] if len(tests) == 1 else tests[0] | tests[1]


def judge(docs: DataFrame, rules: tuple[Threshold, ...] = RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: its counts, ``base_failed``, the names of the rules it breaks and ``kept``.

    A null or empty text has no words and fails the base rule. Rows are judged one by one, so null and
    repeated ids change nothing; an empty table gives no rows; other columns are not read.
    """
    found = counts(docs, doc_id, text)
    broken = F.filter(F.array(*(F.when(fails(r), F.lit(r.name)) for r in rules)), lambda x: x.isNotNull()) if rules else F.array().cast("array<string>")
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    judged = found.withColumn("base_failed", base).withColumn("broken_rules", broken)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("broken_rules") == 0))


def judge_sql(rules: tuple[Threshold, ...] = RULES) -> str:
    """The same in DuckDB's SQL."""
    quoted = ", ".join(f"'{w}'" for w in STOP_WORDS)
    tests = " OR ".join(t for r in rules for t in ([f"100 * {r.count} < {r.low} * {r.total}"] if r.low is not None else []) + ([f"100 * {r.count} > {r.high} * {r.total}"] if r.high is not None else []))
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT r, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(text, chr(10)), lambda x: length(regexp_replace(x, '[\x20\x09-\x0D]', '', 'g')) > 0) AS lines
  FROM d
), u AS (
  SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w
), eight AS (
  SELECT r, i, word || {' || '.join(f"' ' || lead(word, {k}) OVER z" for k in range(1, 8))} AS g FROM u WINDOW z AS (PARTITION BY r ORDER BY i)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM eight WHERE g IS NOT NULL) WHERE c > 1
), covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY r
), counts AS (
  SELECT d.doc_id, len(words) AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(list_filter(words, lambda x: list_contains([{quoted}], x))) AS BIGINT) AS n_stop_words,
    CAST(len(list_filter(words, lambda x: x = '|')) AS BIGINT) AS n_separators,
    length(text) - length(replace(text, '!', '')) AS n_exclamations,
    length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_upper
  FROM d JOIN w USING (r) LEFT JOIN covered USING (r)
), judged AS (
  SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
    ({tests or 'false'}) AS rules_failed
  FROM counts
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT rules_failed AS kept
FROM judged"""
