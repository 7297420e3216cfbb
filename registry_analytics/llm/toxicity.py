"""Toxicity scores: a learned lexicon, matched with one misspelling, weighed by its context.

The lexicon is a trie of terms (whole words) and stems (beginnings of words) that labelled toxic texts
have and others lack. A word's Levenshtein automaton is intersected with the trie, so a walk visits only
the branches that one edit can reach. Each distinct word of a batch is looked up once. Around a hit, a
window of the text tells a quoted or reported term from abuse and scales its weight.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .spans import BASE, SpanHash, mix, rows_of, runs, string_bytes, text_slices, tidy, worker_cache

SCORES = "doc_id long, score double, hits array<struct<word:string,entry:string,weight:double>>"
#: Shortest entry that may be misspelled, and stem lengths.
MISSPELL_FROM = 5
STEM_LENGTHS = (3, 4, 5, 6, 7)
#: Weight of a term inside quotation marks, and next to a word of reporting or mention.
QUOTED, REPORTED = 0.3, 0.4
#: Characters of context on each side of a hit.
WINDOW = 40
#: Words that report or mention speech.
REPORTING = re.compile(r"\b(said|says|quote[ds]?|called|wrote|the (?:word|term|phrase)|dit|mot|sagte|wort|dijo|palabra)\b", re.IGNORECASE)
QUOTES = {'"': '"', "“": "”", "„": "“", "«": "»", "‘": "’"}
#: Score of a text without a hit.
BASE_SCORE = 0.02
#: Distinct words that a worker keeps answers for.
CACHE = 1_000_000

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256), *map(ord, "@$*")]] = True
_EDGE = np.zeros(256, bool)
_EDGE[list(map(ord, "@$*"))] = True


class Entry(NamedTuple):
    """A term or stem with the share of toxic texts among those that have it, and among those that have a misspelling of it."""

    text: str
    stem: bool
    exact: float
    misspelled: float


class Model(NamedTuple):
    entries: tuple[Entry, ...]
    clean: frozenset[str]


def lower_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes, starts, ends) of words: letters, digits, non-ASCII characters and @ $ * inside."""
    low = _FOLD[data]
    if len(low) > 1:  # the capital letters of two bytes from 0xC3
        capital = (low[:-1] == 0xC3) & (low[1:] >= 0x80) & (low[1:] <= 0x9E) & (low[1:] != 0x97)
        low[1:][capital] += 0x20
    start, end = runs(_WORD[low], offsets)
    while len(start):
        head = _EDGE[low[start]]
        tail = _EDGE[low[end - 1]]
        if not (head | tail).any():
            break
        start, end = start + head, end - tail
        full = start < end
        start, end = start[full], end[full]
    return low, start, end


class Trie:
    """Entries by letters; a node is (children, entry index or None, whether it is a stem's end)."""

    def __init__(self, entries: tuple[Entry, ...]):
        self.entries = entries
        self.root: tuple[dict, list] = ({}, [])
        for i, entry in enumerate(entries):
            node = self.root
            for letter in entry.text:
                node = node[0].setdefault(letter, ({}, []))
            node[1].append(i)

    def find(self, word: str) -> tuple[int, int] | None:
        """(edits, entry) of the closest entry within one edit; of equals the one that weighs most, whole terms first."""
        best: tuple | None = None
        entries = self.entries
        n = len(word)
        # states of the word's automaton: place in the word -> fewest edits, at most one
        stack = [(self.root, {0: 0, 1: 1} if n else {0: 0})]
        while stack:
            (children, ends), states = stack.pop()
            for i in ends:
                entry = entries[i]
                if entry.stem:
                    edits = min(states.values())
                else:
                    edits = min((e + n - at for at, e in states.items()), default=2)
                if edits and (edits > 1 or len(entry.text) < MISSPELL_FROM):
                    continue
                key = (edits, entry.stem, -(entry.misspelled if edits else entry.exact), entry.text)
                if best is None or key < best[0]:
                    best = (key, i)
            for letter, child in children.items():
                after: dict[int, int] = {}
                for at, e in states.items():
                    if at < n and word[at] == letter:
                        after[at + 1] = min(after.get(at + 1, 2), e)
                    if e == 0:
                        if at < n:
                            after[at + 1] = min(after.get(at + 1, 2), 1)  # another letter
                        after[at] = min(after.get(at, 2), 1)  # a letter of the entry left out
                        if at + 1 < n and word[at + 1] == letter:
                            after[at + 2] = min(after.get(at + 2, 2), 1)  # a letter too many
                if after:
                    stack.append((child, after))
        return None if best is None else (best[0][0], best[1])


def lookup(word: str, trie: Trie, clean: frozenset[str]) -> tuple[float, int] | None:
    """(weight, entry) of a word, or None."""
    found = trie.find(word)
    if found is None:
        return None
    edits, i = found
    if (edits or trie.entries[i].stem) and word in clean:
        return None
    return (trie.entries[i].misspelled if edits else trie.entries[i].exact), i


def context_weight(text: str, start: int, end: int) -> float:
    """1 for plain use; less inside quotation marks or near a word of reporting."""
    before, after = text[max(0, start - WINDOW) : start], text[end : end + WINDOW]
    for open_, close in QUOTES.items():
        left = before.rpartition(open_)
        if left[1] and close not in left[2] and close in after:
            return QUOTED
    return REPORTED if REPORTING.search(before) or REPORTING.search(after[: WINDOW // 2]) else 1.0


def wilson(hits: Column, total: Column, z: float = 2.0) -> Column:
    """Lower bound of a share."""
    p = hits / total
    return (p + z * z / (2 * total) - z * F.sqrt((p * (1 - p) + z * z / (4 * total)) / total)) / (1 + z * z / total)


def forms(labelled: DataFrame, clean_weight: float = 1.0) -> DataFrame:
    """``form, toxic, seen, total``: for each word, the distinct pairs of neighbours that it has in toxic texts and in all,
    and in ``total`` those of clean texts count ``clean_weight`` times.

    Counting neighbours instead of texts keeps the words of one often copied text from looking frequent.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("toxicity forms")
        for whole in batches:
            for part in text_slices(whole, "text"):
                data, offsets = string_bytes(part.column("text"))
                low, start, end = lower_words(data, offsets)
                if not len(start):
                    continue
                toxic = part.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
                words = SpanHash(low)(start, end)
                row = rows_of(start, offsets)
                inside = row[1:] == row[:-1]  # a text's first and last word have one neighbour
                before, after = np.zeros(len(words), np.uint64), np.zeros(len(words), np.uint64)
                before[1:], after[:-1] = np.where(inside, words[:-1], 0), np.where(inside, words[1:], 0)
                near = mix(before * BASE + after)
                bad = toxic[row]
                _, keep = np.unique(mix(near ^ words) + bad.astype(np.uint64), return_index=True)
                keep = keep[(end - start)[keep] >= 3]
                raw = low.tobytes()
                names = [raw[a:b].decode("utf-8", "replace") for a, b in zip(start[keep].tolist(), end[keep].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(near[keep].view(np.int64)), pa.array(bad[keep])], ["form", "near", "toxic"])

    found = labelled.mapInArrow(tidy(run), "form string, near long, toxic long").groupBy("form", "near").agg(F.max("toxic").alias("toxic"))
    total = F.sum("toxic") + F.lit(float(clean_weight)) * (F.count("*") - F.sum("toxic"))
    return found.groupBy("form").agg(F.sum("toxic").alias("toxic"), F.count("*").alias("seen"), total.alias("total"))


def label_weights(rows: dict[int, int], most_rows: int) -> tuple[float, float]:
    """(how many times as many labelled rows a clean row of the sample stands for as a toxic one, the clean rows' share of
    the sample over their share of the labels), for ``rows`` of each label; both 1 unless toxic rows are over-represented."""
    clean, toxic = rows.get(0, 0), rows.get(1, 0)
    taken_clean, taken_toxic = min(clean, most_rows), min(toxic, most_rows)
    if clean * taken_toxic <= toxic * taken_clean or not toxic:
        return 1.0, 1.0
    return clean * taken_toxic / (taken_clean * toxic), taken_clean * (clean + toxic) / (clean * (taken_clean + taken_toxic))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic", most_rows: int = 5_000, most_entries: int = 5_000, least_share: float = 0.7) -> Model:
    """Learn the lexicon from at most ``most_rows`` labelled rows of each label (lowest id hash first) and keep
    the ``most_entries`` most frequent entries.

    Where that leaves fewer of the clean rows than of the toxic ones, clean ones count for those left out: else half the
    sample is toxic, and words that say nothing look half toxic. Rows without id, text or label teach nothing; without
    toxic rows the lexicon is empty.
    """
    keys = labels.select(F.col(doc_id).alias("chosen"), F.col(toxic).cast("int").alias("toxic")).where("chosen IS NOT NULL AND toxic IN (0, 1)").distinct()
    picked = [keys.where(F.col("toxic") == x).orderBy(F.xxhash64("chosen"), "chosen").limit(most_rows) for x in (0, 1)]
    # at most 2 x most_rows rows of two numbers: broadcasting them is bounded
    chosen = F.broadcast(picked[0].union(picked[1]))
    sample = docs.where(F.col(text).isNotNull()).join(chosen, F.col(doc_id) == F.col("chosen")).select(F.col(text).alias("text"), "toxic")
    clean_weight, room = label_weights({r.toxic: r["count"] for r in keys.groupBy("toxic").count().collect()}, most_rows)  # two rows
    counted = forms(sample, clean_weight).persist()
    try:
        share = wilson(F.col("toxic"), F.col("seen"))
        # evidence of the sample, whose base share is higher by as much as its room for clean rows is less; then the weighed share
        toxic_enough = (share >= 1 - (1 - least_share) * room) & (F.col("toxic") >= least_share * F.col("total"))
        terms = counted.where((F.length("form") >= 3) & (F.col("toxic") >= 5) & toxic_enough).select("form", F.lit(False).alias("stem"), "toxic", "total")
        cut = F.explode(F.filter(F.array(*(F.when(F.length("form") > n, F.substring("form", 1, n)) for n in STEM_LENGTHS)), lambda x: x.isNotNull()))
        stems = counted.select(cut.alias("stem_text"), "toxic", "seen", "total").groupBy("stem_text").agg(F.sum("toxic").alias("toxic"), F.sum("seen").alias("seen"), F.sum("total").alias("total"), F.count("*").alias("forms"))
        stems = stems.where((F.col("forms") >= 3) & (F.col("toxic") >= 10) & (share >= 1 - (1 - 0.8) * room) & (F.col("toxic") >= 0.9 * F.col("total"))).select(F.col("stem_text").alias("form"), F.lit(True).alias("stem"), "toxic", "total")
        rows = terms.union(stems).orderBy(F.desc("toxic"), "form", "stem").limit(most_entries).collect()
        stems_seen = [r for r in rows if r.stem]
        # of nested stems, a longer and no less toxic one that keeps most of the evidence says more
        vague = {r.form for r in stems_seen for x in stems_seen if len(x.form) > len(r.form) and x.form.startswith(r.form) and x.toxic >= 0.7 * r.toxic and x.toxic * r.total >= r.toxic * x.total}
        rows = [r for r in rows if not (r.stem and r.form in vague)]
        kept: list = []
        for r in sorted(rows, key=lambda r: (len(r.form), r.form)):  # a stem covers what it begins
            if not any(k.stem and r.form.startswith(k.form) for k in kept):
                kept.append(r)
        exact = tuple(Entry(r.form, r.stem, (r.toxic + 0.2) / (r.total + 0.4), 0.0) for r in kept)
        return misspellings(counted, exact)
    finally:
        counted.unpersist()


def misspellings(counted: DataFrame, entries: tuple[Entry, ...], most_clean: int = 100_000) -> Model:
    """Weigh each entry's misspellings by those that the labelled texts hold; forms of stems and misspellings that are clean there are left out."""
    if not entries:
        return Model((), frozenset())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(entries)
        for batch in batches:
            found = [(i, f) for i, f in ((i, trie.find(w)) for i, w in enumerate(batch.column("form").to_pylist())) if f and (f[0] or entries[f[1]].stem)]
            part = batch.take(pa.array([i for i, _ in found], pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([f[x] for _, f in found], pa.int32()) for x in (1, 0)] + part.columns, ["entry", "edits", *part.schema.names])

    near = counted.select("form", "toxic", "total").mapInArrow(tidy(run), "entry int, edits int, form string, toxic long, total double").persist()
    try:
        sums = {r.entry: r for r in near.where("edits > 0").groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("total").alias("total")).collect()}  # a row per entry
        clean = frozenset(r.form for r in near.where("2 * toxic < total").orderBy(F.desc("total"), "form").limit(most_clean).collect())
    finally:
        near.unpersist()
    weighed = []
    for i, e in enumerate(entries):
        r = sums.get(i)
        weighed.append(e._replace(misspelled=e.exact * (0.75 * 4 + (r.toxic if r else 0)) / (4 + (r.total if r else 0))))
    return Model(tuple(weighed), clean)


def held_in(run: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which ``values`` are in the sorted ``run``."""
    if not len(run):
        return np.zeros(len(values), bool)
    return run[np.minimum(np.searchsorted(run, values), len(run) - 1)] == values


class Seen:
    """Hashes of the words a worker has looked up, as sorted runs: a run joins the one before it while that is less than
    twice as long, so a hash is merged a logarithmic number of times, however many were seen before."""

    def __init__(self):
        self.runs: list[np.ndarray] = []

    @property
    def size(self) -> int:
        return sum(map(len, self.runs))

    def has(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(values), bool)
        for run in self.runs:
            out |= held_in(run, values)
        return out

    def add(self, new: np.ndarray) -> None:
        """``new`` values, sorted, none of them seen before."""
        if len(new):
            self.runs.append(new)
        while len(self.runs) > 1 and len(self.runs[-2]) < 2 * len(self.runs[-1]):
            last = self.runs.pop()
            self.runs[-1] = np.sort(np.concatenate([self.runs[-1], last]), kind="stable")

    def clear(self) -> None:
        self.runs.clear()


def rate(part: pa.RecordBatch, model: Model) -> tuple[np.ndarray, list[list[dict]]]:
    """(score, hits) of each row's ``text``. A worker keeps the trie and its answers for distinct words."""
    cache = worker_cache(("toxicity", hash(model)))
    if not cache:
        cache.update(trie=Trie(model.entries), seen=Seen(), answers={}, known=np.zeros(0, np.uint64))
    trie, seen, answers = cache["trie"], cache["seen"], cache["answers"]
    data, offsets = string_bytes(part.column("text"))
    low, start, end = lower_words(data, offsets)
    hits: list[list] = [[] for _ in range(part.num_rows)]
    left_over = np.full(part.num_rows, math.log1p(-BASE_SCORE))
    if len(start) and model.entries:
        hashes = SpanHash(low)(start, end)
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        new = ~seen.has(distinct)
        raw, texts = low.tobytes(), data.tobytes()
        if seen.size + new.sum() > CACHE:
            seen.clear()
            answers.clear()
            new[:] = True
        held = len(answers)
        for h, f in zip(distinct[new].tolist(), first[new].tolist(), strict=True):
            found = lookup(raw[start[f] : end[f]].decode("utf-8", "replace"), trie, model.clean)
            if found:
                answers[h] = found
        seen.add(distinct[new])
        if len(answers) != held or len(cache["known"]) != held:
            cache["known"] = np.sort(np.fromiter(answers, np.uint64, len(answers)))
        here = np.flatnonzero(held_in(cache["known"], distinct)[inverse])
        strongest: dict[tuple[int, str], tuple[float, int]] = {}
        for k, r in zip(here.tolist(), rows_of(start[here], offsets).tolist(), strict=True):
            a, b = int(start[k]), int(end[k])
            left, right = max(int(offsets[r]), a - 4 * WINDOW), min(int(offsets[r + 1]), b + 4 * WINDOW)
            before, own, after = (texts[x:y].decode("utf-8", "ignore") for x, y in ((left, a), (a, b), (b, right)))
            weight, entry = answers[int(hashes[k])]
            weight *= context_weight(before + own + after, len(before), len(before) + len(own))
            word = (r, raw[a:b].decode("utf-8", "replace"))
            if weight > strongest.get(word, (0.0, 0))[0]:
                strongest[word] = (weight, entry)
        for (r, word), (weight, entry) in strongest.items():
            left_over[r] += math.log1p(-min(weight, 0.999))
            hits[r].append({"word": word, "entry": model.entries[entry].text, "weight": weight})
    return -np.expm1(left_over), hits


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, score`` (0 to 1) and ``hits`` (distinct words, their entries, weight in context).

    Hits combine as independent evidence: one minus the product of what each leaves. A word's weight is
    that of its plainest use. A text without hits, empty or null, has the base score. Rows are scored one
    by one, so null and repeated ids change nothing; an empty table gives no rows; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("word", pa.string()), ("entry", pa.string()), ("weight", pa.float64())]))
        for whole in batches:
            for part in text_slices(whole, "text"):
                scores, hits = rate(part, model)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores), pa.array(hits, kind)], ["doc_id", "score", "hits"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(tidy(run), SCORES)


def keep_clean(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score under ``threshold``, all columns as they were; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in text_slices(whole, "text"):
                yield pa.RecordBatch.from_arrays([part.column("row").filter(pa.array(rate(part, model)[0] < threshold))], ["row"])

    whole = docs.select(F.col(text).alias("text"), F.struct("*").alias("row"))
    return whole.mapInArrow(tidy(run), T.StructType([whole.schema["row"]])).select("row.*")
