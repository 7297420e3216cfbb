"""Language identification by compression: the language whose dictionary compresses a text best.

Per language, a raw-content zstandard dictionary is made of a bounded sample of labelled texts. A text
is compressed whole, in blocks, once with each dictionary; the smallest sum of sizes wins. Each language
keeps its own length of dictionary: what a longer one saves on texts of any other language is measured
and taken off the sizes of a shorter one. A narrow margin between the best two rejects the guess.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from .spans import string_bytes, text_slices, worker_cache

UNKNOWN = "und"
#: Bytes compressed at once; short blocks keep the dictionary in play over a whole text.
BLOCK = 4096
#: Texts up to this many bytes are compressed at the slow, finest level.
SHORT = 512
SHORT_LEVEL, LEVEL = 19, 3
#: Languages whose prepared dictionaries a worker holds at once.
LOT = 64
#: One text of so many is kept out of its language's dictionary, to measure on.
HELD_BACK = 20
#: Bits of difference that make the odds of the best against another e to 1.
TEMPERATURE = 16.0
PREDICTIONS = "doc_id long, lang_pred string, score double, margin double, rejected boolean"


class Model(NamedTuple):
    languages: tuple[str, ...]
    dictionaries: tuple[bytes, ...]
    #: Per language, what sizes are multiplied by: of short texts, of others.
    factors: tuple[tuple[float, float], ...]


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = 300, sample_chars: int = 1500, most_bytes: int = 400_000, total_bytes: int = 64_000_000) -> Model:
    """Dictionaries of up to ``most_bytes`` from at most ``per_language`` rows of each language (lowest id hash first) and
    ``sample_chars`` characters of each. All languages together have ``total_bytes``: with many, each has
    fewer rows and bytes, one row at least.

    Rows without text or language teach nothing; an empty table gives a model without languages. Equal
    tables give equal models, in whatever order their rows come.
    """
    labelled = docs.where(F.col(lang).isNotNull() & (F.length(F.trim(F.col(text))) > 0))
    n_languages = max(labelled.select(F.countDistinct(lang)).first()[0], 1)
    most_bytes = min(most_bytes, total_bytes // n_languages)
    per_language = max(1, min(per_language, total_bytes // (n_languages * sample_chars)))
    keys = labelled.select(F.col(doc_id).alias("chosen"), F.col(lang).alias("chosen_lang"))
    rank = F.row_number().over(Window.partitionBy("chosen_lang").orderBy(F.xxhash64("chosen"), "chosen"))
    keys = keys.withColumn("rank", rank).where(F.col("rank") <= per_language).select("chosen", "chosen_lang").distinct()
    # about total_bytes / sample_chars keys, or one a language: broadcasting them is bounded by the parameters
    rows = labelled.join(F.broadcast(keys), (F.col(doc_id) == F.col("chosen")) & (F.col(lang) == F.col("chosen_lang")))
    sample = rows.select(F.col("chosen_lang").alias("lang"), F.col("chosen").alias("doc_id"), F.substring(text, 1, sample_chars).alias("text"))
    # an id may have several rows
    again = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "text"))
    parts: dict[str, list[tuple]] = {}
    for r in sample.withColumn("rank", again).where(F.col("rank") <= per_language).collect():
        parts.setdefault(r.lang, []).append((r.doc_id, r.text))
    languages = tuple(sorted(parts))
    texts = {x: [t.encode() for _, t in sorted(parts[x], key=lambda r: (str(r[0]), r[1]))] for x in languages}
    held = {x: texts[x][::HELD_BACK] if len(texts[x]) >= HELD_BACK else [] for x in languages}
    taught = {x: [t for i, t in enumerate(texts[x]) if not held[x] or i % HELD_BACK] for x in languages}
    dictionaries = tuple(b"\n".join(taught[x])[:most_bytes] for x in languages)
    return Model(languages, dictionaries, length_factors(languages, dictionaries, held))


def length_factors(languages: tuple[str, ...], dictionaries: tuple[bytes, ...], held: dict[str, list[bytes]]) -> tuple[tuple[float, float], ...]:
    """For each dictionary, the mean share of a text's size that is left with one of the longest length, of
    texts in languages other than the dictionary's, so that none wins by its length.

    Measured with the longest dictionaries, cut to powers of two, on ``held`` texts that are in none of them.
    """
    length = [len(d) for d in dictionaries]
    longest = max(length, default=0)
    # the longest few are enough to tell
    full = [i for i in sorted(range(len(length)), key=lambda i: -length[i])[:4] if 2 * length[i] > longest]
    sample = [(x, t) for x in languages for t in held[x][:15]]
    sample = sample[:: max(1, len(sample) // 60)]
    exact = [longest] + [2**k for k in range(3, longest.bit_length()) if 2**k < longest and any(n < 2 ** (k + 1) for n in length)]
    if len(exact) == 1 or not any(languages[i] != x for i in full for x, _ in sample):
        return tuple((1.0, 1.0) for _ in languages)
    curves = []
    for short in (True, False):
        logs = []
        for size in exact:
            ratios = []
            for i in full:
                level = SHORT_LEVEL if short else LEVEL
                whole, cut = compressor(dictionaries[i], level), compressor(dictionaries[i][:size], level)
                for x, t in sample:
                    if x != languages[i]:
                        t = t[: SHORT if short else BLOCK]
                        ratios.append(np.log(len(whole.compress(t)) / len(cut.compress(t))))
            logs.append(min(float(np.mean(ratios)), 0.0) if size < longest else 0.0)
        order = np.argsort(exact)
        curves.append(np.exp(np.interp(np.log(length), np.log(np.array(exact)[order]), np.array(logs)[order])))
    return tuple(zip(*(c.tolist() for c in curves), strict=True))


def compressor(raw: bytes, level: int) -> zstandard.ZstdCompressor:
    """A compressor with a dictionary prepared for ``level``."""
    shared = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    shared.precompute_compress(level=level)
    return zstandard.ZstdCompressor(level=level, dict_data=shared, write_content_size=False, write_checksum=False, write_dict_id=False)


def compressors(model: Model, level: int, lot: range) -> list[zstandard.ZstdCompressor]:
    """One compressor per language of the lot with its dictionary prepared for ``level``; the worker keeps those of the last lot."""
    cache = worker_cache(("langid", hash(model)))
    if cache.get("lot") != lot:
        cache.clear()
        cache["lot"] = lot
    if level not in cache:
        cache[level] = [compressor(model.dictionaries[i], level) for i in lot]
    return cache[level]


def sizes(texts: list[bytes], model: Model) -> np.ndarray:
    """Compressed bytes of each whole text by language, made comparable by the model's factors.

    Languages are taken in lots of ``LOT``, for prepared dictionaries need some megabytes each.
    """
    out = np.zeros((len(texts), len(model.languages)))
    for at in range(0, len(model.languages), LOT):
        lot = range(at, min(at + LOT, len(model.languages)))
        for row, text in enumerate(texts):
            with_each = compressors(model, SHORT_LEVEL if len(text) <= SHORT else LEVEL, lot)
            blocks = [text[i : i + BLOCK] for i in range(0, len(text), BLOCK)]
            out[row, lot.start : lot.stop] = [sum(len(c.compress(b)) for b in blocks) * model.factors[i][len(text) > SHORT] for i, c in zip(lot, with_each, strict=True)]
    return out


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", least_margin: float = 0.01) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, lang_pred, score`` (0 to 1), ``margin`` (share of the second
    best's size saved by the best) and ``rejected`` (margin under ``least_margin``, or no prediction).

    A null text, one without a letter, or a model without languages gives ``und`` with score 0. Ties go
    to the first language by name and are rejected. Other columns are not read.
    """
    names = np.array(model.languages, object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in text_slices(whole, "text"):
                column = part.column("text")
                letters = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_pylist()
                data, offsets = string_bytes(column)
                raw = data.tobytes()
                guesses, scores, margins = [], [], []
                spans = list(zip(letters, offsets[:-1].tolist(), offsets[1:].tolist(), strict=True))
                measured = iter(sizes([raw[a:b] for known, a, b in spans if known], model) if model.languages else [])
                for known, a, b in spans:
                    if not known or not model.languages:
                        guesses.append(UNKNOWN)
                        scores.append(0.0)
                        margins.append(0.0)
                        continue
                    size = next(measured)
                    best = int(size.argmin())
                    other = float(np.delete(size, best).min()) if len(size) > 1 else 2 * float(size[best])
                    blocks = -(-(b - a) // BLOCK)
                    guesses.append(names[best])
                    scores.append(float(1 / np.exp(np.maximum(-8.0 * (size - size[best]) / (TEMPERATURE * blocks), -50)).sum()))
                    margins.append((other - float(size[best])) / max(other, 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(guesses, pa.string()),
                        pa.array(scores, pa.float64()),
                        pa.array(margins, pa.float64()),
                        pa.array([m < least_margin for m in margins], pa.bool_()),
                    ],
                    ["doc_id", "lang_pred", "score", "margin", "rejected"],
                )

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, PREDICTIONS)
