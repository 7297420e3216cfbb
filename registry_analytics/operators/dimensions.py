"""Lookup tables: grow from data, insert rows that are absent."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import key_form


def distinct_values(source: DataFrame, col: str, case_insensitive: bool = True) -> DataFrame:
    """Distinct non-NULL values of ``col`` as ``(_k, _v)``.

    Case-insensitive mode merges values equal under the normal form
    (``Chimbote`` = ``CHIMBOTE``) and keeps the smallest spelling, so the result
    does not depend on row order.  Exact distinct spellings come first (a hash
    aggregate with map-side combine: one row per spelling and partition
    crosses the shuffle); the smallest spelling per normal form is then ranked
    over that small set (a ``min`` over strings would be planned as a sort
    aggregate over every source row).
    """
    spellings = source.select(F.col(col).alias("_v")).filter(F.col("_v").isNotNull()).distinct()
    keyed = spellings.withColumn("_k", key_form("_v") if case_insensitive else F.col("_v"))
    if not case_insensitive:
        return keyed
    w = Window.partitionBy("_k").orderBy("_v")
    return keyed.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def grow_dimension(
    existing: DataFrame,
    source: DataFrame,
    source_col: str,
    key_col: str,
    build: Mapping[str, Column],
    case_insensitive: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """``INSERT INTO dim SELECT DISTINCT ... WHERE v NOT IN (SELECT key FROM dim)``.

    ``build`` maps each new dimension column to an expression of ``_v`` (the
    source value).  Returns ``(grown, added)``.  The anti join is NULL-safe
    (unlike ``NOT IN``, a NULL key in ``existing`` does not empty the result).
    """
    values = distinct_values(source, source_col, case_insensitive)
    have = existing.select((key_form(key_col) if case_insensitive else F.col(key_col)).alias("_k"))
    added = values.join(have, "_k", "left_anti").select(*[e.alias(n) for n, e in build.items()])
    grown = existing.unionByName(added, allowMissingColumns=True)
    return grown, added


def insert_if_absent(
    target: DataFrame,
    rows: DataFrame,
    key: str,
    known_keys: Sequence | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``IF NOT EXISTS (SELECT 1 FROM target WHERE key = ...) INSERT``.

    When the keys are constants of the caller (``known_keys``), the presence
    test is a literal ``IN`` filter that Catalyst pushes down to the scan of
    ``target`` (through projections and key-partitioned windows).  Otherwise the
    keys of ``rows`` are semi-joined; AQE broadcasts whichever side it observes
    to be small.  Returns ``(target_with_new_rows, inserted)``.
    """
    if known_keys is not None:
        present = target.select(key).filter(F.col(key).isin(*known_keys)).distinct()
    else:
        present = target.select(key).join(rows.select(key).distinct(), key, "left_semi").distinct()
    inserted = rows.join(present, key, "left_anti")
    return target.unionByName(inserted, allowMissingColumns=True), inserted
