"""Declared data-quality rules as column predicates, and the valid / rejected split.

A rule passes when its predicate is true **or NULL**, like a SQL CHECK
constraint.  The names of all rules a row breaks are collected in one array
column, so a row breaking two rules is reported under both.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import key_form


@dataclass(frozen=True)
class Rule:
    name: str
    check: Column


def broken_rules(rules: Sequence[Rule]) -> Column:
    """``array<string>`` of the names of the rules whose check is false."""
    return F.array_compact(F.array(*[F.when(~r.check, F.lit(r.name)) for r in rules]))


def split_valid(df: DataFrame, rules: Sequence[Rule], flag_col: str = "broken_rules") -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)``; rejected rows carry ``flag_col`` with the broken rule names."""
    flagged = df.withColumn(flag_col, broken_rules(rules))
    valid = flagged.filter(F.size(flag_col) == 0).drop(flag_col)
    rejected = flagged.filter(F.size(flag_col) > 0)
    return valid, rejected


def rule_counts(rejected: DataFrame, flag_col: str = "broken_rules", count_col: str = "n") -> DataFrame:
    """Rows per broken rule (a row breaking two rules counts under both)."""
    return (
        rejected.select(F.explode(flag_col).alias("rule"))
        .groupBy("rule")
        .agg(F.count(F.lit(1)).alias(count_col))
    )


def code_values(df: DataFrame, columns: Mapping[str, Column | str]) -> DataFrame:
    """``(name, value, n)``: the different non-NULL values of each named column and their rows, in one scan.

    Every row gives one pair per column to a partial aggregate, so what is
    shuffled is one row per value and task.
    """
    pairs = [F.struct(F.lit(name).alias("name"), (F.col(c) if isinstance(c, str) else c).cast("string").alias("value"))
             for name, c in columns.items()]
    found = df.select(F.inline(F.array(*pairs))).filter(F.col("value").isNotNull())
    return found.groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))


def unknown_values(values: DataFrame, dims: Mapping[str, tuple[DataFrame, str]], case_insensitive: bool = True) -> DataFrame:
    """The rows of ``values`` (``name, value, ...``) whose value is no key of its lookup ``(dim, key)``.

    Values and keys compare by normal form; both sides have a row per code, not per fact row.
    """
    form = key_form if case_insensitive else F.col
    keys = None
    for name, (dim, key) in dims.items():
        own = dim.select(F.lit(name).alias("_name"), form(key).alias("_key"))
        keys = own if keys is None else keys.union(own)
    same = (F.col("name") == F.col("_name")) & (form("value") == F.col("_key"))
    return values.join(keys, same, "left_anti")


def fk_rules(
    df: DataFrame,
    fks: Sequence[tuple[str, str, DataFrame, str]],
    case_insensitive: bool = True,
    unknown: DataFrame | None = None,
) -> tuple[DataFrame, list[Rule]]:
    """Foreign-key rules ``(rule_name, fk_col, dim, dim_key)``.

    The different codes are checked against the lookups, once each; rows take
    the flag of their code as it is spelt, by a join with the codes that failed.
    ``unknown`` (``name`` = rule, ``value``) gives those codes where the caller
    has stored them; otherwise they are found from ``df``.  The helper flag
    columns start with ``_fk`` (drop them after the split).  A NULL foreign key
    passes, as in SQL.
    """
    if unknown is None and fks:
        values = code_values(df, {name: col for name, col, _, _ in fks})
        unknown = unknown_values(values, {name: (dim, key) for name, _, dim, key in fks}, case_insensitive)
    rules = []
    for i, (name, fk_col, _, _) in enumerate(fks):
        bad = unknown.filter(F.col("name") == name).select(F.col("value").alias(f"_fkk{i}"), F.lit(True).alias(f"_fk{i}"))
        df = df.join(bad, F.col(fk_col) == F.col(f"_fkk{i}"), "left").drop(f"_fkk{i}")
        rules.append(Rule(name, F.col(f"_fk{i}").isNull()))
    return df, rules


def orphan_counts(df: DataFrame, fks: Sequence[tuple[str, str, DataFrame, str]], case_insensitive: bool = True) -> DataFrame:
    """``(fk, orphans)``: rows whose code is no key of its lookup, for every rule; no join of the rows themselves."""
    values = code_values(df, {name: col for name, col, _, _ in fks})
    unknown = unknown_values(values, {name: (dim, key) for name, _, dim, key in fks}, case_insensitive)
    wide = unknown.agg(*[F.coalesce(F.sum(F.when(F.col("name") == name, F.col("n"))), F.lit(0)).alias(name) for name, *_ in fks])
    stacked = ", ".join(f"'{name}', `{name}`" for name, *_ in fks)
    return wide.selectExpr(f"stack({len(fks)}, {stacked}) AS (fk, orphans)")


def drop_fk_flags(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_fk")])
