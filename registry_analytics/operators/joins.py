"""Joins against small lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import key_form


def lookup_label(code: Column | str, labels: Mapping[str, str]) -> Column:
    """Code -> label from a literal dictionary, falling back to the code itself.

    A literal map lookup runs inside codegen; no join and no shuffle.
    """
    c = F.col(code) if isinstance(code, str) else code
    m = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    return F.coalesce(F.try_element_at(m, c), c)


@dataclass
class Dim:
    """One star arm: ``fact.fk_col = dim.dim_key`` (by normal form when ``case_insensitive``)."""

    df: DataFrame
    fk_col: str
    dim_key: str
    columns: Mapping[str, str]  # output name -> dim column
    small: bool = False  # size fixed by construction (seeded literal rows) -> broadcast hint
    case_insensitive: bool = True


def star_join(fact: DataFrame, dims: Sequence[Dim], fact_columns: Mapping[str, str], how: str = "inner") -> DataFrame:
    """Join the fact to every dimension and project renamed columns.

    Seeded dimensions are broadcast by hint; dimensions grown from data are
    left to AQE, which broadcasts them when their observed size is small and
    falls back to a sort-merge join otherwise.
    """
    out = fact.select(*[F.col(src).alias(f"_f_{name}") for name, src in fact_columns.items()],
                      *[F.col(d.fk_col).alias(f"_fk{i}") for i, d in enumerate(dims)])
    for i, d in enumerate(dims):
        proj = [(key_form(d.dim_key) if d.case_insensitive else F.col(d.dim_key)).alias(f"_dk{i}")]
        proj += [F.col(src).alias(f"_d{i}_{name}") for name, src in d.columns.items()]
        side = d.df.select(*proj)
        side = F.broadcast(side) if d.small else side
        lhs = key_form(f"_fk{i}") if d.case_insensitive else F.col(f"_fk{i}")
        out = out.join(side, lhs == F.col(f"_dk{i}"), how)
    names = [F.col(f"_f_{n}").alias(n) for n in fact_columns]
    for i, d in enumerate(dims):
        names += [F.col(f"_d{i}_{n}").alias(n) for n in d.columns]
    return out.select(*names)
