"""Code normalisation: dirty registry codes -> catalogue codes, as CASE expressions."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnOrName, _col, strip_ws


@dataclass(frozen=True)
class CodeSpec:
    """How one code column is cleaned.

    NULL or empty -> ``default``; otherwise the value is stripped and upper-cased,
    then an alias is replaced, an allowed value is kept, a value whose first
    character is in ``first_char_ok`` becomes that character, anything else
    becomes ``default``.
    """

    allowed: tuple[str, ...]
    default: str
    aliases: dict[str, str] = field(default_factory=dict)
    first_char_ok: tuple[str, ...] = ()


# The catalogue codes and repairs the registry accepts.
STATE = CodeSpec(
    allowed=("ACTIVO", "10", "11", "3", "2", "1", "12", "INACTIVO"),
    default="ND",
    aliases={"2ACTIVO": "ACTIVO"},
)
CONDITION = CodeSpec(
    allowed=("HABIDO", "1", "2", "3", "4", "5", "6", "7", "8", "9", "10", "11", "12"),
    default="ND",
    aliases={"2HABIDO": "HABIDO"},
)
COMPANY_TYPE = CodeSpec(
    allowed=("A", "B", "C", "D", "E", "CE", "-"),
    default="-",
    first_char_ok=("A", "B", "C", "D", "E"),
)
SEX = CodeSpec(allowed=("HOMBRE", "MUJER"), default="ND")
SIZE = CodeSpec(allowed=("C", "M", "G", "B"), default="C")


def normalize_code(c: ColumnOrName, spec: CodeSpec, v: Column | None = None) -> Column:
    """Clean one code column according to ``spec`` (one CASE, codegen-friendly).

    ``v`` may carry ``upper(strip(c))`` already computed in an earlier projection,
    so the CASE does not repeat it in every branch.
    """
    raw = _col(c)
    v = F.upper(strip_ws(raw)) if v is None else v
    expr = F.when(raw.isNull() | (raw == F.lit("")), F.lit(spec.default))
    for dirty, clean in spec.aliases.items():
        expr = expr.when(v == F.lit(dirty), F.lit(clean))
    expr = expr.when(v.isin(*spec.allowed), v)
    if spec.first_char_ok:
        first = F.substring(v, 1, 1)
        expr = expr.when(first.isin(*spec.first_char_ok), first)
    return expr.otherwise(F.lit(spec.default))


def clamp_amount(c: ColumnOrName) -> Column:
    """NULL -> 0, negative -> 0; a decimal(18,2) input stays decimal(18,2)."""
    x = _col(c)
    return F.greatest(F.coalesce(x, F.lit(0)), F.lit(0))
