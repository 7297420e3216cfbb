"""Display text for the long-form results (``valor_texto``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnOrName, _col


def fmt_count(c: ColumnOrName) -> Column:
    """``f"{n:,}"`` for an integer count."""
    return F.format_number(_col(c).cast("bigint"), 0)


def fmt_money(c: ColumnOrName, prefix: str = "S/ ") -> Column:
    """``f"S/ {x:,.2f}"``."""
    return F.concat(F.lit(prefix), F.format_number(F.coalesce(_col(c), F.lit(0)), 2))


def one_decimal(c: Column) -> Column:
    """``f"{x:.1f}"``: the double's exact value, ties to the even digit (Java's ``%.1f`` rounds ties up)."""
    return F.replace(F.format_number(c.cast("double"), 1), F.lit(","), F.lit(""))


def fmt_count_pct(n: ColumnOrName, pct: ColumnOrName) -> Column:
    """``f"{n:,} ({p:.1f}%)"``."""
    return F.concat(fmt_count(n), F.lit(" ("), one_decimal(_col(pct)), F.lit("%)"))


def fmt_years(c: ColumnOrName) -> Column:
    """``f"{x:.1f} años"``."""
    return F.concat(one_decimal(F.coalesce(_col(c).cast("double"), F.lit(0.0))), F.lit(" años"))


def null_grade(pct: ColumnOrName, ok_below: float = 1.0, warn_below: float = 10.0) -> Column:
    """Grade of a NULL share: ``ok`` below 1 %, ``warn`` below 10 %, else ``bad``."""
    p = _col(pct)
    return F.when(p < ok_below, F.lit("ok")).when(p < warn_below, F.lit("warn")).otherwise(F.lit("bad"))
