"""Text helpers with Python ``str.strip()`` semantics, run as built-in Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Characters Python's str.strip() removes (those with str.isspace()), built by rule.
# Spark's trim() removes only the blank, so a tab or NBSP would survive it.
PY_WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: ColumnOrName) -> Column:
    """Remove leading and trailing whitespace (tab, NBSP, ... included)."""
    return F.btrim(_col(c), F.lit(PY_WHITESPACE))


def blank_to_null(c: ColumnOrName) -> Column:
    """``x.strip() or None``: stripped text, NULL when empty or NULL."""
    return F.nullif(strip_ws(c), F.lit(""))


def key_form(c: ColumnOrName) -> Column:
    """Normal form for case-insensitive, blank-insensitive key equality."""
    return F.upper(strip_ws(c))


def left(c: ColumnOrName, n: int) -> Column:
    """First ``n`` characters (T-SQL ``LEFT``)."""
    return F.substring(_col(c), 1, n)


def truncate(c: ColumnOrName, n: int) -> Column:
    """Cut a label to ``n`` characters (used after grouping, for display)."""
    return F.substring(_col(c), 1, n)
