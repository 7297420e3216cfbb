"""Exact arithmetic helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnOrName, _col


def exact_sum(c: ColumnOrName) -> Column:
    """The sum in the amount's own kind: decimals are added, stored and shown exactly."""
    return F.sum(_col(c))


def mean_as_double(c: ColumnOrName) -> Column:
    """sum / count over non-NULL values, as a double; NULL for no values."""
    x = _col(c)
    return F.try_divide(F.sum(x).cast("double"), F.count(x).cast("double"))


def int_mean(c: str) -> Column:
    """Integer average truncated toward zero (T-SQL ``AVG`` of an INT column); exact ``div``."""
    return F.expr(f"CASE WHEN count(`{c}`) > 0 THEN CAST(sum(`{c}`) AS BIGINT) div count(`{c}`) END")


def safe_pct(part: ColumnOrName, total: ColumnOrName) -> Column:
    """part / total * 100 as a double, 0 when total is 0 or NULL."""
    p, t = _col(part).cast("double"), _col(total).cast("double")
    return F.coalesce(F.try_divide(p, t) * F.lit(100.0), F.lit(0.0))
