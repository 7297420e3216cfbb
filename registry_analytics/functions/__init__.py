"""Column expressions: every function maps Column(s) to a Column and stays JVM-side."""

from .text import PY_WHITESPACE, blank_to_null, key_form, left, strip_ws, truncate
from .codes import (
    COMPANY_TYPE,
    CONDITION,
    SEX,
    SIZE,
    STATE,
    CodeSpec,
    clamp_amount,
    normalize_code,
)
from .numbers import safe_pct, exact_sum, mean_as_double, int_mean
from .formats import fmt_count, fmt_count_pct, fmt_money, fmt_years, null_grade

__all__ = [
    "PY_WHITESPACE", "blank_to_null", "key_form", "left", "strip_ws", "truncate",
    "COMPANY_TYPE", "CONDITION", "SEX", "SIZE", "STATE", "CodeSpec", "clamp_amount",
    "normalize_code", "safe_pct", "exact_sum", "mean_as_double",
    "int_mean", "fmt_count", "fmt_count_pct", "fmt_money", "fmt_years", "null_grade",
]
