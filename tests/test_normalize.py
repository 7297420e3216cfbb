"""Normalisers: Spark column expressions against the rules written out in plain Python."""

import pytest
from registry_analytics.functions.codes import COMPANY_TYPE, CONDITION, SEX, SIZE, STATE, clamp_amount, normalize_code
from registry_analytics.functions.text import blank_to_null, key_form, strip_ws


def py_rule(value, spec):
    if not value:
        return spec.default
    v = value.strip().upper()
    if v in spec.aliases:
        return spec.aliases[v]
    if v in spec.allowed:
        return v
    if spec.first_char_ok and v[:1] in spec.first_char_ok:
        return v[:1]
    return spec.default


CASES = [None, "", "  ", "\t", "activo", " ACTIVO ", "2ACTIVO", "2activo", "10", "99", "INACTIVO", "habido",
         "2HABIDO", "13", "12", "a7", "B9", "AA", "zz", " a ", "CE", "ce", "-", "c", "X", "hombre", "MUJER ",
         " HOMBRE ", "Ñ", "E1"]


@pytest.mark.parametrize("spec", [STATE, CONDITION, COMPANY_TYPE, SEX, SIZE], ids=["state", "cond", "type", "sex", "size"])
def test_normalize_matches_rules(spark, spec):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(CASES)], "i int, v string")
    got = {r.i: r.out for r in df.select("i", normalize_code("v", spec).alias("out")).collect()}
    for i, v in enumerate(CASES):
        assert got[i] == py_rule(v, spec), (v, got[i])


def test_strip_like_python(spark):
    vals = [" a ", "\tb\n", " c ", "d", "", None, "  "]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r[0] for r in df.select(strip_ws("v")).collect()]
    assert got == [None if v is None else v.strip() for v in vals]
    got = [r[0] for r in df.select(blank_to_null("v")).collect()]
    assert got == [None if v is None else (v.strip() or None) for v in vals]
    assert [r[0] for r in df.select(key_form("v")).collect()][:4] == ["A", "B", "C", "D"]


def test_clamp_amount(spark):
    from decimal import Decimal

    df = spark.createDataFrame([(None,), (Decimal("-5.50"),), (Decimal("0"),), (Decimal("12.25"),)], "x decimal(18,2)")
    got = [float(r[0]) for r in df.select(clamp_amount("x")).collect()]
    assert got == [0.0, 0.0, 0.0, 12.25]
    assert df.select(clamp_amount("x")).dtypes[0][1] == "decimal(18,2)"
