"""Property test: the normaliser CASE equals the plain-Python rule on arbitrary text."""

from hypothesis import given, settings
from hypothesis import strategies as st

from registry_analytics.functions.codes import COMPANY_TYPE, CONDITION, SEX, SIZE, STATE, normalize_code
from tests.test_normalize import py_rule

ALPHABET = st.sampled_from(list("ACDEHIMNOBGV-2 \t abcehimo0123456789"))
TEXT = st.one_of(st.none(), st.text(ALPHABET, max_size=9),
                 st.sampled_from(["2ACTIVO", " activo ", "2habido", "ce", "A7", "hombre", "\tmujer"]))


@settings(max_examples=25, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=40))
def test_normalizers_match_python(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    specs = {"s": STATE, "c": CONDITION, "t": COMPANY_TYPE, "x": SEX, "z": SIZE}
    rows = df.select("i", *[normalize_code("v", sp).alias(k) for k, sp in specs.items()]).collect()
    for r in rows:
        for k, sp in specs.items():
            assert r[k] == py_rule(values[r.i], sp), (values[r.i], k)
