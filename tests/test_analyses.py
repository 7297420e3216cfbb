"""Analyses and reports on hand-made facts: ties, labels, empty input, clean totals."""

from decimal import Decimal

from registry_analytics.plans import analyses as A
from registry_analytics.plans import reports as R
from registry_analytics.plans.lookups import seed_lookups
from registry_analytics.schemas import FACT


def fact(spark, rows):
    base = dict(ruc=None, id_ciiu="5211", id_tipo_empresa="A", id_tamano="C", id_ubicacion="CHIMBOTE",
                id_estado="ACTIVO", id_condicion="HABIDO", sexo="MUJER", edad=30, deuda=Decimal("0.00"), flag22="HABIDO")
    return spark.createDataFrame([tuple({**base, **r, "ruc": 10000 + i}[f.name] for f in FACT.fields)
                                  for i, r in enumerate(rows)], FACT)


def test_empty_input_gives_zeros_or_no_rows(spark):
    f = fact(spark, [])
    assert A.state_profile(f).count() == 0
    s = A.debt_stats(f).first()
    assert s.debtors == 0 and s.debt_total == 0.0 and s.debt_median == 0.0 and s.debtors_pct == 0.0
    assert A.age_bands(f).count() == 0
    assert [r.nulls for r in A.null_columns(f).collect()] == [0] * 6
    d = A.default_codes(f).first()
    assert d.total == 0 and d.clean_total == 0
    assert R.summary(f).first().debt_avg == 0.0


def test_top_k_ties_broken_by_key(spark):
    rows = [dict(id_ubicacion=p) for p in ["B", "B", "A", "A", "C"]]
    got = [r.id_ubicacion for r in A.top_places(fact(spark, rows), k=2).collect()]
    assert got == ["A", "B"]


def test_case_insensitive_places(spark):
    rows = [dict(id_ubicacion=p) for p in ["Chimbote", "CHIMBOTE", "chimbote ", "Santa"]]
    f = fact(spark, rows)
    assert A.top_places(f).count() == 4
    ci = A.top_places(f, case_sensitive=False).collect()
    assert [(r.id_ubicacion, r.n) for r in ci] == [("CHIMBOTE", 3), ("SANTA", 1)]


def test_labels_collide_but_rows_stay_apart(spark):
    rows = [dict(id_tipo_empresa="CE"), dict(id_tipo_empresa="C"), dict(id_tipo_empresa="Q")]
    got = {r.id_tipo_empresa: r.label for r in A.type_profile(fact(spark, rows)).collect()}
    assert got == {"CE": "Cooperativa", "C": "Cooperativa", "Q": "Q"}


def test_clean_total_counts_double_defaults_twice(spark):
    rows = [dict(id_estado="ND", id_condicion="ND"), dict(), dict(id_estado="ND")]
    d = A.default_codes(fact(spark, rows)).first()
    assert (d.total, d.nd_estado, d.nd_condicion, d.clean_total, d.clean_total_exact) == (3, 2, 1, 0, 1)


def test_age_bands_share_of_all_rows(spark):
    rows = [dict(edad=e) for e in [None, 0, 25, 35, 35, 80]]
    got = {r.age_band: (r.n, round(r.share_pct, 4)) for r in A.age_bands(fact(spark, rows)).collect()}
    assert got == {"< 30 años": (1, 16.6667), "30-39 años": (2, 33.3333), "70+ años": (1, 16.6667)}


def test_sector_rollup(spark):
    rows = [dict(id_ciiu="5211"), dict(id_ciiu="5212", id_estado="ND"), dict(id_ciiu="1511"),
            dict(id_ciiu="7010"), dict(id_ciiu="5510"), dict(id_ciiu="9999")]
    got = {(r.sector, r.metric): r.value for r in A.sector_counts(fact(spark, rows)).collect()}
    assert got == {("SECTOR_52xx", "total"): 2, ("SECTOR_52xx", "activos"): 1,
                   ("SECTOR_15xx", "total"): 1, ("SECTOR_70_55xx", "total"): 2}


def test_reports_by_description_and_int_mean(spark):
    rows = [dict(id_estado="ACTIVO", deuda=Decimal("1.50")), dict(id_estado="10", deuda=Decimal("2.00")),
            dict(sexo="HOMBRE", edad=31), dict(sexo="HOMBRE", edad=30)]
    lk = seed_lookups(spark)
    got = {r.estado: (r.n, r.debt_total) for r in R.by_state(fact(spark, rows), lk).collect()}
    assert got == {"Contribuyente Activo": (3, 1.5), "Baja Temporal": (1, 2.0)}
    sex = {r.sexo: r.age_avg for r in R.by_sex(fact(spark, rows)).collect()}
    assert sex == {"HOMBRE": 30, "MUJER": 30}


def test_approx_distinct_option(spark):
    rows = [dict(id_ubicacion="A", id_ciiu=str(1000 + i % 40)) for i in range(200)]
    exact = A.top_places(fact(spark, rows)).first().activities
    approx = A.top_places(fact(spark, rows), approx_distinct=True).first().activities
    assert exact == 40 and abs(approx - 40) <= 4


def test_missing_keys_show_nd_or_question_mark(spark):
    from pyspark.sql import functions as F

    f = fact(spark, [dict(), dict()]).withColumn("id_tamano", F.lit(None).cast("string")) \
        .withColumn("id_ubicacion", F.lit(None).cast("string"))
    assert [r.label for r in A.size_profile(f).collect()] == ["?"]
    assert [r.place_label for r in A.top_places(f).collect()] == ["ND"]
