"""Results store: replace one analysis, keep the others; chart reduction."""

from decimal import Decimal

from pyspark.sql import functions as F

from registry_analytics.plans.jobs import ANALYSIS_NAMES, run_all
from registry_analytics.session import new_work_dir
from registry_analytics.sources.results import category_max, load_results
from tests.test_analyses import fact


def test_replace_one_analysis(spark):
    f = fact(spark, [dict(id_estado="ACTIVO", deuda=Decimal("5.00")), dict(id_estado="ND")])
    path = new_work_dir(spark, "test-results")
    run_all(f, path)
    before = load_results(spark, path).groupBy("nombre_analisis").count().collect()
    assert len(before) == len(ANALYSIS_NAMES)
    run_all(f.filter(F.col("id_estado") == "ND"), path, only=("A1",))
    a1 = load_results(spark, path, ANALYSIS_NAMES["A1"]).collect()
    assert {r.categoria for r in a1} == {"ND"}
    after = {r.nombre_analisis: r["count"] for r in load_results(spark, path).groupBy("nombre_analisis").count().collect()}
    assert after[ANALYSIS_NAMES["C1"]] == {r.nombre_analisis: r["count"] for r in before}[ANALYSIS_NAMES["C1"]]
    texts = {r.metrica: r.valor_texto for r in load_results(spark, path, ANALYSIS_NAMES["A2"]).collect()}
    assert texts["deuda_total"] == "S/ 5.00" and texts["con_deuda"] == "1"


def test_category_max(spark):
    df = spark.createDataFrame([("a", "m1", 1.0), ("a", "m2", 3.0), ("b", "m1", None), ("b", "m2", 2.0)],
                               "categoria string, metrica string, valor_numerico double")
    got = {r.categoria: r.max_valor for r in category_max(df).collect()}
    assert got == {"a": 3.0, "b": 2.0}
