"""Versioned tables: a failed write changes nothing, readers keep their version; exact sums in the results store; the load gate."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from registry_analytics.plans.catalog import QUERIES
from registry_analytics.plans.fixture import raw_text_rows
from registry_analytics.plans.jobs import ANALYSIS_NAMES, open_registry, run_all, run_registry_from_csv, text_registry_for
from registry_analytics.schemas import RAW_COLUMNS
from registry_analytics.session import new_work_dir
from registry_analytics.sources.files import write_csv
from registry_analytics.sources.results import load_results
from registry_analytics.sources.versions import add_data, append_rows, commit, current, manifest, read_version, replace_table
from tests.test_analyses import fact

SF = "/root/testdata/sf0.001"


def failing(df):
    """Some rows are written before a task fails."""
    return df.withColumn("x", F.when(F.col("id") == 90, F.raise_error(F.lit("stop")).cast("bigint")).otherwise(F.col("id")))


def test_a_write_that_fails_half_way_leaves_the_old_table(spark):
    root = new_work_dir(spark, "test-versions")
    replace_table(spark.range(10).withColumn("x", F.col("id")), root)
    before = read_version(spark, root)
    with pytest.raises(Exception, match="stop"):
        replace_table(failing(spark.range(0, 100, 1, 8)), root)
    with pytest.raises(Exception, match="stop"):
        append_rows(failing(spark.range(0, 100, 1, 8)), root)
    assert read_version(spark, root).count() == 10 and manifest(spark, root).count() == 1
    replace_table(spark.range(3).withColumn("x", F.col("id")), root)
    assert before.count() == 10  # a frame stays with its version
    assert read_version(spark, root).count() == 3 and read_version(spark, root, version=1).count() == 10
    append_rows(spark.range(4).withColumn("x", F.col("id")), root)
    assert read_version(spark, root).count() == 7 and current(spark, root)["table"][0] == 3
    with pytest.raises(FileNotFoundError):
        read_version(spark, root, "other")


def test_tables_change_together_and_may_be_empty(spark):
    root = new_work_dir(spark, "test-versions")
    empty = add_data(spark.range(0).withColumn("part", F.lit("a")), root, ["part"])
    rows = add_data(spark.range(5), root)
    assert current(spark, root) == {}
    commit(spark, root, {"none": empty, "some": rows})
    assert read_version(spark, root, "none").columns == ["id", "part"] and read_version(spark, root, "none").count() == 0
    assert read_version(spark, root, "some").count() == 5


def test_writes_change_no_session_setting(spark):
    name = "spark.sql.maxConcurrentOutputFileWriters"
    seen = []
    f = fact(spark, [dict(deuda=Decimal("1.00"))])
    run_all(f, new_work_dir(spark, "test-results"))
    seen.append(spark.conf.get(name))
    assert seen == ["0"] and spark.conf.get("spark.sql.sources.partitionOverwriteMode").upper() == "STATIC"


def test_stored_sums_keep_their_cents(spark):
    """Two hundred million million and a cent: beyond what a double holds to the cent."""
    amount = Decimal("9007199254740993.01")
    f = fact(spark, [dict(deuda=amount), dict(deuda=Decimal("200000000000000.55"))])
    path = new_work_dir(spark, "test-results")
    run_all(f, path)
    stored = {r.metrica: (r.valor_numerico, r.valor_texto) for r in load_results(spark, path, ANALYSIS_NAMES["A2"]).collect()}
    total = amount + Decimal("200000000000000.55")
    assert stored["deuda_total"] == (total, f"S/ {total:,.2f}")
    assert stored["deuda_maxima"] == (amount, f"S/ {amount:,.2f}")
    assert stored["deuda_mediana"][0] == Decimal("200000000000000.55")


def test_an_analysis_saved_without_rows_is_empty(spark):
    path = new_work_dir(spark, "test-results")
    f = fact(spark, [dict(deuda=Decimal("1.00"))])
    run_all(f, path, only=("A1", "C1"))
    run_all(f.limit(0), path, only=("A1",))
    assert load_results(spark, path, ANALYSIS_NAMES["A1"]).count() == 0
    assert load_results(spark, path, ANALYSIS_NAMES["C1"]).count() == 1


def test_load_counts_equal_counting(spark):
    reg = text_registry_for(spark, SF)
    stats = {r.stage: r.n for r in QUERIES["l1_load_stats"](spark, SF).collect()}
    rows = read_version(spark, reg.root, "staging")
    assert stats["read"] == rows.count() and stats["staged"] == reg.staging.count()
    assert stats["migrated"] == reg.fact.count() and stats["rejected"] == reg.rejected.count()
    reasons = {r.reason: r["count"] for r in rows.where("reason IS NOT NULL").groupBy("reason").count().collect()}
    assert reasons and all(stats[k] == n for k, n in reasons.items())


def test_csv_job_loads_once(spark):
    folder = new_work_dir(spark, "test-csv")
    write_csv(raw_text_rows(spark, SF).select(*RAW_COLUMNS), folder)
    root = new_work_dir(spark, "test-gate")
    reg, results = run_registry_from_csv(spark, folder, root)
    assert reg.timings and load_results(spark, results).count() > 0
    again, _ = run_registry_from_csv(spark, "/nonexistent", root)  # the gate comes before the file is read
    assert again.timings is None and again.fact.count() == reg.fact.count() == open_registry(spark, root).fact.count()
    version = current(spark, root)["checked"][0]
    run_registry_from_csv(spark, folder, root, min_rows=10**9)
    assert current(spark, root)["checked"][0] == version + 1


def test_every_rule_is_broken_by_some_row(spark):
    from registry_analytics.plans.lookups import seed_lookups
    from registry_analytics.plans.migrate import fact_rules

    found = {r.rule: r.n for r in QUERIES["m4_rules_before_cleaning"](spark, "/root/testdata/sf0.01").collect()}
    _, rules = fact_rules(seed_lookups(spark), reg_rows(spark))
    assert set(found) == {r.name for r in rules} and all(n > 0 for n in found.values())


def reg_rows(spark):
    return text_registry_for(spark, SF).fact
