"""Invariants of the load job and the reports, and a key holding a third of all rows."""

import hashlib

from pyspark.sql import functions as F

from registry_analytics.plans import analyses as A
from registry_analytics.plans.fixture import dirty_staging
from registry_analytics.plans.jobs import build_registry, text_registry_for
from registry_analytics.plans.migrate import candidates
from registry_analytics.sources.versions import read_version

SF = "/root/testdata/sf0.01"


def test_load_counts_add_up(spark):
    reg = text_registry_for(spark, SF)
    parsed = read_version(spark, reg.root, "staging")
    read = parsed.count()
    staged = parsed.filter(F.col("reason").isNull()).count()
    quarantined = parsed.filter(F.col("reason").isNotNull()).count()
    assert read == staged + quarantined and staged == reg.staging.count()
    required = ["ddp_ciiu", "ddp_tpoemp", "ddp_tamano", "ddp_ubigeo", "ddp_estado", "ddp_flag22"]
    filtered = reg.staging.filter(
        (F.col("ddp_numruc") < 10000) | F.greatest(*[F.col(c).isNull() for c in required])).count()
    n_cand = candidates(reg.staging).count()
    assert staged == n_cand + filtered
    dedup = candidates(reg.staging).select("ddp_numruc").distinct().count()
    duplicates = n_cand - dedup
    assert duplicates > 0
    special_in = (reg.fact.filter(F.col("ruc") == 611077).count()
                  + reg.rejected.filter(F.col("ruc") == 611077).count())
    assert dedup + special_in == reg.fact.count() + reg.rejected.count()


def test_group_counts_sum_to_total(spark):
    reg = text_registry_for(spark, SF)
    total = reg.fact.count()
    for df in [A.state_profile(reg.fact), A.size_profile(reg.fact), A.type_profile(reg.fact), A.sex_profile(reg.fact)]:
        assert df.agg(F.sum("n")).first()[0] == total
        assert abs(df.agg(F.sum("share_pct")).first()[0] - 100.0) < 1e-9 if "share_pct" in df.columns else True


def _digest(df):
    rows = sorted(repr(tuple(r)) for r in df.collect())
    return hashlib.sha1("\n".join(rows).encode()).hexdigest()


def test_second_run_gives_the_same_fact(spark):
    a = build_registry(spark, dirty_staging(spark, "/root/testdata/sf0.001"))
    b = build_registry(spark, dirty_staging(spark, "/root/testdata/sf0.001"))
    assert a.root != b.root
    assert _digest(a.fact) == _digest(b.fact) and _digest(a.rejected) == _digest(b.rejected)


def test_hot_key_holds_a_third_of_the_rows(spark):
    """One key on a third of the staging rows: its first candidate row wins, other keys kept once."""
    hot_key = 50_000_000
    st = dirty_staging(spark, "/root/testdata/sf0.01")
    hot = st.withColumn("ddp_numruc", F.when(F.col("seq") % 3 == 0, F.lit(hot_key)).otherwise(
        F.col("seq") + F.lit(100_000)))
    assert hot.filter(F.col("ddp_numruc") == hot_key).count() * 3 >= hot.count()
    reg = build_registry(spark, hot)
    cand = candidates(reg.staging)
    winner = cand.filter(F.col("ddp_numruc") == hot_key).orderBy("seq").first()
    out = reg.fact.unionByName(reg.rejected.drop("broken_rules"))
    got = out.filter(F.col("ruc") == hot_key).collect()
    assert len(got) == 1
    assert (got[0].id_ciiu, got[0].edad, got[0].id_ubicacion) == (winner.ddp_ciiu, winner.dds_edad, winner.ddp_ubigeo)
    other_keys = cand.filter(F.col("ddp_numruc") != hot_key).select("ddp_numruc").distinct().count()
    kept_others = out.filter((F.col("ruc") != hot_key) & (F.col("ruc") != 611077)).count()
    assert kept_others == other_keys
