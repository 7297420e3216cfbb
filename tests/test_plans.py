"""Physical-plan shape: the scale properties the design relies on."""

import contextlib
import io
import re

from pyspark.sql import functions as F

from registry_analytics.operators.dedup import first_wins
from registry_analytics.operators.dimensions import insert_if_absent
from registry_analytics.plans import analyses as A
from registry_analytics.plans import reports as R
from registry_analytics.plans.catalog import QUERIES
from registry_analytics.plans.jobs import registry_for
from registry_analytics.plans.migrate import SPECIAL_ROWS
from registry_analytics.schemas import FACT

SF = "/root/testdata/sf0.01"


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def tree(df):
    """The operator tree of the formatted plan, top to bottom."""
    text = plan(df)
    return text.split("\n\n")[0]


def test_dedup_limits_rows_per_key_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("o"))
    t = tree(first_wins(df, "k", ["o"]))
    lines = [ln for ln in t.splitlines() if "WindowGroupLimit" in ln or "Exchange" in ln]
    # bottom-up: a partial WindowGroupLimit sits below the Exchange
    assert "WindowGroupLimit" in lines[-1] and any("Exchange" in ln for ln in lines[:-1])


def test_fact_scans_are_pruned(spark):
    fact = registry_for(spark, SF).fact
    p = plan(A.state_profile(fact))
    assert "PartitionFilters: [isnotnull(status" in p and "(status" in p
    schema = re.search(r"ReadSchema: struct<([^>]*)>", p).group(1)
    assert sorted(re.findall(r"(\w+):", schema)) == ["deuda", "id_estado"]
    assert "HashAggregate" in p and "SortAggregate" not in p


def test_reports_use_hash_aggregates_and_top_k(spark):
    fact = registry_for(spark, SF).fact
    for df in [A.top_places(fact), A.top_places(fact, case_sensitive=False), A.top_activities(fact)]:
        p = plan(df)
        assert "SortAggregate" not in p and "TakeOrderedAndProject" in p


def test_lookup_growth_aggregates_before_ranking(spark):
    p = tree(QUERIES["g1_grow_places"](spark, SF))
    assert "SortAggregate" not in p
    lines = p.splitlines()
    window = max(i for i, ln in enumerate(lines) if "Window" in ln)
    agg = max(i for i, ln in enumerate(lines) if "HashAggregate" in ln)
    assert agg > window  # the hash aggregate is below (after, top-down) the window


def test_description_reports_aggregate_before_joining(spark):
    reg = registry_for(spark, SF)
    lines = tree(R.by_state(reg.fact, reg.lookups)).splitlines()
    join = min(i for i, ln in enumerate(lines) if "Join" in ln)
    assert any("HashAggregate" in ln for ln in lines[join + 1:])


def test_seeded_lookups_are_broadcast(spark):
    p = plan(QUERIES["s1_star"](spark, SF))
    assert p.count("BroadcastHashJoin") >= 3


def test_special_row_key_filter_reaches_the_scan(spark):
    fact = registry_for(spark, SF).fact
    special = spark.createDataFrame(SPECIAL_ROWS, FACT)
    _, inserted = insert_if_absent(fact, special, "ruc", known_keys=[r[0] for r in SPECIAL_ROWS])
    p = plan(inserted)
    # one key: Catalyst turns the IN into an equality; either reaches the parquet scan
    assert re.search(r"PushedFilters: \[[^\]]*(In\(ruc, \[611077\]\)|EqualTo\(ruc,611077\))", p)


def test_analysis_pack_is_one_bounded_rollup(spark):
    spark.catalog.clearCache()  # plans of cached frames would show in-memory scans instead
    fact = registry_for(spark, SF).fact
    fine = tree(A.pack_rollup(fact))
    assert fine.count("Scan parquet") == 1 and fine.count("Exchange") == 1
    assert "Expand" not in fine and "SortAggregate" not in fine
    pack = A.analysis_pack(fact)
    try:
        for name in ("A1", "C1", "C2", "E1", "E2", "A2", "D2", "F1", "F2", "R1"):
            p = tree(pack[name])
            assert "InMemoryTableScan" in p and "Expand" not in p, name
        assert pack["_fine"].count() <= 9 * 4 * 7 * 3 * 7
    finally:
        pack["_fine"].unpersist()


def test_percentiles_order_no_values(spark):
    p = plan(A.debt_stats(registry_for(spark, SF).fact))
    assert "Window" not in p and "Sort" not in p


def test_star_joins_stored_keys_without_an_exchange(spark):
    for name in ("s1_star", "r9_sql_star_by_state"):
        p = plan(QUERIES[name](spark, SF))
        below = tree(QUERIES[name](spark, SF))
        assert "upper(" not in p and "btrim(" not in p, name
        joins = [ln for ln in below.splitlines() if "Join" in ln]
        assert len(joins) == 6 and all("BroadcastHashJoin" in ln for ln in joins), name
        last = max(i for i, ln in enumerate(below.splitlines()) if "Join" in ln)
        assert not any("Exchange" in ln and "Broadcast" not in ln for ln in below.splitlines()[last:]), name


def test_foreign_keys_need_no_join_above_the_fact_exchange(spark):
    lines = tree(QUERIES["m1_migrate"](spark, SF)).splitlines()
    first = next(i for i, ln in enumerate(lines) if "Exchange" in ln and "Broadcast" not in ln)  # of the rows, by key
    assert not any("Join" in ln for ln in lines[:first])
    lines = tree(QUERIES["q1_orphans"](spark, SF)).splitlines()
    scan = next(i for i, ln in enumerate(lines) if "Scan parquet" in ln)
    join = max(i for i, ln in enumerate(lines) if "Join" in ln)
    assert any("HashAggregate" in ln for ln in lines[join + 1:scan])  # codes are counted before they are joined


def test_lookups_grow_from_one_staging_scan(spark):
    from registry_analytics.plans.lookups import grow_lookups, seed_lookups, staged_codes

    staging = registry_for(spark, SF).staging
    assert tree(staged_codes(staging)).count("Scan parquet") == 1
    lookups, _ = grow_lookups(staging, seed_lookups(spark))
    assert tree(lookups.places).count("Scan parquet") == 1
