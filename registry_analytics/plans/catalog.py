"""Named queries: ``(spark, sf_dir) -> DataFrame``, one per operator group.

Every query reads the driver tables in ``sf_dir`` (or the registry tables
Spark derives from them), so its work grows with the data.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import key_form
from ..operators.dedup import duplicate_keys
from ..operators.dimensions import insert_if_absent
from ..operators.joins import Dim, star_join
from ..operators.quality import orphan_counts, rule_counts
from ..schemas import FACT, RAW_COLUMNS
from ..session import new_work_dir
from ..sources.files import has_rows, write_csv
from ..sources.results import category_max, load_results
from ..sources.sql import query as sql_query, register_views
from . import analyses as A
from . import reports as R
from .fixture import dirty_staging, raw_text_rows, rule_breaking_rows, table
from .ingest import REASONS, parse_staging, read_registry_csv, split_staging
from .jobs import registry_for, results_for, run_all, text_registry_for
from .lookups import grow_lookups, seed_lookups
from .migrate import FOREIGN_KEYS, SPECIAL_ROWS, check_rules, flag_rules, migrate, normalize

Query = Callable[[SparkSession, str], DataFrame]


def _fact(spark: SparkSession, sf: str) -> DataFrame:
    return registry_for(spark, sf).fact


def _money(df: DataFrame) -> DataFrame:
    """Decimal amounts reported as doubles (exact values, engine-independent text)."""
    return df.select(*[F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c)
                       for c, t in df.dtypes])


# --- analyses A-F -----------------------------------------------------------------

def _numbered(df: DataFrame, *order) -> DataFrame:
    """The rows' places in a report's order, so that the order is part of the answer."""
    return df.withColumn("row_no", F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def a1_state_profile(spark, sf):
    return _money(_numbered(A.state_profile(_fact(spark, sf)), *A.count_order("id_estado")))


def a2_debt_stats(spark, sf):
    return _money(A.debt_stats(_fact(spark, sf)))


def b1_top_places(spark, sf):
    return _money(A.top_places(_fact(spark, sf)))


def b2_top_places_ci(spark, sf):
    return _money(A.top_places(_fact(spark, sf), case_sensitive=False))


def b3_long_places(spark, sf):
    """B1 over places with long names, whose labels are cut to 24 characters."""
    long_name = F.concat("id_ubicacion", F.lit(", DISTRITO DE LA PROVINCIA"))
    return _money(A.top_places(_fact(spark, sf).withColumn("id_ubicacion", long_name)))


def c1_size_profile(spark, sf):
    return _money(A.size_profile(_fact(spark, sf)))


def c2_type_profile(spark, sf):
    return A.type_profile(_fact(spark, sf))


def d1_top_activities(spark, sf):
    return _money(A.top_activities(_fact(spark, sf)))


def d2_sector_rollup(spark, sf):
    return A.sector_counts(_fact(spark, sf))


def e1_sex_profile(spark, sf):
    return A.sex_profile(_fact(spark, sf))


def e2_age_bands(spark, sf):
    return _numbered(A.age_bands(_fact(spark, sf)), "age_band")


def f1_null_profile(spark, sf):
    return A.null_columns(_fact(spark, sf))


def f2_default_codes(spark, sf):
    return A.default_codes(_fact(spark, sf))


def a1b_orders_by_status(spark, sf):
    """A1's profile on a plain driver table: orders by status, exact price sums."""
    o = table(spark, sf, "orders").select("o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    return _money(A.state_profile(o, key="o_orderstatus", amount="price"))


def a2b_customer_balance_stats(spark, sf):
    """A2's statistics on customer balances (negative balances are not debts)."""
    c = table(spark, sf, "customer").select(F.col("c_acctbal").cast("decimal(18,2)").alias("balance"))
    return _money(A.debt_stats(c, amount="balance"))


# --- load, normalise, migrate -------------------------------------------------------

def n1_normalize_codes(spark, sf):
    n = normalize(dirty_staging(spark, sf))
    return _money(n.withColumnRenamed("_seq", "seq"))


def m1_migrate(spark, sf):
    """The staging -> fact job as one lazy plan over the stored staging table and the lookups
    grown by the previous step (rows filtered, normalised, de-duplicated and checked)."""
    reg = registry_for(spark, sf)
    return _money(migrate(reg.staging, reg.lookups, unknown=reg.unknown).fact)


def m2_rejected_by_rule(spark, sf):
    return rule_counts(registry_for(spark, sf).rejected)


def m4_rules_before_cleaning(spark, sf):
    """Every rule of the fact on rows that have not been normalised: rows that break it."""
    return rule_counts(flag_rules(rule_breaking_rows(spark, sf), registry_for(spark, sf).lookups))


def m3_duplicates(spark, sf):
    li = table(spark, sf, "lineitem")
    return duplicate_keys(li, ["l_orderkey", "l_linenumber"])


def q2_unique_keys(spark, sf):
    """DQ-1 on the registry: keys occurring more than once in the fact (by value) and in each
    lookup (by normal form), one row per table, zero when the key is unique."""
    reg = registry_for(spark, sf)
    keys = {"CONTRIBUYENTE": (reg.fact, F.col("ruc"))}
    key_cols = {"activities": "id_ciiu", "company_types": "id_tipo_empresa", "sizes": "id_tamano",
                "places": "id_ubicacion", "states": "id_estado", "conditions": "id_condicion"}
    for name, df in reg.lookups.as_dict().items():
        keys[R.TABLE_NAMES[name]] = (df, key_form(key_cols[name]))
    parts = [
        duplicate_keys(df.select(k.alias("k")), "k").agg(F.count(F.lit(1)).alias("duplicate_keys"))
        .select(F.lit(t).alias("table_name"), "duplicate_keys")
        for t, (df, k) in keys.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def g1_grow_places(spark, sf):
    """Places missing from the (empty) seeded lookup, from the stored staging table."""
    _, added = grow_lookups(registry_for(spark, sf).staging, seed_lookups(spark))
    return added["places"]


def g3_grow_activities(spark, sf):
    """Activity codes missing from the seeded lookup, from the stored staging table."""
    _, added = grow_lookups(registry_for(spark, sf).staging, seed_lookups(spark))
    return added["activities"]


def g2_insert_if_absent(spark, sf):
    reg = registry_for(spark, sf)
    special = spark.createDataFrame(SPECIAL_ROWS, FACT)
    _, inserted = insert_if_absent(reg.fact, special, "ruc", known_keys=[r[0] for r in SPECIAL_ROWS])
    return _money(inserted)


def g2b_special_row_accepted(spark, sf):
    """The special row where a place of its name has been grown: inserted, and valid."""
    reg = registry_for(spark, sf)
    special = spark.createDataFrame(SPECIAL_ROWS, FACT)
    _, inserted = insert_if_absent(reg.fact, special, "ruc", known_keys=[r[0] for r in SPECIAL_ROWS])
    own = special.select(F.col("id_ubicacion").alias("ddp_ubigeo"), F.lit(None).cast("string").alias("ddp_ciiu"),
                         F.lit(None).cast("string").alias("ddp_tpoemp"))
    lookups, _ = grow_lookups(own, reg.lookups)
    return _money(check_rules(inserted, lookups)[0])


def q1_orphans(spark, sf):
    """Orphan count per foreign key over every checked row (the de-duplicated rows and the
    special row when it was absent): its different codes against the stored lookups."""
    reg = registry_for(spark, sf)
    rows = reg.fact.unionByName(reg.rejected.drop("broken_rules"))
    dims = reg.lookups.as_dict()
    return orphan_counts(rows, [(name, col, dims[dim], key) for name, col, dim, key in FOREIGN_KEYS])


# --- star -------------------------------------------------------------------------

# The star's column names.
STAR_FACT_COLUMNS = {"ruc": "ruc", "sexo": "sexo", "edad": "edad", "deuda": "deuda"}


def star(spark, sf) -> DataFrame:
    """JOB-7: the fact with the descriptions of its six lookups (13 columns).

    Grown lookups are joined on the normal forms that the load has stored on
    both sides; the codes of the fixed catalogues are canonical in the fact.
    """
    reg = registry_for(spark, sf)
    lk = reg.lookups
    exact = {"case_insensitive": False}
    dims = [
        Dim(lk.activities, "key_activities", "key", {"codigo_ciiu": "id_ciiu", "actividad_economica": "descripcion"}, **exact),
        Dim(lk.company_types, "id_tipo_empresa", "id_tipo_empresa", {"tipo_empresa": "descripcion"}, **exact),
        Dim(lk.sizes, "id_tamano", "id_tamano", {"tamano_empresa": "descripcion"}, small=True, **exact),
        Dim(lk.places, "key_places", "key",
            {"distrito": "nombre_distrito", "provincia": "provincia", "departamento": "departamento"}, **exact),
        Dim(lk.states, "id_estado", "id_estado", {"estado_tributario": "descripcion"}, small=True, **exact),
        Dim(lk.conditions, "id_condicion", "id_condicion", {"condicion_domicilio": "descripcion"}, small=True, **exact),
    ]
    return star_join(reg.keyed_fact, dims, STAR_FACT_COLUMNS)


def s1_star(spark, sf):
    return _money(star(spark, sf))


def s2_star_driver(spark, sf):
    """A six-way star on the largest driver fact: lineitem with its order, part, supplier,
    customer, nation and region.  Orders meet their customers first, so lineitem is
    exchanged once for both; nation and region are fixed 25 / 5 row tables and are broadcast."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                            "l_quantity", "l_extendedprice")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    p = table(spark, sf, "part").select("p_partkey", "p_brand")
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf, "region").select("r_regionkey", "r_name")
    geo = F.broadcast(n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name"))
    buyers = c.join(geo, c.c_nationkey == F.col("n_nationkey"))
    j = (li.join(o.join(buyers, o.o_custkey == c.c_custkey), li.l_orderkey == o.o_orderkey)
           .join(p, li.l_partkey == p.p_partkey)
           .join(s, li.l_suppkey == s.s_suppkey))
    return j.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "o_orderstatus",
                    "c_custkey", "c_mktsegment", "n_name", "r_name", "p_brand", "s_name")


# --- reports R1-R8 ------------------------------------------------------------------

def r1_summary(spark, sf):
    return _money(R.summary(_fact(spark, sf)))


def r1b_summary_debtors(spark, sf):
    return _money(R.summary(_fact(spark, sf), debtors_only=True))


def r2_by_state(spark, sf):
    reg = registry_for(spark, sf)
    return _money(R.by_state(reg.fact, reg.lookups))


def r3_top_places(spark, sf):
    reg = registry_for(spark, sf)
    return _money(R.top_places_by_name(reg.fact, reg.lookups))


def r3b_top5_places(spark, sf):
    """The console summary's five districts with most rows."""
    reg = registry_for(spark, sf)
    return _money(R.top_places_by_name(reg.fact, reg.lookups, k=5))


def r4_by_size(spark, sf):
    reg = registry_for(spark, sf)
    return _money(R.by_size(reg.fact, reg.lookups))


def r5_by_sex(spark, sf):
    return _money(R.by_sex(_fact(spark, sf)))


def r6_top_activities(spark, sf):
    reg = registry_for(spark, sf)
    return _money(R.top_activities_described(reg.fact, reg.lookups))


def _stored(results: DataFrame) -> DataFrame:
    """Stored result rows without their run time, with their place in the reading order."""
    order = (F.col("valor_numerico").desc_nulls_last(), "nombre_analisis", "categoria", "metrica")
    return _numbered(results, *order).select(
        "nombre_analisis", "categoria", "metrica",
        F.col("valor_numerico").cast("double").alias("valor_numerico"), "valor_texto", "row_no")


def r7_results_roundtrip(spark, sf):
    """Save A1 and C1 over the debtors, then replace A1 alone by A1 over all rows; read back.

    The saves run when the query is built.  The run time column is left out of
    the output (it differs per run).
    """
    reg = registry_for(spark, sf)
    path = new_work_dir(spark, "results")
    run_all(reg.fact.filter(F.col("deuda") > 0), path, only=("A1", "C1"))
    run_all(reg.fact, path, only=("A1",))  # replaces A1 only; C1 stays
    return _stored(load_results(spark, path))


def r10_run_times(spark, sf):
    """Rows of two saved analyses, and whether their run time lies between the save's start and end
    (the save runs when the query is built)."""
    path = new_work_dir(spark, "results")
    begin = time.time_ns() // 1000
    run_all(_fact(spark, sf), path, only=("A1", "C1"))
    end = time.time_ns() // 1000
    at = F.unix_micros("fecha_ejecucion")
    return load_results(spark, path).groupBy("nombre_analisis").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("fecha_ejecucion").alias("run_times"),
        F.every(at.between(begin // 1000 * 1000, end)).alias("within_job"))


def j8_run_all(spark, sf):
    """JOB-8: all eight analyses (one roll-up) saved to a new results store when the query is built, read back."""
    return _stored(load_results(spark, results_for(spark, sf, again=True))).drop("row_no")


def r7b_category_max(spark, sf):
    """Largest stored number per category of the place analysis (saved when the query is built)."""
    reg = registry_for(spark, sf)
    path = new_work_dir(spark, "results")
    run_all(reg.fact, path, only=("B1",))
    return category_max(load_results(spark, path, "Geografía - Por Ubicación"))


def r9_sql_star_by_state(spark, sf):
    """The star as a temp view, queried with SQL and a bound parameter (debts above a floor)."""
    register_views(spark, {"star": star(spark, sf)})
    return sql_query(spark, """
        SELECT estado_tributario, count(*) AS n, CAST(sum(deuda) AS DOUBLE) AS debt_total
        FROM vw_contribuyente_completo WHERE deuda > :floor GROUP BY estado_tributario""", {"floor": 0})


def r8_table_counts(spark, sf):
    reg = registry_for(spark, sf)
    return R.table_rows(reg.fact, reg.lookups)


def r8b_all_table_counts(spark, sf):
    """Row counts of every registry table, staging and the results store of all analyses included."""
    reg = registry_for(spark, sf)
    results = load_results(spark, results_for(spark, sf))
    return R.table_rows(reg.fact, reg.lookups, results=results, staging=reg.staging)


# --- sources ------------------------------------------------------------------------

def p1_parse_rows(spark, sf):
    return _money(parse_staging(raw_text_rows(spark, sf), keep=("seq",)))


def i1_csv_roundtrip(spark, sf):
    """Registry text rows written as latin-1 CSV, read back and parsed; staging rows out."""
    path = new_work_dir(spark, "csv")
    write_csv(raw_text_rows(spark, sf).select(*RAW_COLUMNS), path)
    parsed = parse_staging(read_registry_csv(spark, path), keep=())
    staging, _ = split_staging(parsed)
    return _money(staging)


def l1_load_stats(spark, sf):
    """Rows per load stage and per quarantine reason that occurs, from the text rows to the fact:
    the counts that the load's own writes have made and stored; nothing is scanned again."""
    stats = text_registry_for(spark, sf).stats
    return stats.filter((F.col("n") > 0) | ~F.col("stage").isin(*REASONS))


def h1_has_rows(spark, sf):
    """Load gate: does the fact hold at least 100 rows (reads at most 100)."""
    return spark.createDataFrame([(has_rows(_fact(spark, sf), 100),)], "has_rows boolean")


QUERIES: dict[str, Query] = {
    f.__name__: f for f in [
        a1_state_profile, a1b_orders_by_status, a2_debt_stats, a2b_customer_balance_stats, b1_top_places, b2_top_places_ci, b3_long_places, c1_size_profile, c2_type_profile,
        d1_top_activities, d2_sector_rollup, e1_sex_profile, e2_age_bands, f1_null_profile, f2_default_codes,
        n1_normalize_codes, m1_migrate, m2_rejected_by_rule, m3_duplicates, m4_rules_before_cleaning, g1_grow_places,
        g2_insert_if_absent, g2b_special_row_accepted, g3_grow_activities, q1_orphans, q2_unique_keys, s1_star, s2_star_driver,
        r1_summary, r1b_summary_debtors, r2_by_state, r3_top_places, r3b_top5_places, r4_by_size, r5_by_sex,
        r6_top_activities, j8_run_all, r7_results_roundtrip, r7b_category_max, r8_table_counts, r8b_all_table_counts, r9_sql_star_by_state, r10_run_times,
        p1_parse_rows, i1_csv_roundtrip, l1_load_stats, h1_has_rows,
    ]
}
