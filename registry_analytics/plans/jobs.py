"""Composite jobs: build the registry tables once, run all analyses into the results store."""

from __future__ import annotations

import threading
import time
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.formats import fmt_count, fmt_count_pct, fmt_money, fmt_years
from ..functions.text import key_form
from ..operators.dimensions import insert_if_absent
from ..schemas import FACT, FACT_COLUMNS
from ..session import new_work_dir
from ..sources.files import has_rows
from ..sources.results import long_rows, save_results, to_long
from ..sources.versions import Written, add_data, commit, current, read_data
from . import analyses as A
from .fixture import dirty_staging
from .ingest import REASONS, parse_staging, read_registry_csv, split_staging
from .lookups import COMPANY_TYPES, GROWN_KEYS, SEED_ACTIVITIES, Lookups, grow_lookups, seed_lookups, staged_codes
from .migrate import SPECIAL_ROWS, candidates, dedup_and_flag, flag_rules, is_candidate, normalize, unknown_codes


@dataclass(frozen=True)
class Registry:
    """The committed registry tables, read lazily (scans prune columns, push filters)."""

    root: str
    staging: DataFrame
    fact: DataFrame
    rejected: DataFrame
    lookups: Lookups        # grown lookups also hold their key in normal form, as ``key``
    keyed_fact: DataFrame   # the fact with the normal forms of its codes of grown lookups, as ``key_<lookup>``
    unknown: DataFrame      # staging codes that their lookup lacks (``name`` = rule, ``value``)
    stats: DataFrame        # rows per step of the load (``stage, n``), counted by its writes
    timings: dict | None = None  # seconds per written step of the load job


_BUILT: dict[tuple[str, str], Registry] = {}
_RESULTS: dict[tuple[str, str], str] = {}
_LOCK = threading.Lock()


# Fact columns whose normal form is stored, by grown lookup. The other codes are canonical already.
KEYED = {"activities": "id_ciiu", "places": "id_ubicacion"}
# Lookup values added from staging are counted under these names.
NEW_VALUES = {"activities": "new_activities", "places": "new_places", "company_types": "new_company_types"}


def build_registry(spark: SparkSession, staging: DataFrame, root: str | None = None, parsed: bool = False) -> Registry:
    """Load job: staging -> lookups -> checked rows (fact + rejected), each stage written.

    * staging is written once and read back column-pruned by every later step;
      with ``parsed`` it is ``parse_staging`` output, and its quarantined rows are stored with it;
    * one pass over it finds the codes of all lookups; lookups and the codes
      they lack come from that small table alone;
    * normalise -> first-row-wins -> rules runs **once** and is written as one
      table partitioned by ``status``; the fact is its ``valid`` partition and
      the rejected rows its ``rejected`` partition (partition pruning), with
      the normal forms that the star joins on;
    * the special row is tested against the written fact with a literal key
      filter pushed into the scan, and added to the same table;
    * each write counts its rows as it goes (``Observation``); the counts are the load statistics;
    * all tables are committed together at the end (``sources/versions.py``):
      a load that fails leaves those of the load before.

    Writing each stage cuts the lineage: an executor lost later re-reads a
    table instead of recomputing the joins.
    """
    root = root or new_work_dir(spark, "registry")
    timings: dict[str, float] = {}
    tables: dict[str, Written] = {}
    stats: dict[str, int] = {}

    def put(name: str, df: DataFrame, step: str, partition_by: tuple[str, ...] = (), counts: dict[str, Column] | None = None) -> DataFrame:
        t = time.perf_counter()
        seen = Observation()
        observed = df.observe(seen, *[c.alias(k) for k, c in counts.items()]) if counts else df
        written = add_data(observed, root, partition_by)
        tables[name] = tables[name] + written if name in tables else written
        for k, n in (seen.get if counts else {}).items():
            stats[k] = stats.get(k, 0) + n
        timings[step] = round(timings.get(step, 0.0) + time.perf_counter() - t, 3)
        return read_data(spark, root, written)

    good = F.col("reason").isNull() if parsed else F.lit(True)
    counted = {"candidates": F.count_if(good & is_candidate()), "staged": F.count_if(good)}
    if parsed:
        counted |= {"read": F.count(F.lit(1)), **{r: F.count_if(F.col("reason") == r) for r in REASONS}}
    st = put("staging", staging, "staging", counts=counted)
    st = split_staging(st)[0] if parsed else st

    codes = put("codes", staged_codes(st), "codes")
    seeded = seed_lookups(spark)
    grown, _ = grow_lookups(st, seeded, codes)
    seeds = {"activities": len(SEED_ACTIVITIES), "places": 0, "company_types": len(COMPANY_TYPES)}
    stored = {}
    for name, key in GROWN_KEYS.items():
        dim = grown.as_dict()[name].withColumn("key", key_form(key))
        stored[name] = put(name, dim, f"lookup_{name}", counts={NEW_VALUES[name]: F.count(F.lit(1)) - seeds[name]})
    lk = replace(grown, **stored)
    unknown = put("unknown", unknown_codes(codes, lk), "unknown")

    status = F.when(F.size("broken_rules") == 0, F.lit("valid")).otherwise(F.lit("rejected")).alias("status")
    keys = [key_form(col).alias(f"key_{name}") for name, col in KEYED.items()]
    outcome = {"migrated": F.count_if(F.col("status") == "valid"), "rejected": F.count_if(F.col("status") == "rejected")}
    checked = dedup_and_flag(normalize(candidates(st)), lk, unknown).select(*FACT_COLUMNS, *keys, "broken_rules", status)
    rows = put("checked", checked, "checked", ("status",), outcome)
    stats["deduplicated"] = stats["migrated"] + stats["rejected"]

    valid = rows.filter(F.col("status") == "valid").select(*FACT_COLUMNS)
    special = spark.createDataFrame(SPECIAL_ROWS, FACT)
    _, inserted = insert_if_absent(valid, special, "ruc", known_keys=[r[0] for r in SPECIAL_ROWS])
    special_checked = flag_rules(inserted, lk).select(*FACT_COLUMNS, *keys, "broken_rules", status)
    put("checked", special_checked, "special_row", ("status",), outcome)

    put("stats", spark.createDataFrame(sorted(stats.items()), "stage string, n bigint"), "stats")
    commit(spark, root, tables)
    return replace(_registry(spark, root, tables, seeded), timings=timings)


def open_registry(spark: SparkSession, root: str) -> Registry:
    """The tables of the last committed load under ``root``."""
    tables = {name: written for name, (_, written) in current(spark, root).items()}
    if "checked" not in tables:
        raise FileNotFoundError(f"no registry under {root}")
    return _registry(spark, root, tables, seed_lookups(spark))


def _registry(spark: SparkSession, root: str, written: dict[str, Written], seeded: Lookups) -> Registry:
    tables = {name: read_data(spark, root, w) for name, w in written.items()}
    staging, checked = tables["staging"], tables["checked"]
    if "reason" in staging.columns:
        staging, _ = split_staging(staging)
    valid = checked.filter(F.col("status") == "valid")
    fixed = {name: codes for name, codes in seeded.fixed.items() if name not in GROWN_KEYS}
    return Registry(
        root, staging, valid.select(*FACT_COLUMNS),
        checked.filter(F.col("status") == "rejected").select(*FACT_COLUMNS, "broken_rules"),
        replace(seeded, fixed=fixed, **{name: tables[name] for name in GROWN_KEYS}),
        valid.select(*FACT_COLUMNS, *[f"key_{name}" for name in KEYED]), tables["unknown"], tables["stats"],
    )


def registry_for(spark: SparkSession, sf_dir: str) -> Registry:
    """The registry built from the driver tables in ``sf_dir``; built once per application."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _LOCK:
        if key not in _BUILT:
            _BUILT[key] = build_registry(spark, dirty_staging(spark, sf_dir))
        return _BUILT[key]


def text_registry_for(spark: SparkSession, sf_dir: str) -> Registry:
    """The registry loaded from text rows: parsed (good rows and quarantine written), then the load job."""
    from .fixture import raw_text_rows

    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/") + "#text")
    with _LOCK:
        if key not in _BUILT:
            rows = parse_staging(raw_text_rows(spark, sf_dir), keep=("seq",))
            _BUILT[key] = build_registry(spark, rows, parsed=True)
        return _BUILT[key]


def results_for(spark: SparkSession, sf_dir: str, again: bool = False) -> str:
    """The results store of all analyses of ``sf_dir``'s registry, written once per application (or ``again``)."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if again or key not in _RESULTS:
        path = new_work_dir(spark, "results")
        run_all(registry_for(spark, sf_dir).fact, path)
        _RESULTS[key] = path
    return _RESULTS[key]


def run_registry_from_csv(spark: SparkSession, csv_path: str, root: str | None = None,
                          encoding: str = "ISO-8859-1", min_rows: int = 100) -> tuple[Registry, str]:
    """JOB-1..8 end to end: CSV -> staging + quarantine -> lookups -> fact -> results store.

    Returns the registry tables and the results path.  The load gate comes
    first: when the fact under ``root`` already has ``min_rows`` rows, the CSV
    is not loaded again and only the analyses run.
    """
    root = root or new_work_dir(spark, "registry-csv")
    try:
        reg = open_registry(spark, root)
    except FileNotFoundError:
        reg = None
    if reg is None or not has_rows(reg.fact, min_rows):
        rows = parse_staging(read_registry_csv(spark, csv_path, encoding), keep=("seq",))
        reg = build_registry(spark, rows, root, parsed=True)
    run_all(reg.fact, f"{root}/results")
    return reg, f"{root}/results"


# Names under which each analysis is stored.
ANALYSIS_NAMES = {
    "A1": "Salud Fiscal - Por Estado",
    "A2": "Salud Fiscal - Estadísticas Deuda",
    "B1": "Geografía - Por Ubicación",
    "C1": "Estructura - Por Tamaño",
    "C2": "Estructura - Por Tipo Empresa",
    "D": "Sectores Económicos",
    "E": "Demografía",
    "F": "Calidad de Datos",
}


# Reports each stored analysis is made of.
ANALYSIS_REPORTS = {"A1": ("A1",), "A2": ("A2",), "B1": ("B1",), "C1": ("C1",), "C2": ("C2",),
                    "D": ("D1", "D2"), "E": ("E1", "E2"), "F": ("F1", "F2")}


def long_results(fact: DataFrame, analyses: tuple[str, ...] | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """Long-form result rows of the given analyses (all by default), by analysis code,
    and the cached roll-up to release once they are written."""
    analyses = analyses or tuple(ANALYSIS_REPORTS)
    p = A.analysis_pack(fact, sort=False, reports=[r for a in analyses for r in ANALYSIS_REPORTS[a]])
    s = lambda c: F.col(c).cast("string")  # noqa: E731  (bare number text, no separators)
    nd = lambda c: F.coalesce(F.col(c), F.lit(A.MISSING))  # noqa: E731  (a missing key shows as ND)
    n = ANALYSIS_NAMES
    build = {
        "A1": lambda: to_long(p["A1"], n["A1"], nd("id_estado"), [("cantidad", "n", s("n")),
                                      ("deuda_total", "debt_total", fmt_money("debt_total"))]),
        "A2": lambda: to_long(p["A2"], n["A2"], F.lit("DEUDA"), [
            ("con_deuda", "debtors", fmt_count("debtors")),
            ("deuda_total", "debt_total", fmt_money("debt_total")),
            ("deuda_promedio", "debt_avg", fmt_money("debt_avg")),
            ("deuda_mediana", "debt_median", fmt_money("debt_median")),
            ("deuda_maxima", "debt_max", fmt_money("debt_max")),
        ]),
        "B1": lambda: to_long(p["B1"], n["B1"], "place_label", [
            ("empresas", "n", s("n")), ("deuda_total", "debt_total", fmt_money("debt_total"))]),
        "C1": lambda: to_long(p["C1"], n["C1"], "label", [("cantidad", "n", fmt_count_pct("n", "share_pct"))]),
        "C2": lambda: to_long(p["C2"], n["C2"], "label", [("cantidad", "n", fmt_count_pct("n", "share_pct"))]),
        "D": lambda: to_long(p["D1"], n["D"], nd("id_ciiu"), [("empresas", "n", s("n"))]).unionByName(
            long_rows(p["D2"], n["D"], "sector", "metric", "value", fmt_count("value"))),
        "E": lambda: to_long(p["E1"], n["E"], nd("sexo"), [
            ("cantidad", "n", fmt_count_pct("n", "share_pct")),
            ("edad_promedio", F.coalesce("age_avg", F.lit(0.0)), fmt_years("age_avg"))]).unionByName(
            to_long(p["E2"], n["E"], "age_band", [("cantidad", "n", s("n"))])),
        "F": lambda: to_long(p["F1"], n["F"], "column_name", [
            ("nulos", "nulls", fmt_count_pct("nulls", "null_pct"))]).unionByName(
            to_long(p["F2"], n["F"], F.lit("CALIDAD"), [
                ("nd_estado", "nd_estado", fmt_count("nd_estado")),
                ("nd_condicion", "nd_condicion", fmt_count("nd_condicion")),
                ("sin_tipo", "sin_tipo", fmt_count("sin_tipo")),
                ("total_limpios", "clean_total", fmt_count("clean_total")),
            ])),
    }
    return {a: build[a]() for a in analyses}, p["_fine"]


def run_all(fact: DataFrame, results_path: str, only: tuple[str, ...] | None = None) -> None:
    """JOB-8: analyses -> long form -> one write and one commit of the results store.

    Only the analyses written are replaced; other stored analyses stay.
    """
    parts, fine = long_results(fact, only)
    chosen = list(parts.values())
    union = chosen[0]
    for q in chosen[1:]:
        union = union.unionByName(q)
    try:
        save_results(union, results_path, [ANALYSIS_NAMES[a] for a in parts])
    finally:
        fine.unpersist()
