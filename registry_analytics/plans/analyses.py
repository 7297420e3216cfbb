"""Analyses A-F over the fact table, each a small set of fused aggregates.

Every function takes the fact frame and optional column names and returns a
lazy DataFrame (A2's percentiles are found when it is called).  Amounts that are
decimals stay decimals, exactly; means are doubles.  Ties in top-k lists are broken by the
key so results are deterministic.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.formats import null_grade
from ..functions.numbers import exact_sum, mean_as_double, safe_pct
from ..functions.text import key_form, truncate
from ..operators.joins import lookup_label
from ..operators.profile import (
    amount_stats,
    bucketize,
    conditional_counts,
    group_profile,
    null_profile,
    sector_rollup,
    share_of_total,
    top_k, percentile_values,
)

ACTIVE = "ACTIVO"

# Display labels of size and company-type codes.
SIZE_LABELS = {"C": "Micro/Peq", "M": "Mediana", "G": "Grande", "B": "Básica"}
TYPE_LABELS = {
    "A": "Persona Natural", "B": "Persona Jurídica", "CE": "Cooperativa", "C": "Cooperativa",
    "D": "EIRL", "E": "Empresa Estado", "-": "Sin definir",
}
# Sectors by activity-code prefix.
SECTORS = {"SECTOR_52xx": ("52",), "SECTOR_15xx": ("15",), "SECTOR_70_55xx": ("70", "55")}
# Age bands (upper edges exclusive) and their labels.
AGE_EDGES = (30, 40, 50, 60, 70)
AGE_LABELS = ("< 30 años", "30-39 años", "40-49 años", "50-59 años", "60-69 años", "70+ años")
NULL_PROFILE_COLUMNS = ("edad", "deuda", "id_ciiu", "id_tipo_empresa", "id_estado", "id_condicion")


# Text shown for a missing key (labelled codes show "?").
MISSING = "ND"
MISSING_CODE = "?"


def code_label(code: str, labels: dict[str, str]) -> Column:
    """Label of a code, the code itself when unknown, ``?`` when missing."""
    return lookup_label(F.coalesce(F.col(code), F.lit(MISSING_CODE)), labels)


def count_order(key: str, count_col: str = "n") -> list[Column]:
    """The order by count descending, ties by key."""
    return [F.col(count_col).desc(), F.col(key).asc_nulls_last()]


def by_count(df: DataFrame, key: str, count_col: str = "n") -> DataFrame:
    """Rows by count descending, ties by key (a sort of the small grouped result)."""
    return df.orderBy(*count_order(key, count_col))


def state_profile(fact: DataFrame, key: str = "id_estado", amount: str = "deuda") -> DataFrame:
    """A1: rows, debt total and debt mean per state."""
    g = group_profile(fact, key, {"debt_total": exact_sum(amount), "debt_avg": mean_as_double(amount)})
    return by_count(g, key)


def debt_stats(fact: DataFrame, amount: str = "deuda") -> DataFrame:
    """A2: statistics of positive debts and the share of debtors among all rows."""
    s = amount_stats(fact, amount, positive_only=True)
    return s.select(
        F.col("n").alias("debtors"), F.col("total").alias("debt_total"), F.col("mean").alias("debt_avg"),
        F.col("max").alias("debt_max"), F.col("min").alias("debt_min"), F.col("p50").alias("debt_median"),
        F.col("p90").alias("debt_p90"), F.col("share_pct").alias("debtors_pct"),
    )


def top_places(fact: DataFrame, k: int = 15, place: str = "id_ubicacion", state: str = "id_estado",
               activity: str = "id_ciiu", amount: str = "deuda", case_sensitive: bool = True,
               approx_distinct: bool = False) -> DataFrame:
    """B1: the ``k`` places with most rows: active rows, debt, distinct activities.

    ``case_sensitive=False`` groups ``Chimbote`` with ``CHIMBOTE`` under the
    normal form ``CHIMBOTE``.  All aggregates are hash aggregates with
    map-side combine; the distinct count is planned as two partial
    aggregations, so a dominant place does not gather its rows in one task.
    ``approx_distinct`` uses the HyperLogLog++ sketch instead (one aggregate
    level, about 5 % relative error).
    """
    key = F.col(place) if case_sensitive else key_form(place)
    g = fact.groupBy(key.alias(place)).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(state) == F.lit(ACTIVE)).alias("active"),
        exact_sum(amount).alias("debt_total"),
        (F.approx_count_distinct(activity) if approx_distinct else F.count_distinct(activity)).alias("activities"),
    )
    top = top_k(g, k, "n", place)
    label = truncate(F.coalesce(F.col(place), F.lit(MISSING)), 24)
    return top.select(place, label.alias("place_label"), "n", "active", "debt_total", "activities")


def size_profile(fact: DataFrame, key: str = "id_tamano", amount: str = "deuda", age: str = "edad") -> DataFrame:
    """Rows, share, debt total and mean age per size, with the size label."""
    g = group_profile(fact, key, {"debt_total": exact_sum(amount), "age_avg": F.avg(age)})
    return by_count(share_of_total(g).withColumn("label", code_label(key, SIZE_LABELS)), key)


def type_profile(fact: DataFrame, key: str = "id_tipo_empresa") -> DataFrame:
    """Rows and share per company type, with the type label (two codes may share a label)."""
    return by_count(share_of_total(group_profile(fact, key)).withColumn(
        "label", code_label(key, TYPE_LABELS)), key)


def top_activities(fact: DataFrame, k: int = 20, key: str = "id_ciiu", state: str = "id_estado",
                   amount: str = "deuda") -> DataFrame:
    """The ``k`` activities with most rows: active rows and debt total."""
    g = group_profile(fact, key, {
        "active": F.count_if(F.col(state) == F.lit(ACTIVE)),
        "debt_total": exact_sum(amount),
    })
    return top_k(g, k, "n", key)


def sector_counts(fact: DataFrame, key: str = "id_ciiu", state: str = "id_estado") -> DataFrame:
    """Rows per sector prefix group, and active rows of the retail sector; one pass."""
    return sector_rollup(fact, key, SECTORS, {"activos": ("SECTOR_52xx", F.col(state) == F.lit(ACTIVE))})


def sex_profile(fact: DataFrame, key: str = "sexo", amount: str = "deuda", age: str = "edad") -> DataFrame:
    """Rows, share, mean debt and mean age per sex."""
    g = group_profile(fact, key, {"debt_avg": mean_as_double(amount), "age_avg": F.avg(age)})
    return by_count(share_of_total(g), key)


def age_bands(fact: DataFrame, age: str = "edad") -> DataFrame:
    """Rows per age band (ages NULL or 0 excluded), share of **all** rows.

    Excluded rows fall in a NULL band, so the total comes from the same single
    aggregate; the NULL band is dropped afterwards.
    """
    a = F.col(age)
    band = bucketize(a, AGE_EDGES, AGE_LABELS, keep=a.isNotNull() & (a > 0))
    band_no = bucketize(a, AGE_EDGES, [str(i) for i in range(1, len(AGE_LABELS) + 1)],
                        keep=a.isNotNull() & (a > 0)).cast("int")
    g = fact.groupBy(band.alias("age_band"), band_no.alias("band_no")).agg(F.count(F.lit(1)).alias("n"))
    # Text order of the band label, as reported ("< 30 años" sorts last); band_no gives age order.
    return share_of_total(g).filter(F.col("age_band").isNotNull()).orderBy("age_band")


def null_columns(fact: DataFrame, columns=NULL_PROFILE_COLUMNS) -> DataFrame:
    """NULL count, share and grade of each column, one aggregate for all."""
    return null_profile(fact, list(columns))


def default_codes(fact: DataFrame, state: str = "id_estado", condition: str = "id_condicion",
                  company_type: str = "id_tipo_empresa") -> DataFrame:
    """rows left with a default code, and the clean total.

    ``clean_total`` subtracts both default counts from the total (a row with
    both defaults is subtracted twice); ``clean_total_exact`` counts rows with
    neither.
    """
    st, co = F.col(state), F.col(condition)
    c = conditional_counts(fact, {
        "nd_estado": st == F.lit("ND"),
        "nd_condicion": co == F.lit("ND"),
        "sin_tipo": F.col(company_type) == F.lit("-"),
        "clean_total_exact": (st != F.lit("ND")) & (co != F.lit("ND")),
    })
    return c.withColumn("clean_total", F.col("total") - F.col("nd_estado") - F.col("nd_condicion"))


# --- the analysis pack: every report from one roll-up ------------------------------------

PACK_KEYS = ("id_estado", "id_tamano", "id_tipo_empresa", "sexo")


def _measures(amount: str, age: str) -> dict[str, tuple[Column, Callable[[str], Column]]]:
    """The aggregates of the roll-up: of rows, and of its own rows."""
    x, a, st, co, code = F.col(amount), F.col(age), F.col("id_estado"), F.col("id_condicion"), F.col("id_ciiu")
    pos = F.when(x > 0, x)
    sectors = [functools.reduce(operator.or_, [code.startswith(p) for p in prefixes]) for prefixes in SECTORS.values()]
    counts = {
        "n": F.count(F.lit(1)), "_c_amt": F.count(x), "_c_age": F.count(a), "debtors": F.count(pos),
        **{f"_sec_{i}": F.count_if(member) for i, member in enumerate(sectors)},
        "_sec_act": F.count_if(sectors[0] & (st == F.lit(ACTIVE))),
        **{f"_null_{i}": F.count_if(F.col(c).isNull()) for i, c in enumerate(NULL_PROFILE_COLUMNS)},
        "nd_estado": F.count_if(st == F.lit("ND")),
        "nd_condicion": F.count_if(co == F.lit("ND")),
        "sin_tipo": F.count_if(F.col("id_tipo_empresa") == F.lit("-")),
        "clean_total_exact": F.count_if((st != F.lit("ND")) & (co != F.lit("ND"))),
        "active": F.count_if(st == F.lit(ACTIVE)),
    }
    out = {name: (c, lambda n: F.coalesce(F.sum(n), F.lit(0)).cast("bigint")) for name, c in counts.items()}
    out |= {"_s_amt": (F.sum(x), F.sum), "_s_age": (F.sum(a).cast("bigint"), F.sum), "_s_pos": (F.sum(pos), F.sum)}
    out |= {"_max_amt": (F.max(x), F.max), "_max_pos": (F.max(pos), F.max), "_min_pos": (F.min(pos), F.min)}
    return out


def pack_rollup(fact: DataFrame, amount: str = "deuda", age: str = "edad") -> DataFrame:
    """One aggregate over the five bounded keys with the measures of all reports.

    The keys are catalogue codes and age bands: a few thousand groups at most,
    however many rows, and every grouped or global report is a roll-up of them.
    """
    a = F.col(age)
    keep = a.isNotNull() & (a > 0)
    base = fact.withColumn("age_band", bucketize(a, AGE_EDGES, AGE_LABELS, keep=keep)).withColumn(
        "band_no", bucketize(a, AGE_EDGES, [str(i) for i in range(1, len(AGE_LABELS) + 1)], keep=keep).cast("int"))
    measures = _measures(amount, age)
    return base.groupBy(*PACK_KEYS, "age_band", "band_no").agg(*[c.alias(name) for name, (c, _) in measures.items()])


def analysis_pack(fact: DataFrame, amount: str = "deuda", age: str = "edad", sort: bool = True,
                  reports: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Reports A1, A2, B1, C1, C2, D1, D2-D4, E1, E2, F1, F2 and R1 (or those named) from one roll-up.

    The roll-up is cached (its size is bounded by the catalogues, not by the
    rows) and returned under ``_fine``, for the caller to unpersist.  B1 and D1
    are top-k reports over high-cardinality keys and keep their own aggregate;
    the percentiles of A2 are found when the pack is made.  Each frame has the
    columns of the matching single-report function.  ``sort=False`` leaves out
    the presentation order (each sort of a report is a range exchange with its
    own sampling job; storing the rows needs none).
    """
    order = by_count if sort else (lambda df, key: df)
    measures = _measures(amount, age)
    fine = pack_rollup(fact, amount, age).cache()
    rolled = [up(name).alias(name) for name, (_, up) in measures.items()]
    s = fine.agg(*rolled)
    total = fine.select(F.sum("n")).scalar()

    def grouped(key: str) -> DataFrame:
        return fine.groupBy(key).agg(*rolled).select(
            key, "n",
            F.col("_s_amt").alias("debt_total"),
            F.try_divide(F.col("_s_amt").cast("double"), F.col("_c_amt").cast("double")).alias("debt_avg"),
            F.try_divide(F.col("_s_age").cast("double"), F.col("_c_age").cast("double")).alias("age_avg"),
            safe_pct(F.col("n"), total).alias("share_pct"),
        )

    def bands() -> DataFrame:
        rows = fine.filter(F.col("age_band").isNotNull()).groupBy("age_band", "band_no").agg(F.sum("n").alias("n"))
        rows = rows.select("age_band", "band_no", "n", safe_pct(F.col("n"), total).alias("share_pct"))
        return rows.orderBy("age_band") if sort else rows

    def amounts() -> DataFrame:
        p50, p90 = percentile_values(fact, amount, (0.5, 0.9), positive_only=True)
        zero = lambda c: F.coalesce(c, F.lit(0))
        return s.select(
            "debtors", zero(F.col("_s_pos")).alias("debt_total"),
            F.coalesce(F.try_divide(F.col("_s_pos").cast("double"), F.col("debtors").cast("double")), F.lit(0.0)).alias("debt_avg"),
            zero(F.col("_max_pos")).alias("debt_max"), zero(F.col("_min_pos")).alias("debt_min"),
            zero(p50).alias("debt_median"), zero(p90).alias("debt_p90"),
            safe_pct(F.col("debtors"), F.col("n")).alias("debtors_pct"),
        )

    def sectors() -> DataFrame:
        names = list(SECTORS)
        rows = [(n, "total", f"_sec_{i}", i * 10) for i, n in enumerate(names)] + [(names[0], "activos", "_sec_act", 1)]
        stacked = ", ".join(f"'{n}', '{m}', {o}, `{c}`" for n, m, c, o in rows)
        return s.selectExpr(f"stack({len(rows)}, {stacked}) AS (sector, metric, ord, value)").select(
            "sector", "metric", F.col("value").cast("bigint").alias("value"), F.col("ord").cast("int").alias("ord"))

    def nulls() -> DataFrame:
        stacked = ", ".join(f"'{c}', {i}, `_null_{i}`" for i, c in enumerate(NULL_PROFILE_COLUMNS))
        f1 = s.selectExpr("n", f"stack({len(NULL_PROFILE_COLUMNS)}, {stacked}) AS (column_name, ord, nulls)")
        pct = safe_pct(F.col("nulls"), F.col("n"))
        return f1.select("column_name", F.col("ord").cast("int").alias("ord"),
                         F.col("nulls").cast("bigint").alias("nulls"), pct.alias("null_pct"), null_grade(pct).alias("grade"))

    def summary() -> DataFrame:
        return s.select(
            F.col("n").alias("total"), "active", F.col("debtors").alias("with_debt"),
            F.coalesce("_s_amt", F.lit(0)).alias("debt_total"),
            F.coalesce(F.try_divide(F.col("_s_amt").cast("double"), F.col("_c_amt").cast("double")), F.lit(0.0)).alias("debt_avg"),
            F.coalesce("_max_amt", F.lit(0)).alias("debt_max"),
        )

    make = {
        "A1": lambda: order(grouped("id_estado").select("id_estado", "n", "debt_total", "debt_avg"), "id_estado"),
        "A2": amounts,
        "B1": lambda: top_places(fact, amount=amount),
        "C1": lambda: order(grouped("id_tamano").select(
            "id_tamano", "n", "debt_total", "age_avg", "share_pct",
            code_label("id_tamano", SIZE_LABELS).alias("label")), "id_tamano"),
        "C2": lambda: order(grouped("id_tipo_empresa").select(
            "id_tipo_empresa", "n", "share_pct", code_label("id_tipo_empresa", TYPE_LABELS).alias("label")),
            "id_tipo_empresa"),
        "D1": lambda: top_activities(fact, amount=amount),
        "D2": sectors,
        "E1": lambda: order(grouped("sexo").select("sexo", "n", "debt_avg", "age_avg", "share_pct"), "sexo"),
        "E2": bands,
        "F1": nulls,
        "F2": lambda: s.select(F.col("n").alias("total"), "nd_estado", "nd_condicion", "sin_tipo", "clean_total_exact",
                               (F.col("n") - F.col("nd_estado") - F.col("nd_condicion")).alias("clean_total")),
        "R1": summary,
    }
    return {"_fine": fine, **{r: make[r]() for r in reports or make}}
