"""Summary reports R1-R8 over the fact and its lookups.

Reports grouped by a lookup description aggregate the fact by its code first
(partial aggregation, one row per code and partition), join the small result
to the lookup and re-aggregate by description.  The fact is never joined row
by row, and the join input is bounded by the number of codes.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import exact_sum, int_mean, mean_as_double
from ..functions.text import key_form
from ..operators.profile import top_k
from ..sources.files import table_counts
from .lookups import Lookups

ACTIVE = "ACTIVO"


def summary(fact: DataFrame, amount: str = "deuda", state: str = "id_estado", debtors_only: bool = False) -> DataFrame:
    """One row of totals (all rows, or debtors only)."""
    x = F.col(amount)
    df = fact.filter(x > 0) if debtors_only else fact
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(state) == F.lit(ACTIVE)).alias("active"),
        F.count_if(x > 0).alias("with_debt"),
        F.coalesce(exact_sum(amount), F.lit(0)).alias("debt_total"),
        F.coalesce(mean_as_double(amount), F.lit(0.0)).alias("debt_avg"),
        F.coalesce(F.max(x), F.lit(0)).alias("debt_max"),
    )


def _by_description(fact: DataFrame, fk: str, dim: DataFrame, dim_key: str, desc_cols: Mapping[str, str],
                    partials: Mapping[str, Column], finals: Mapping[str, Column]) -> DataFrame:
    """Aggregate by code, join the lookup by normal form, re-aggregate by description columns."""
    by_code = fact.groupBy(F.col(fk).alias("_code")).agg(*[c.alias(n) for n, c in partials.items()])
    d = dim.select(key_form(dim_key).alias("_dk"), *[F.col(src).alias(n) for n, src in desc_cols.items()])
    joined = by_code.join(d, key_form("_code") == F.col("_dk"), "inner")
    return joined.groupBy(*desc_cols).agg(*[c.alias(n) for n, c in finals.items()])


def by_state(fact: DataFrame, lk: Lookups, amount: str = "deuda") -> DataFrame:
    """R2: rows and debt per state description."""
    return _by_description(
        fact, "id_estado", lk.states, "id_estado", {"estado": "descripcion"},
        {"_n": F.count(F.lit(1)), "_s": F.sum(amount)},
        {"n": F.sum("_n").cast("bigint"), "debt_total": F.sum("_s")},
    ).orderBy(F.col("n").desc(), "estado")


def top_places_by_name(fact: DataFrame, lk: Lookups, k: int = 15, amount: str = "deuda") -> DataFrame:
    """The ``k`` district names with most rows (names matched case-insensitively)."""
    g = _by_description(
        fact, "id_ubicacion", lk.places, "id_ubicacion", {"ubicacion": "nombre_distrito"},
        {"_n": F.count(F.lit(1)), "_s": F.sum(amount)},
        {"n": F.sum("_n").cast("bigint"), "debt_total": F.sum("_s")},
    )
    return top_k(g, k, "n", "ubicacion")


def by_size(fact: DataFrame, lk: Lookups, amount: str = "deuda") -> DataFrame:
    """Rows and mean debt per size description."""
    return _by_description(
        fact, "id_tamano", lk.sizes, "id_tamano", {"tamano": "descripcion"},
        {"_n": F.count(F.lit(1)), "_s": F.sum(amount), "_c": F.count(amount)},
        {"n": F.sum("_n").cast("bigint"),
         "debt_avg": F.try_divide(F.sum("_s").cast("double"), F.sum("_c").cast("double"))},
    ).orderBy(F.col("n").desc(), "tamano")


def by_sex(fact: DataFrame, key: str = "sexo", age: str = "edad", amount: str = "deuda") -> DataFrame:
    """Rows, integer mean age (truncated, as an INT average) and debt per sex."""
    return fact.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        int_mean(age).alias("age_avg"),
        exact_sum(amount).alias("debt_total"),
    ).orderBy(F.col("n").desc(), key)


def top_activities_described(fact: DataFrame, lk: Lookups, k: int = 15, amount: str = "deuda") -> DataFrame:
    """The ``k`` activities with most rows, by (code, description)."""
    g = _by_description(
        fact, "id_ciiu", lk.activities, "id_ciiu", {"ciiu": "id_ciiu", "actividad": "descripcion"},
        {"_n": F.count(F.lit(1)), "_s": F.sum(amount)},
        {"n": F.sum("_n").cast("bigint"), "debt_total": F.sum("_s")},
    )
    return top_k(g, k, "n", ["ciiu", "actividad"])


# Registry table names as reported by the row-count report.
TABLE_NAMES = {
    "fact": "CONTRIBUYENTE", "activities": "ACTIVIDAD_ECONOMICA", "company_types": "TIPO_EMPRESA",
    "sizes": "TAMANO_EMPRESA", "places": "UBICACION_GEOGRAFICA", "states": "ESTADO_TRIBUTARIO",
    "conditions": "CONDICION_DOMICILIO", "staging": "TMP_DataOZ_Staging", "results": "RESULTADO_SPARK",
}


def table_rows(fact: DataFrame, lk: Lookups, results: DataFrame | None = None,
               staging: DataFrame | None = None) -> DataFrame:
    """Row count of the fact, every lookup and (optionally) the staging and results tables."""
    tables = {TABLE_NAMES["fact"]: fact}
    tables.update({TABLE_NAMES[n]: df for n, df in lk.as_dict().items()})
    if staging is not None:
        tables[TABLE_NAMES["staging"]] = staging
    if results is not None:
        tables[TABLE_NAMES["results"]] = results
    return table_counts(tables)
