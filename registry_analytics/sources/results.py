"""Long-form results store: ``(analysis, category, metric, number, text, run time)``.

Stored as parquet partitioned by analysis name, in versions (``versions.py``):
an analysis is a table of its own in the manifest.  Saving replaces the saved
analyses together, when all their rows are written; the others stay.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .versions import LOAD, Written, add_data, commit, current, read_data

RESULTS_COLUMNS = ("nombre_analisis", "categoria", "metrica", "valor_numerico", "valor_texto", "fecha_ejecucion")


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def to_long(
    wide: DataFrame,
    analysis: str,
    category: Column | str,
    metrics: Sequence[tuple[str, Column | str, Column | str]],
) -> DataFrame:
    """Unpivot a wide report into result rows, one per (row, metric).

    ``metrics`` holds ``(metric_name, number_expr, text_expr)``.  One projection
    and one ``inline`` (no union of scans).
    """
    rows = F.array(*[
        F.struct(
            F.lit(m).alias("metrica"),
            _c(v).cast("decimal(38,4)").alias("valor_numerico"),
            _c(t).cast("string").alias("valor_texto"),
        )
        for m, v, t in metrics
    ])
    return wide.select(
        F.lit(analysis).alias("nombre_analisis"),
        _c(category).cast("string").alias("categoria"),
        F.inline(rows),
    )


def long_rows(df: DataFrame, analysis: str, category: Column | str, metric: Column | str,
              value: Column | str, text: Column | str) -> DataFrame:
    """Result rows from a frame that is already long (one metric per row)."""
    return df.select(
        F.lit(analysis).alias("nombre_analisis"),
        _c(category).cast("string").alias("categoria"),
        _c(metric).cast("string").alias("metrica"),
        _c(value).cast("decimal(38,4)").alias("valor_numerico"),
        _c(text).cast("string").alias("valor_texto"),
    )


def save_results(long: DataFrame, path: str, analyses: Sequence[str] | None = None) -> None:
    """Replace the stored rows of the named analyses (those present in ``long`` by default); keep the others.

    A named analysis without rows is stored as empty.
    """
    stamped = long.withColumn("fecha_ejecucion", F.current_timestamp()).select(*RESULTS_COLUMNS)
    written = add_data(stamped, path, ["nombre_analisis"])
    if analyses is None:
        found = read_data(long.sparkSession, path, written).select("nombre_analisis").distinct()
        analyses = [r.nombre_analisis for r in found.collect()]
    commit(long.sparkSession, path, {name: written for name in analyses})


def load_results(spark: SparkSession, path: str, analysis: str | None = None) -> DataFrame:
    """Stored rows (of one analysis: partition pruning), number descending, then by analysis, category and metric."""
    tables = {name: w for name, (_, w) in current(spark, path).items() if analysis in (None, name)}
    if not tables:
        raise FileNotFoundError(f"no stored results of {analysis or 'any analysis'} under {path}")
    loads = sorted({load for w in tables.values() for load in w.folders})
    rows = read_data(spark, path, Written(tuple(loads), next(iter(tables.values())).schema), keep_load=True)
    own = F.lit(False)
    for name, w in tables.items():
        own = own | ((F.col("nombre_analisis") == name) & F.col(LOAD).isin(*w.folders))
    order = [F.col("valor_numerico").desc_nulls_last(), "nombre_analisis", "categoria", "metrica"]
    return rows.filter(own).select(*RESULTS_COLUMNS).orderBy(*order)


def category_max(results: DataFrame) -> DataFrame:
    """Per category, the largest number (the chart reduction of the saved results)."""
    return (
        results.filter(F.col("categoria").isNotNull() & F.col("metrica").isNotNull()
                       & F.col("valor_numerico").isNotNull())
        .groupBy("categoria")
        .agg(F.max("valor_numerico").cast("double").alias("max_valor"))
    )
