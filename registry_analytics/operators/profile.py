"""Grouped and global profiles.

Every profile is one aggregate: Catalyst plans a partial (map-side) hash
aggregate, so only one row per key and input partition crosses the shuffle,
whatever the skew of the key.  Several numbers over the same set are fused
into one ``agg`` instead of one action per number.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import safe_pct
from ..functions.formats import null_grade
from .ranks import percentiles_disc


def _cols(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def group_profile(
    df: DataFrame,
    keys: str | Sequence[str],
    metrics: Mapping[str, Column] | None = None,
    count_col: str = "n",
) -> DataFrame:
    """``GROUP BY keys`` with a row count and any named aggregate columns."""
    aggs = [F.count(F.lit(1)).alias(count_col)]
    aggs += [c.alias(name) for name, c in (metrics or {}).items()]
    return df.groupBy(*_cols(keys)).agg(*aggs)


def share_of_total(
    grouped: DataFrame,
    count_col: str = "n",
    share_col: str = "share_pct",
    total: Column | None = None,
) -> DataFrame:
    """Add ``count / total * 100``.

    ``total`` defaults to the sum of ``count_col`` over the grouped frame, as a
    scalar subquery: no window over one partition and no cross join, whatever
    the number of groups.  Pass a scalar Column for "share of all rows".
    """
    if total is None:
        total = grouped.select(F.sum(count_col)).scalar()
    return grouped.withColumn(share_col, safe_pct(F.col(count_col), total))


def top_k(df: DataFrame, k: int, by: str, tie_keys: str | Sequence[str], ascending: bool = False) -> DataFrame:
    """The ``k`` rows with the largest (or smallest) ``by``; ties broken by ``tie_keys``.

    Planned as TakeOrderedAndProject: each partition keeps its own top k, only
    ``k x partitions`` rows reach the final merge.
    """
    order = F.col(by).asc() if ascending else F.col(by).desc()
    return df.orderBy(order, *[F.col(c).asc_nulls_last() for c in _cols(tie_keys)]).limit(k)


def bucketize(c: Column | str, edges: Sequence[float], labels: Sequence[str], keep: Column | None = None) -> Column:
    """CASE chain: ``< edges[0]`` -> labels[0], ..., else labels[-1]; NULL where ``keep`` is false."""
    if len(labels) != len(edges) + 1:
        raise ValueError("need one more label than edges")
    x = F.col(c) if isinstance(c, str) else c
    expr = None
    for edge, label in zip(edges, labels):
        cond = x < F.lit(edge)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    expr = expr.otherwise(F.lit(labels[-1]))
    return expr if keep is None else F.when(keep, expr)


def conditional_counts(df: DataFrame, conditions: Mapping[str, Column], total_col: str | None = "total") -> DataFrame:
    """One row: ``count_if(cond)`` for every named condition (and the row count), in one pass."""
    aggs = [F.count_if(cond).alias(name) for name, cond in conditions.items()]
    if total_col:
        aggs.insert(0, F.count(F.lit(1)).alias(total_col))
    return df.agg(*aggs)


def sector_rollup(
    df: DataFrame,
    code_col: str,
    sectors: Mapping[str, Sequence[str]],
    extra: Mapping[str, tuple[str, Column]] | None = None,
) -> DataFrame:
    """Counts of rows whose code starts with any of a sector's prefixes.

    ``sectors`` maps a sector name to its prefixes; ``extra`` maps a metric name
    to ``(sector, condition)`` for an additional conditional count in that sector.
    One fused aggregate, then a long frame ``(sector, metric, value)``.
    """
    code = F.col(code_col)
    member = {}
    aggs, rows = [], []
    for i, (name, prefixes) in enumerate(sectors.items()):
        cond = None
        for p in prefixes:
            c = code.startswith(p)
            cond = c if cond is None else (cond | c)
        member[name] = cond
        aggs.append(F.count_if(cond).alias(f"_s{i}"))
        rows.append((name, "total", f"_s{i}", i * 10))
    for j, (metric, (sector, extra_cond)) in enumerate((extra or {}).items()):
        aggs.append(F.count_if(member[sector] & extra_cond).alias(f"_e{j}"))
        rows.append((sector, metric, f"_e{j}", list(sectors).index(sector) * 10 + j + 1))
    wide = df.agg(*aggs)
    stacked = ", ".join(f"'{s}', '{m}', {o}, `{c}`" for s, m, c, o in rows)
    return wide.selectExpr(f"stack({len(rows)}, {stacked}) AS (sector, metric, ord, value)").select(
        "sector", "metric", F.col("value").cast("bigint").alias("value"), F.col("ord").cast("int").alias("ord")
    )


def percentile_values(df: DataFrame, value_col: str, qs: Sequence[float], positive_only: bool = False) -> list[Column]:
    """One literal column per percentile, found when called; NULL without rows."""
    kind = df.schema[value_col].dataType
    return [F.lit(v).cast(kind) for v in percentiles_disc(df, value_col, qs, positive_only)]


def amount_stats(
    df: DataFrame,
    amount_col: str,
    positive_only: bool = True,
    percentiles: Sequence[float] = (0.5, 0.9),
) -> DataFrame:
    """Count, sum, mean, max, min and exact percentiles of an amount, plus its share of all rows.

    The filter ``amount > 0`` is folded into the aggregates, so the "share of
    all rows" needs no further scan. The percentiles are found when the
    function is called, by passes over the amount alone (see ``ranks``).
    """
    x = F.col(amount_col)
    sel = x > 0 if positive_only else x.isNotNull()
    y = F.when(sel, x)
    pct_names = [f"p{int(round(q * 100))}" for q in percentiles]
    agg = df.agg(
        F.count(F.lit(1)).alias("_all"),
        F.count(y).alias("n"),
        F.sum(y).alias("total"),
        F.try_divide(F.sum(y).cast("double"), F.count(y).cast("double")).alias("mean"),
        F.max(y).alias("max"),
        F.min(y).alias("min"),
    )
    values = percentile_values(df, amount_col, percentiles, positive_only)
    return agg.select(
        "n",
        F.coalesce("total", F.lit(0)).alias("total"),
        F.coalesce("mean", F.lit(0.0)).alias("mean"),
        F.coalesce("max", F.lit(0)).alias("max"),
        F.coalesce("min", F.lit(0)).alias("min"),
        *[F.coalesce(v, F.lit(0)).alias(n) for v, n in zip(values, pct_names, strict=True)],
        safe_pct(F.col("n"), F.col("_all")).alias("share_pct"),
    )


def null_profile(df: DataFrame, columns: Sequence[str], ok_below: float = 1.0, warn_below: float = 10.0) -> DataFrame:
    """NULL count, share and grade of each column: one aggregate for all columns, then unpivot."""
    wide = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(columns)],
    )
    stacked = ", ".join(f"'{c}', {i}, `_n{i}`" for i, c in enumerate(columns))
    long = wide.selectExpr("_total", f"stack({len(columns)}, {stacked}) AS (column_name, ord, nulls)")
    pct = safe_pct(F.col("nulls"), F.col("_total"))
    return long.select(
        "column_name",
        F.col("ord").cast("int").alias("ord"),
        F.col("nulls").cast("bigint").alias("nulls"),
        pct.alias("null_pct"),
        null_grade(pct, ok_below, warn_below).alias("grade"),
    )
