"""De-duplication by key: first row wins under an explicit order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_wins(df: DataFrame, keys: str | Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Keep, per key, the first row by ``order`` (which must be a total order within a key).

    ``row_number() = 1`` is planned with a partial WindowGroupLimit before the
    shuffle: every input partition keeps one row per key before rows move, so a
    key holding a large share of the rows does not travel whole to one task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = Window.partitionBy(*keys).orderBy(*[F.col(c) if isinstance(c, str) else c for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def duplicate_keys(df: DataFrame, keys: str | Sequence[str], count_col: str = "n") -> DataFrame:
    """Keys that occur more than once, with their row counts (unique-key rule)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias(count_col))
        .filter(F.col(count_col) > 1)
    )
