"""Bounded samples of tables of any size, to teach a model with."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def lowest(rows: DataFrame, by: tuple[str, ...], most: int) -> DataFrame:
    """The ``most`` different rows with the lowest hash of the columns ``by`` (ties by all columns); all, if there are fewer.

    One pass counts the different hashes; a second one keeps only hashes below a share of their range that
    holds about twice ``most``. So what meets to be ordered doesn't grow with the table, its
    partitions or copies of a row. The share is doubled where it holds too few: the result is exact.
    """
    keyed = rows.withColumn("_hash", F.xxhash64(*by))
    total = keyed.agg(F.approx_count_distinct("_hash")).first()[0]
    share = 2 * most / max(total, 1)
    while True:
        some = (keyed.where(F.col("_hash") < int(share * 2.0**64) - 2**63) if share < 1 else keyed).distinct()
        if share >= 1 or some.count() >= most:
            return some.orderBy("_hash", *rows.columns).limit(most).drop("_hash")
        share *= 2
