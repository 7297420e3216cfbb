"""Joins and connected components that hold up when one key has a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: A key is a hub if it has more than this share of all rows: at most a thousand keys can be hubs.
HUB_SHARE = 0.001


def hub_join(rows: DataFrame, per_key: DataFrame, key: str, count: str = "n") -> DataFrame:
    """``rows`` with the columns of ``per_key`` (one row a key, null included, with the key's number of ``rows`` as ``count``), but not ``count``.

    Rows of hubs are joined where they are, with the broadcast hubs, at most 1 / HUB_SHARE rows; all others
    meet by key, and no key brings more than that share of the rows to one task. Keys of ``rows`` that
    ``per_key`` lacks go.
    """
    total = per_key.agg(F.sum(count)).scalar()
    is_hub = F.col(count) > F.lit(HUB_SHARE) * total
    hubs, others = per_key.where(is_hub), per_key.where(~is_hub)
    columns = [c for c in per_key.columns if c not in (key, count)]

    def joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        right = right.withColumnRenamed(key, "_hub_key")
        out = left.join(right, left[key].eqNullSafe(right["_hub_key"]), how)
        return out.drop("_hub_key")

    with_hubs = joined(rows, F.broadcast(hubs.select(key, *columns)), "inner")
    without = joined(rows, F.broadcast(hubs.select(key)), "left_anti")
    return with_hubs.unionByName(joined(without, others.select(key, *columns).hint("merge"), "inner"))


def components(edges: DataFrame, folder: str) -> DataFrame:
    """``node, root`` (smallest member) of every node in ``edges`` (``a, b`` of one orderable type).

    Alternating large-star and small-star steps until every node has one parent that has none itself. Each
    step's tables are written under ``folder``; a hub's neighbours are joined where they are.
    """
    spark = edges.sparkSession

    def write(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    now = write(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges-0")
    step = 0
    while True:
        ends = now.select(F.col("a").alias("node"), F.lit(1).alias("up")).union(now.select("b", F.lit(0)))
        chained = ends.groupBy("node").agg(F.sum("up").alias("parents"), F.min("up").alias("least")).where("parents > 1 OR (parents = 1 AND least = 0)")
        if chained.isEmpty():
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
        step += 1
        # large star: a node's greater neighbours move to the smallest of its neighbours and itself
        both = now.union(now.select("b", "a"))
        least = write(both.groupBy("a").agg(F.min("b").alias("m"), F.count_if(F.col("b") > F.col("a")).alias("n")).select("a", F.least("a", "m").alias("m"), "n"), f"least-{step}")
        large = write(hub_join(both.where("b > a"), least.where("n > 0"), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct(), f"large-{step}")
        # small star: a node and its smaller neighbours move to the smallest of them
        lower = write(large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")), f"lower-{step}")
        small = hub_join(large, lower, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        now = write(small.union(lower.select("a", "m")).distinct(), f"edges-{step}")
