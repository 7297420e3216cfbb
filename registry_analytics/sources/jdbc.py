"""JDBC source and sink with parallel, bounded reads.

Connection details always come from the caller; nothing is stored here.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

#: Histogram buckets counted for each partition wanted.
BUCKETS_PER_PARTITION = 32


def jdbc_options(
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int = 4,
    fetch_size: int = 1000,
) -> dict[str, str]:
    """Options for ``spark.read.format("jdbc")``.

    ``numPartitions`` alone does not split a read: without a partition column
    and bounds Spark reads the table in one task.  With them it issues one
    range query per partition.
    """
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    opts.update({k: str(v) for k, v in (properties or {}).items()})
    if partition_column is not None:
        if lower_bound is None or upper_bound is None:
            raise ValueError("partition_column needs lower_bound and upper_bound")
        opts.update(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(num_partitions),
        )
    return opts


def bounds_query(table: str, column: str) -> str:
    """The least and greatest key, one row."""
    return f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) b"


def bucket_width(bounds: tuple[int, int], buckets: int) -> int:
    """Keys in each of at most ``buckets`` equal ranges."""
    return max(1, -(-(bounds[1] - bounds[0] + 1) // buckets))


def histogram_query(table: str, column: str, bounds: tuple[int, int], buckets: int) -> str:
    """Rows in each of ``buckets`` equal key ranges, counted by the database: at most ``buckets`` rows come back."""
    place = f"FLOOR(({column} - ({bounds[0]})) / {bucket_width(bounds, buckets)})"
    return f"(SELECT {place} AS bucket, COUNT(*) AS n FROM {table} WHERE {column} IS NOT NULL GROUP BY {place}) h"


def balanced_cuts(counts: Mapping[int, int], bounds: tuple[int, int], buckets: int, num_partitions: int) -> list[int]:
    """First keys of the second and later of ``num_partitions`` ranges with about equal numbers of rows.

    A cut lies where the running count reaches the next share, inside a bucket in proportion to its count:
    a bucket that holds several shares is divided into as many. Ranges without keys are left out.
    """
    lo, hi = bounds
    width = bucket_width(bounds, buckets)
    total = sum(counts.values())
    cuts: list[int] = []
    seen, share = 0, 1
    for bucket in sorted(counts):
        n = counts[bucket]
        while n and share < num_partitions and total * share <= (seen + n) * num_partitions:
            inside = total * share - seen * num_partitions  # rows of the bucket before the cut, times num_partitions
            cut = lo + bucket * width + -(-inside * width // (n * num_partitions))
            if (not cuts or cut > cuts[-1]) and lo < cut <= hi:
                cuts.append(cut)
            share += 1
        seen += n
    return cuts


def range_predicates(column: str, cuts: Sequence[int]) -> list[str]:
    """One predicate per range; each row, one with a NULL key too, fulfils exactly one of them."""
    if not cuts:
        return ["1 = 1"]
    middle = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *middle, f"{column} >= {cuts[-1]}"]


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    num_partitions: int = 4,
    fetch_size: int = 1000,
    bounds: tuple[int, int] | None = None,
) -> DataFrame:
    """Read a table over JDBC, split by the integer ``partition_column`` into ranges of about equal row counts.

    The database first gives the least and greatest key (unless ``bounds`` are
    given; keys outside them go to the first or last range), then the row counts of ``BUCKETS_PER_PARTITION`` equal
    key ranges per partition: two queries of a bounded number of rows.  Keys
    that come in runs do not leave most rows to one task, as equal ranges would.
    Filters and column selections on the result are pushed into the generated
    SQL by Spark.
    """
    properties = {k: str(v) for k, v in (properties or {}).items()}

    def ask(text: str) -> list:
        return spark.read.format("jdbc").options(**jdbc_options(url, text, properties, fetch_size=fetch_size)).load().collect()

    if partition_column is None:
        return spark.read.format("jdbc").options(**jdbc_options(url, table, properties, fetch_size=fetch_size)).load()
    if bounds is None:
        lo, hi = ask(bounds_query(table, partition_column))[0]  # by position: some databases upper-case the aliases
        bounds = (int(lo or 0), int(hi or 0))
    buckets = BUCKETS_PER_PARTITION * num_partitions
    counts: dict[int, int] = {}
    for bucket, n in ask(histogram_query(table, partition_column, bounds, buckets)):
        inside = min(max(int(bucket), 0), buckets - 1)
        counts[inside] = counts.get(inside, 0) + int(n)
    predicates = range_predicates(partition_column, balanced_cuts(counts, bounds, buckets, num_partitions))
    return spark.read.jdbc(url, table, predicates=predicates, properties={**properties, "fetchsize": str(fetch_size)})


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None,
               mode: str = "append", batch_size: int = 500) -> None:
    """Append (or overwrite) rows over JDBC in batches, one connection per task."""
    opts = {"url": url, "dbtable": table, "batchsize": str(batch_size)}
    opts.update({k: str(v) for k, v in (properties or {}).items()})
    df.write.format("jdbc").mode(mode).options(**opts).save()
