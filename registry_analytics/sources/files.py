"""File sources and sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT_COL = "_corrupt_record"


def read_csv_raw(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str],
    encoding: str = "ISO-8859-1",
    sep: str = ",",
    keep_position: bool = True,
    multiline: bool = False,
) -> DataFrame:
    """Header CSV, ``columns`` found by name in any order, as text, bad lines kept and flagged.

    Further columns of the file are ignored; a missing one is a ``ValueError``,
    and so is (at the first action) a file whose header differs from the first
    file's.  Quoting is standard: ``""`` is a quote inside quotes and a
    backslash is plain text.  Line breaks inside quotes need ``multiline``,
    which makes each file one task's work.

    PERMISSIVE mode with a corrupt-record column: a line with fewer or more
    fields than the header gets its raw text in ``_corrupt_record`` instead of
    failing the job.  With ``keep_position`` the file path and the row's block
    start are kept as ``_file`` / ``_block`` and a per-partition ``_pos``, which
    together follow file order even when a file is split across tasks.
    """
    options = {
        "header": "true", "encoding": encoding, "sep": sep, "quote": '"', "escape": '"',
        "multiLine": str(multiline).lower(), "mode": "PERMISSIVE",
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    }
    names = spark.read.options(**options).csv(path).columns  # reads the first header only
    missing = [c for c in columns if c not in names]
    if missing:
        raise ValueError(f"columns not in the CSV header: {', '.join(missing)}")
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in [*names, CORRUPT_COL]])
    df = spark.read.schema(schema).options(**options, columnNameOfCorruptRecord=CORRUPT_COL, enforceSchema="false").csv(path)
    kept = [*columns, CORRUPT_COL]
    if keep_position:
        return df.select(
            *kept,
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_pos"),
        )
    return df.select(*kept)


def write_csv(df: DataFrame, path: str, encoding: str = "ISO-8859-1", mode: str = "overwrite") -> None:
    """Header CSV in the given encoding (blank strings stay blank, NULL becomes empty)."""
    (
        df.write.mode(mode)
        .option("header", "true")
        .option("encoding", encoding)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Write a plain parquet folder. Overwriting deletes the old files first: a table that readers or a
    failing job must not lose is replaced with ``versions.replace_table`` instead."""
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def has_rows(df: DataFrame, min_rows: int = 1) -> bool:
    """True when ``df`` has at least ``min_rows`` rows; stops reading once it has them."""
    try:
        return df.limit(min_rows).count() >= min_rows
    except Exception as e:  # a missing table means "no data", as in the load gate
        if "PATH_NOT_FOUND" in str(e) or "TABLE_OR_VIEW_NOT_FOUND" in str(e):
            return False
        raise


def table_has_rows(spark: SparkSession, path: str, min_rows: int = 1) -> bool:
    """Load gate on a stored table: False when the table does not exist, else :func:`has_rows`."""
    try:
        df = spark.read.parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return False
        raise
    return has_rows(df, min_rows)


def table_counts(tables: Mapping[str, DataFrame], name_col: str = "table_name", count_col: str = "n_rows") -> DataFrame:
    """Row count of every named table as one frame (one job, zero-row tables kept)."""
    parts = [df.select(F.lit(name).alias(name_col)) for name, df in tables.items()]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    counts = union.groupBy(name_col).agg(F.count(F.lit(1)).alias(count_col))
    spark = union.sparkSession
    names = spark.createDataFrame([(n,) for n in tables], f"{name_col} string")
    return names.join(counts, name_col, "left").select(
        name_col, F.coalesce(F.col(count_col), F.lit(0)).cast("bigint").alias(count_col)
    )


def count_on_read(df: DataFrame, name: str = "rows_read") -> tuple[DataFrame, Observation]:
    """Count rows as a side effect of the first action on ``df`` (no extra pass)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
