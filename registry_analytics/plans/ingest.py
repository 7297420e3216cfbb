"""Raw registry rows -> typed staging rows + quarantine (no row passes the driver)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import blank_to_null
from ..schemas import RAW_COLUMNS, STAGING_LENGTHS
from ..sources.files import CORRUPT_COL, read_csv_raw

TEXT_COLUMNS = ("ddp_ciiu", "ddp_tpoemp", "ddp_tamano", "ddp_ubigeo", "ddp_estado", "ddp_flag22", "dds_sexo")

# Quarantine reasons, in precedence order.
REASONS = ("ragged", "parse_error", "blank_key", "too_long")


NUMBERS = {  # column -> (type, default for blank text)
    "ddp_numruc": ("bigint", None),
    "dds_edad": ("int", None),
    "deuda": ("decimal(18,2)", 0),
    "condicion": ("int", 0),
}


def parse_staging(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Typed staging columns plus ``reason`` (NULL for a good row).

    Numbers: blank key and blank age give NULL, blank debt 0.00 and blank
    condition 0; text that does not parse is a ``parse_error``.  All four
    numbers are parsed before the key test, so a blank key with a bad age is a
    parse error, and a blank key alone is ``blank_key``.  Text is stripped,
    blank becomes NULL, and text longer than its declared length is
    ``too_long``.  A line with the wrong number of fields is ``ragged``.

    Three narrow projections (strip once; cast once; decide) keep every
    expression computed once per row and the generated code small.
    """
    has_corrupt = CORRUPT_COL in raw.columns
    stripped = raw.select(
        *keep,
        *[blank_to_null(c).alias(c) for c in TEXT_COLUMNS],
        *[blank_to_null(c).alias(f"_s_{c}") for c in NUMBERS],
        (F.col(CORRUPT_COL).isNotNull() if has_corrupt else F.lit(False)).alias("_ragged"),
    )
    casted = stripped.select(
        *keep, *TEXT_COLUMNS, "_ragged",
        *[F.col(f"_s_{c}").isNull().alias(f"_blank_{c}") for c in NUMBERS],
        *[F.col(f"_s_{c}").try_cast(t).alias(f"_v_{c}") for c, (t, _) in NUMBERS.items()],
    )
    bad = None
    for c in NUMBERS:
        b = ~F.col(f"_blank_{c}") & F.col(f"_v_{c}").isNull()
        bad = b if bad is None else (bad | b)
    too_long = None
    for c, n in STAGING_LENGTHS.items():
        t = F.coalesce(F.length(c) > n, F.lit(False))
        too_long = t if too_long is None else (too_long | t)
    values = {
        c: F.when(F.col(f"_blank_{c}"), F.lit(d).cast(t)).otherwise(F.col(f"_v_{c}"))
        for c, (t, d) in NUMBERS.items()
    }
    reason = (
        F.when(F.col("_ragged"), F.lit("ragged"))
        .when(bad, F.lit("parse_error"))
        .when(F.col("_blank_ddp_numruc"), F.lit("blank_key"))
        .when(too_long, F.lit("too_long"))
    )
    return casted.select(
        *keep,
        values["ddp_numruc"].alias("ddp_numruc"),
        *TEXT_COLUMNS,
        values["dds_edad"].alias("dds_edad"),
        values["deuda"].alias("deuda"),
        values["condicion"].alias("condicion"),
        reason.alias("reason"),
    )


def split_staging(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(staging, quarantine)`` from :func:`parse_staging` output."""
    staging = parsed.filter(F.col("reason").isNull()).drop("reason")
    quarantine = parsed.filter(F.col("reason").isNotNull())
    return staging, quarantine


def read_registry_csv(spark: SparkSession, path: str, encoding: str = "ISO-8859-1", multiline: bool = False) -> DataFrame:
    """Raw registry CSV with a file-order sequence usable for first-row-wins."""
    raw = read_csv_raw(spark, path, RAW_COLUMNS, encoding=encoding, multiline=multiline)
    # (file, block start, id within the task) follows file order across splits.
    return raw.withColumn("seq", F.struct("_file", "_block", "_pos")).drop("_file", "_block", "_pos")

