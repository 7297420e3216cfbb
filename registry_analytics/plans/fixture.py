"""Registry staging derived from the driver's TPC-H-style tables.

The driver tables are clean, so the registry jobs get a deterministic dirty
staging frame computed from ``orders JOIN customer JOIN nation``: every order
becomes one registry row whose codes are dirtied by rule from its key.  The
work grows with ``orders``; the joins are a shuffle join with ``customer`` and
a broadcast of the 25-row ``nation``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(k: Column, values: Sequence[str | None]) -> Column:
    """``values[k % len(values)]`` from a literal array (one lookup, no CASE chain)."""
    arr = F.array(*[F.lit(v).cast("string") for v in values])
    return F.get(arr, (k % F.lit(len(values))).cast("int"))


# The dirty code cycles of the staging fixture.
TPOEMP_CYCLE = ("A", "B", "CE", "C", "D", "E", "-", "A7", "B9", "AA", "zz", " a ")
TAMANO_CYCLE = ("C", "M", "G", "B", "X", "c", None)
ESTADO_CYCLE = ("ACTIVO", "2ACTIVO", "10", "11", "3", "2", "1", "12", "INACTIVO", "99", "activo ")
FLAG22_CYCLE = ("HABIDO", "2HABIDO", "1", "12", "13", "5", "habido", "ZZ", "7")
SEXO_CYCLE = ("HOMBRE", "MUJER", "hombre", "X", None)


def dirty_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed staging rows (staging schema + ``seq``), one per order."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = (o.join(c, o.o_custkey == c.c_custkey, "inner")
          .join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"), "inner"))
    k = F.col("o_orderkey")
    return j.select(
        k.alias("seq"),
        (k + F.lit(9000) - F.when(k % 50 == 0, F.lit(1)).otherwise(F.lit(0))).alias("ddp_numruc"),
        F.when(k % 97 == 0, F.lit(None).cast("string"))
         .otherwise((F.lit(1000) + (k * 37) % 9000).cast("string")).alias("ddp_ciiu"),
        _pick(k, TPOEMP_CYCLE).alias("ddp_tpoemp"),
        _pick(k, TAMANO_CYCLE).alias("ddp_tamano"),
        F.when(k % 3 == 0, F.lower("n_name")).otherwise(F.col("n_name")).alias("ddp_ubigeo"),
        _pick(k, ESTADO_CYCLE).alias("ddp_estado"),
        _pick(k, FLAG22_CYCLE).alias("ddp_flag22"),
        _pick(k, SEXO_CYCLE).alias("dds_sexo"),
        F.when(k % 13 == 0, F.lit(None).cast("int")).otherwise((k % 131).cast("int")).alias("dds_edad"),
        F.when(k % 4 == 0, F.lit(0).cast("decimal(18,2)"))
         .otherwise(F.col("c_acctbal").cast("decimal(18,2)")).alias("deuda"),
        F.lit(0).cast("int").alias("condicion"),
    )


def raw_text_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staging fixture as CSV-like text, with blank, padded and unparsable values.

    Every row is kept; rule-chosen rows get a blank key, a decimal key text,
    padded numbers, a non-numeric age or debt, a blank debt, or an
    over-long company type.
    """
    s = dirty_staging(spark, sf_dir)
    k = F.col("seq")
    txt = lambda c: F.col(c).cast("string")
    pad = lambda e: F.when(k % 5 == 1, F.concat(F.lit(" "), e, F.lit(" "))).otherwise(e)
    return s.select(
        "seq",
        F.when(k % 23 == 0, F.lit(""))
         .when(k % 29 == 0, F.concat(txt("ddp_numruc"), F.lit(".0")))
         .otherwise(pad(txt("ddp_numruc"))).alias("ddp_numruc"),
        "ddp_ciiu",
        F.when(k % 41 == 0, F.lit("ABCDEFG")).otherwise(F.col("ddp_tpoemp")).alias("ddp_tpoemp"),
        "ddp_tamano", "ddp_ubigeo", "ddp_estado", "ddp_flag22", "dds_sexo",
        F.when(k % 31 == 0, F.lit("x")).otherwise(pad(F.coalesce(txt("dds_edad"), F.lit("")))).alias("dds_edad"),
        F.when(k % 37 == 0, F.lit("")).when(k % 43 == 0, F.lit("n/a"))
         .otherwise(pad(txt("deuda"))).alias("deuda"),
        F.when(k % 7 == 3, F.lit("")).otherwise(txt("condicion")).alias("condicion"),
    )


def rule_breaking_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact-shaped rows of the staging fixture as they come, without normalisation, with missing, negative,
    unknown and over-long values chosen by rule from the key: every rule of the fact is broken by some row."""
    k = F.col("seq")
    every = lambda n: k % n == 0
    none = lambda: F.lit(None)
    many = lambda c, n: F.lit(c * n)
    return dirty_staging(spark, sf_dir).select(
        F.when(every(101), none()).when(every(103), -k).otherwise(F.col("ddp_numruc")).alias("ruc"),
        F.when(every(107), many("9", 12)).when(every(109), F.concat(F.lit("X"), "ddp_ciiu")).otherwise(F.col("ddp_ciiu")).alias("id_ciiu"),
        F.when(every(113), none()).when(every(127), F.lit("ABCDEFG")).otherwise(F.col("ddp_tpoemp")).alias("id_tipo_empresa"),
        F.when(every(131), F.lit("TOOLONG")).otherwise(F.col("ddp_tamano")).alias("id_tamano"),
        F.when(every(137), none()).when(every(139), many("Z", 101)).when(every(149), F.lit("NOWHERE")).otherwise(F.col("ddp_ubigeo")).alias("id_ubicacion"),
        F.when(every(151), none()).when(every(157), many("E", 51)).otherwise(F.col("ddp_estado")).alias("id_estado"),
        F.when(every(163), none()).when(every(167), many("C", 51)).otherwise(F.col("ddp_flag22")).alias("id_condicion"),
        F.when(every(173), many("S", 21)).otherwise(F.col("dds_sexo")).alias("sexo"),
        F.col("dds_edad").alias("edad"),
        F.when(every(179), none()).when(every(181), F.lit(-1).cast("decimal(18,2)")).otherwise(F.col("deuda")).alias("deuda"),
        F.when(every(191), many("F", 51)).otherwise(F.col("ddp_flag22")).alias("flag22"),
    )
