"""Declared schemas of the registry tables."""

from pyspark.sql import types as T

# Raw CSV header of the registry export (all text).
RAW_COLUMNS = (
    "ddp_numruc", "ddp_ciiu", "ddp_tpoemp", "ddp_tamano", "ddp_ubigeo",
    "ddp_estado", "ddp_flag22", "dds_sexo", "dds_edad", "deuda", "condicion",
)

STAGING = T.StructType([
    T.StructField("ddp_numruc", T.LongType()),
    T.StructField("ddp_ciiu", T.StringType()),
    T.StructField("ddp_tpoemp", T.StringType()),
    T.StructField("ddp_tamano", T.StringType()),
    T.StructField("ddp_ubigeo", T.StringType()),
    T.StructField("ddp_estado", T.StringType()),
    T.StructField("ddp_flag22", T.StringType()),
    T.StructField("dds_sexo", T.StringType()),
    T.StructField("dds_edad", T.IntegerType()),
    T.StructField("deuda", T.DecimalType(18, 2)),
    T.StructField("condicion", T.IntegerType()),
])

# Declared text lengths (VARCHAR(n)) of staging and fact columns.
STAGING_LENGTHS = {
    "ddp_ciiu": 10, "ddp_tpoemp": 5, "ddp_tamano": 5, "ddp_ubigeo": 100,
    "ddp_estado": 50, "ddp_flag22": 50, "dds_sexo": 20,
}
FACT_LENGTHS = {
    "id_ciiu": 10, "id_tipo_empresa": 5, "id_tamano": 5, "id_ubicacion": 100,
    "id_estado": 50, "id_condicion": 50, "sexo": 20, "flag22": 50,
}

FACT = T.StructType([
    T.StructField("ruc", T.LongType(), False),
    T.StructField("id_ciiu", T.StringType(), False),
    T.StructField("id_tipo_empresa", T.StringType(), False),
    T.StructField("id_tamano", T.StringType(), False),
    T.StructField("id_ubicacion", T.StringType(), False),
    T.StructField("id_estado", T.StringType(), False),
    T.StructField("id_condicion", T.StringType(), False),
    T.StructField("sexo", T.StringType(), False),
    T.StructField("edad", T.IntegerType(), True),
    T.StructField("deuda", T.DecimalType(18, 2), False),
    T.StructField("flag22", T.StringType(), True),
])

FACT_COLUMNS = tuple(f.name for f in FACT.fields)

ACTIVITY = "id_ciiu string, descripcion string, seccion string, division string"
COMPANY_TYPE = "id_tipo_empresa string, descripcion string, abreviatura string"
SIZE = "id_tamano string, descripcion string, criterio_ventas string"
PLACE = "id_ubicacion string, nombre_distrito string, provincia string, departamento string, ubigeo_codigo string"
STATE = "id_estado string, descripcion string"
CONDITION = "id_condicion string, descripcion string"
