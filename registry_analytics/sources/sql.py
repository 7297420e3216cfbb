"""SQL access: registry tables as temp views, parameterised queries."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

# View names of the registry tables.
VIEW_NAMES = {
    "fact": "contribuyente", "activities": "actividad_economica", "company_types": "tipo_empresa",
    "sizes": "tamano_empresa", "places": "ubicacion_geografica", "states": "estado_tributario",
    "conditions": "condicion_domicilio", "star": "vw_contribuyente_completo",
}


def register_views(spark: SparkSession, tables: Mapping[str, DataFrame]) -> list[str]:
    """Register each named frame as a session temp view (``VIEW_NAMES`` maps known names)."""
    names = []
    for key, df in tables.items():
        name = VIEW_NAMES.get(key, key)
        df.createOrReplaceTempView(name)
        names.append(name)
    return names


def query(spark: SparkSession, text: str, params: Mapping[str, Any] | None = None) -> DataFrame:
    """Run SQL with named parameters (``:name`` markers); values are bound, never pasted in."""
    return spark.sql(text, args=dict(params or {}))
