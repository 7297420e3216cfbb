"""The six registry lookups: seeded catalogues and lookups grown from staging."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.codes import COMPANY_TYPE, normalize_code
from ..functions.text import left
from ..operators.dimensions import grow_dimension
from ..operators.quality import code_values

# Seeded catalogue rows (code, description[, extra]).
SIZES = [
    ("C", "Pequeña Empresa / Microempresa", "Ventas anuales ≤ 1700 UIT"),
    ("M", "Mediana Empresa", "Ventas anuales > 1700 UIT y ≤ 2300 UIT"),
    ("G", "Grande Empresa", "Ventas anuales > 2300 UIT"),
    ("B", "Empresa Básica / Sin clasificar", "Sin criterio definido"),
]
COMPANY_TYPES = [
    ("A", "Persona Natural con Negocio", "PN"),
    ("B", "Persona Jurídica - Sociedad", "PJ"),
    ("CE", "Cooperativa Especial", "CE"),
    ("C", "Cooperativa", "CO"),
    ("D", "Empresa Individual de Responsabilidad Ltda", "EIRL"),
    ("E", "Empresa del Estado", "EE"),
    ("-", "Sin tipo definido", "SD"),
]
STATES = [
    ("ACTIVO", "Contribuyente Activo"),
    ("10", "Baja Temporal"),
    ("11", "Baja Definitiva"),
    ("3", "Suspendido Temporalmente"),
    ("2", "Baja de Oficio"),
    ("1", "Inhabilitado"),
    ("12", "Baja Provisional"),
    ("INACTIVO", "Contribuyente Inactivo"),
    ("ND", "Estado No Determinado"),
]
CONDITIONS = [
    ("HABIDO", "Domicilio Fiscal Habido (Verificado)"),
    ("12", "No Habido - Dirección Inexistente"),
    ("1", "Pendiente de Verificación"),
    ("5", "No Hallado"),
    ("2", "No Existe la Dirección"),
    ("3", "Cerrado"),
    ("4", "Ausente"),
    ("6", "No Habido - Dirección Desconocida"),
    ("7", "No Habido - Rehúsa Recibir"),
    ("8", "No Habido - Temporalmente Ausente"),
    ("9", "No Habido - Otros Motivos"),
    ("10", "No Habido - Mudado sin Informar"),
    ("11", "No Habido - Local Cerrado"),
    ("ND", "Condición No Determinada"),
]
SEED_ACTIVITIES = [("75113", "Actividad económica código 75113", None, "75")]
ACTIVITY_TEXT = "Actividad económica código "
PLACE_PROVINCE = "Santa"
PLACE_DEPARTMENT = "Áncash"
TYPE_TEXT = "Tipo "


@dataclass(frozen=True)
class Lookups:
    activities: DataFrame
    company_types: DataFrame
    sizes: DataFrame
    places: DataFrame
    states: DataFrame
    conditions: DataFrame
    # Lookups whose content is exactly a literal catalogue: name -> its codes.
    # Their foreign-key checks are literal IN lists instead of joins.
    fixed: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def as_dict(self) -> dict[str, DataFrame]:
        return {
            "activities": self.activities, "company_types": self.company_types, "sizes": self.sizes,
            "places": self.places, "states": self.states, "conditions": self.conditions,
        }


def seed_lookups(spark: SparkSession) -> Lookups:
    """The catalogues as declared (places start empty, activities with one code)."""
    mk = spark.createDataFrame
    return Lookups(
        activities=mk(SEED_ACTIVITIES, schemas.ACTIVITY),
        company_types=mk(COMPANY_TYPES, schemas.COMPANY_TYPE),
        sizes=mk(SIZES, schemas.SIZE),
        places=mk([], schemas.PLACE),
        states=mk(STATES, schemas.STATE),
        conditions=mk(CONDITIONS, schemas.CONDITION),
        fixed={
            "company_types": tuple(r[0] for r in COMPANY_TYPES),
            "sizes": tuple(r[0] for r in SIZES),
            "states": tuple(r[0] for r in STATES),
            "conditions": tuple(r[0] for r in CONDITIONS),
        },
    )


# The lookups grown from staging: their key, and the staging column they take.
GROWN_KEYS = {"activities": "id_ciiu", "places": "id_ubicacion", "company_types": "id_tipo_empresa"}


def staged_codes(staging: DataFrame) -> DataFrame:
    """``(name, value, n)``: the different spellings that staging holds for each grown lookup, in one scan.

    Company types are those that their normalisation gives, as in the fact.
    """
    cleaned = F.when(F.col("ddp_tpoemp").isNotNull(), normalize_code("ddp_tpoemp", COMPANY_TYPE))
    return code_values(staging, {"activities": "ddp_ciiu", "places": "ddp_ubigeo", "company_types": cleaned})


def grow_lookups(staging: DataFrame, seeds: Lookups, codes: DataFrame | None = None) -> tuple[Lookups, dict[str, DataFrame]]:
    """Add the staging values missing from the activity, place and company-type lookups.

    ``codes`` are the staging's codes where they are stored (see ``staged_codes``).
    Returns the grown lookups and, per lookup, the rows added.
    """
    codes = staged_codes(staging) if codes is None else codes
    v = F.col("_v")
    build = {
        "activities": {"id_ciiu": v, "descripcion": F.concat(F.lit(ACTIVITY_TEXT), v), "division": left(v, 2)},
        "places": {"id_ubicacion": v, "nombre_distrito": v,
                   "provincia": F.lit(PLACE_PROVINCE), "departamento": F.lit(PLACE_DEPARTMENT)},
        "company_types": {"id_tipo_empresa": v, "descripcion": F.concat(F.lit(TYPE_TEXT), v), "abreviatura": v},
    }
    grown, added = {}, {}
    for name, key in GROWN_KEYS.items():
        grown[name], added[name] = grow_dimension(seeds.as_dict()[name], codes.filter(F.col("name") == name), "value", key, build[name])
    fixed = {k: v for k, v in seeds.fixed.items() if k not in GROWN_KEYS}
    return replace(seeds, **grown, fixed=fixed), added
