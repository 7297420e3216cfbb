"""Staging -> fact: filter, normalise, de-duplicate, check rules, split.

The order is fixed: filter -> normalise -> first-row-wins de-dup -> rules.  A
key is taken by its first row *before* the rules run, so when that row is
rejected its later duplicates are dropped too.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import COMPANY_TYPE, CONDITION, SEX, SIZE, STATE, clamp_amount, normalize_code
from ..functions.text import key_form, strip_ws
from ..operators.dedup import first_wins
from ..operators.dimensions import insert_if_absent
from ..operators.joins import lookup_label
from ..operators.quality import Rule, broken_rules, drop_fk_flags, fk_rules, unknown_values
from ..schemas import FACT, FACT_COLUMNS, FACT_LENGTHS
from .lookups import Lookups

REQUIRED_STAGING = ("ddp_ciiu", "ddp_tpoemp", "ddp_tamano", "ddp_ubigeo", "ddp_estado", "ddp_flag22")
MIN_KEY = 10000

# The registry's special row, inserted when its key is absent.
SPECIAL_ROWS = [
    (611077, "75113", "A", "C", "CHIMBOTE", "ACTIVO", "HABIDO", "ND", 0, Decimal("0.00"), "HABIDO"),
]
SEXES = ("HOMBRE", "MUJER", "ND")
AGE_RANGE = (0, 120)


def is_candidate() -> Column:
    """A plausible key and every required code present."""
    cond = F.col("ddp_numruc") >= F.lit(MIN_KEY)
    for c in REQUIRED_STAGING:
        cond = cond & F.col(c).isNotNull()
    return cond


def candidates(staging: DataFrame) -> DataFrame:
    """The rows that may enter the fact (pushed to the scan)."""
    return staging.filter(is_candidate())


CODE_COLUMNS = {
    "ddp_tpoemp": ("id_tipo_empresa", COMPANY_TYPE),
    "ddp_tamano": ("id_tamano", SIZE),
    "ddp_estado": ("id_estado", STATE),
    "ddp_flag22": ("id_condicion", CONDITION),
    "dds_sexo": ("id_sexo", SEX),
}


def normalize(staging: DataFrame, order_col: str = "seq") -> DataFrame:
    """Staging columns -> fact columns (clean codes, clamped debt, raw condition kept).

    Two projections: the normal form of every code first, then the CASE of each
    code over it, so the generated code stays small and the JIT compiles it.
    """
    pre = staging.select(
        "ddp_numruc", "ddp_ciiu", "ddp_ubigeo", "dds_edad", "deuda", F.col(order_col).alias("_seq"),
        *CODE_COLUMNS,
        *[F.upper(strip_ws(c)).alias(f"_v_{c}") for c in CODE_COLUMNS],
    )
    code = {out: normalize_code(c, spec, F.col(f"_v_{c}")) for c, (out, spec) in CODE_COLUMNS.items()}
    return pre.select(
        F.col("ddp_numruc").alias("ruc"),
        F.col("ddp_ciiu").alias("id_ciiu"),
        code["id_tipo_empresa"].alias("id_tipo_empresa"),
        code["id_tamano"].alias("id_tamano"),
        F.col("ddp_ubigeo").alias("id_ubicacion"),
        code["id_estado"].alias("id_estado"),
        code["id_condicion"].alias("id_condicion"),
        code["id_sexo"].alias("sexo"),
        F.col("dds_edad").alias("edad"),
        clamp_amount(F.col("deuda").cast("decimal(18,2)")).cast("decimal(18,2)").alias("deuda"),
        F.col("ddp_flag22").alias("flag22"),
        "_seq",
    )


FOREIGN_KEYS = [  # rule name, fact column, lookup name, lookup key
    ("fk_activity", "id_ciiu", "activities", "id_ciiu"),
    ("fk_company_type", "id_tipo_empresa", "company_types", "id_tipo_empresa"),
    ("fk_size", "id_tamano", "sizes", "id_tamano"),
    ("fk_place", "id_ubicacion", "places", "id_ubicacion"),
    ("fk_state", "id_estado", "states", "id_estado"),
    ("fk_condition", "id_condicion", "conditions", "id_condicion"),
]


def unknown_codes(codes: DataFrame, lookups: Lookups) -> DataFrame:
    """``(name, value)``: the stored staging codes (``name`` = lookup) that their lookup lacks, under their rule's name.

    Found from codes and lookups alone; no rows when the lookups have been grown from the same codes.
    """
    rule = {dim: name for name, _, dim, _ in FOREIGN_KEYS}
    grown = {dim: (lookups.as_dict()[dim], key) for _, _, dim, key in FOREIGN_KEYS if dim not in lookups.fixed}
    missing = unknown_values(codes.filter(F.col("name").isin(*grown)), grown)
    return missing.select(lookup_label("name", rule).alias("name"), "value")


def fact_rules(lookups: Lookups, df: DataFrame, unknown: DataFrame | None = None) -> tuple[DataFrame, list[Rule]]:
    """NOT NULL, CHECK, length and foreign-key rules of the fact table.

    A lookup that is a fixed literal catalogue is checked with a literal IN
    list; for a lookup grown from data, rows take the flag of their code.
    """
    rules = [Rule(f"not_null_{f.name}", F.col(f.name).isNotNull()) for f in FACT.fields if not f.nullable]
    rules += [
        Rule("sexo_valid", F.col("sexo").isin(*SEXES)),
        Rule("edad_range", F.col("edad").between(*AGE_RANGE)),
        Rule("deuda_non_negative", F.col("deuda") >= 0),
        Rule("ruc_positive", F.col("ruc") > 0),
    ]
    rules += [Rule(f"length_{c}", F.length(c) <= n) for c, n in FACT_LENGTHS.items()]
    dims = lookups.as_dict()
    joined = []
    for name, col, dim, key in FOREIGN_KEYS:
        if dim in lookups.fixed:
            rules.append(Rule(name, key_form(col).isin(*lookups.fixed[dim]) | F.col(col).isNull()))
        else:
            joined.append((name, col, dims[dim], key))
    df, fks = fk_rules(df, joined, unknown=unknown)
    return df, rules + fks


def flag_rules(df: DataFrame, lookups: Lookups, flag_col: str = "broken_rules", unknown: DataFrame | None = None) -> DataFrame:
    """Rows with the array of the names of the rules they break (empty when valid)."""
    flagged, rules = fact_rules(lookups, df, unknown)
    return drop_fk_flags(flagged.withColumn(flag_col, broken_rules(rules)))


def dedup_and_flag(rows: DataFrame, lookups: Lookups, unknown: DataFrame | None = None) -> DataFrame:
    """The first row of each key (by ``_seq``) with the names of the rules it breaks.

    Code flags are taken before the rows are exchanged by key, so nothing is joined after that.
    """
    flagged, rules = fact_rules(lookups, rows, unknown)
    return drop_fk_flags(first_wins(flagged, "ruc", ["_seq"]).drop("_seq").withColumn("broken_rules", broken_rules(rules)))


def check_rules(df: DataFrame, lookups: Lookups) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)``: rejected rows keep ``broken_rules``."""
    return split_flagged(flag_rules(df, lookups))


def split_flagged(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    valid = flagged.filter(F.size("broken_rules") == 0).drop("broken_rules")
    rejected = flagged.filter(F.size("broken_rules") > 0)
    return valid, rejected


@dataclass(frozen=True)
class Migration:
    candidates: DataFrame   # after key / NOT NULL filter
    deduped: DataFrame      # after normalise and first-row-wins
    fact: DataFrame         # valid rows, fact columns
    rejected: DataFrame     # rows that broke a rule, with ``broken_rules``
    special: DataFrame      # special rows inserted (valid ones)


def migrate(staging: DataFrame, lookups: Lookups, order_col: str = "seq", special_rows=SPECIAL_ROWS,
            unknown: DataFrame | None = None) -> Migration:
    """The whole staging -> fact job as one lazy plan.  ``unknown`` are the stored codes that their lookup lacks
    (``unknown_codes``); without them they are found from the rows."""
    cand = candidates(staging)
    flagged = dedup_and_flag(normalize(cand, order_col), lookups, unknown)
    deduped = flagged.drop("broken_rules")
    valid, rejected = split_flagged(flagged)
    valid = valid.select(*FACT_COLUMNS)
    spark = staging.sparkSession
    special = spark.createDataFrame(special_rows, FACT) if special_rows else None
    if special is not None:
        _, inserted = insert_if_absent(valid, special, "ruc", known_keys=[r[0] for r in special_rows])
        special_ok, special_bad = check_rules(inserted, lookups)
        fact = valid.unionByName(special_ok.select(*FACT_COLUMNS))
        rejected = rejected.unionByName(special_bad)
    else:
        special_ok, fact = spark.createDataFrame([], FACT), valid
    return Migration(cand, deduped, fact, rejected, special_ok)
