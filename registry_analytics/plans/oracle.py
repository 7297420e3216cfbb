"""DuckDB SQL equivalents of the named queries (the correctness oracle).

Each string runs on the driver's parquet tables registered as views.  The
registry chain (staging -> candidates -> normalise -> first-row-wins ->
lookups -> rules -> fact) is written once as CTEs over a staging source and
reused by every query.  Decimals are summed exactly and reported as doubles,
means are ``sum / count`` in double, as on the Spark side.
"""

from __future__ import annotations

# Fixed values in this module: code lists, seeded catalogue rows, labels, table, column and analysis names
# that must equal those of the Spark side.

# --- staging sources ----------------------------------------------------------------

DIRTY = """
dirty AS (
  SELECT k AS seq,
    k + 9000 - CASE WHEN k % 50 = 0 THEN 1 ELSE 0 END AS ddp_numruc,
    CASE WHEN k % 97 = 0 THEN NULL ELSE CAST(1000 + (k * 37) % 9000 AS VARCHAR) END AS ddp_ciiu,
    (['A','B','CE','C','D','E','-','A7','B9','AA','zz',' a '])[k % 12 + 1] AS ddp_tpoemp,
    (['C','M','G','B','X','c',NULL])[k % 7 + 1] AS ddp_tamano,
    CASE WHEN k % 3 = 0 THEN lower(n_name) ELSE n_name END AS ddp_ubigeo,
    (['ACTIVO','2ACTIVO','10','11','3','2','1','12','INACTIVO','99','activo '])[k % 11 + 1] AS ddp_estado,
    (['HABIDO','2HABIDO','1','12','13','5','habido','ZZ','7'])[k % 9 + 1] AS ddp_flag22,
    (['HOMBRE','MUJER','hombre','X',NULL])[k % 5 + 1] AS dds_sexo,
    CASE WHEN k % 13 = 0 THEN NULL ELSE CAST(k % 131 AS INTEGER) END AS dds_edad,
    CASE WHEN k % 4 = 0 THEN CAST(0 AS DECIMAL(18,2)) ELSE CAST(c_acctbal AS DECIMAL(18,2)) END AS deuda,
    CAST(0 AS INTEGER) AS condicion
  FROM (SELECT o_orderkey AS k, c_acctbal, n_name
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
)"""


def _pad(e: str) -> str:
    return f"CASE WHEN seq % 5 = 1 THEN ' ' || {e} || ' ' ELSE {e} END"


RAW_TEXT = f"""
raw AS (
  SELECT seq,
    CASE WHEN seq % 23 = 0 THEN '' WHEN seq % 29 = 0 THEN CAST(ddp_numruc AS VARCHAR) || '.0'
         ELSE {_pad("CAST(ddp_numruc AS VARCHAR)")} END AS ddp_numruc,
    ddp_ciiu,
    CASE WHEN seq % 41 = 0 THEN 'ABCDEFG' ELSE ddp_tpoemp END AS ddp_tpoemp,
    ddp_tamano, ddp_ubigeo, ddp_estado, ddp_flag22, dds_sexo,
    CASE WHEN seq % 31 = 0 THEN 'x' ELSE {_pad("coalesce(CAST(dds_edad AS VARCHAR), '')")} END AS dds_edad,
    CASE WHEN seq % 37 = 0 THEN '' WHEN seq % 43 = 0 THEN 'n/a' ELSE {_pad("CAST(deuda AS VARCHAR)")} END AS deuda,
    CASE WHEN seq % 7 = 3 THEN '' ELSE CAST(condicion AS VARCHAR) END AS condicion
  FROM dirty
)"""


def _int_parse(c: str, typ: str) -> tuple[str, str]:
    t = f"trim({c})"
    ok = f"regexp_full_match({t}, '[+-]?[0-9]+')"
    blank = f"({c} IS NULL OR {t} = '')"
    return (f"CASE WHEN {blank} THEN NULL WHEN {ok} THEN TRY_CAST({t} AS {typ}) END",
            f"(NOT {blank} AND TRY_CAST(CASE WHEN {ok} THEN {t} END AS {typ}) IS NULL)")


_RUC, _RUC_BAD = _int_parse("ddp_numruc", "BIGINT")
_EDAD, _EDAD_BAD = _int_parse("dds_edad", "INTEGER")
_COND_V, _COND_BAD = _int_parse("condicion", "INTEGER")
_DEBT_BLANK = "(deuda IS NULL OR trim(deuda) = '')"
_DEBT = f"CASE WHEN {_DEBT_BLANK} THEN CAST(0 AS DECIMAL(18,2)) ELSE TRY_CAST(trim(deuda) AS DECIMAL(18,2)) END"
_DEBT_BAD = f"(NOT {_DEBT_BLANK} AND TRY_CAST(trim(deuda) AS DECIMAL(18,2)) IS NULL)"
_COND = f"CASE WHEN (condicion IS NULL OR trim(condicion) = '') THEN 0 ELSE {_COND_V} END"
_TEXTS = {"ddp_ciiu": 10, "ddp_tpoemp": 5, "ddp_tamano": 5, "ddp_ubigeo": 100,
          "ddp_estado": 50, "ddp_flag22": 50, "dds_sexo": 20}
_TOO_LONG = " OR ".join(f"coalesce(length(nullif(trim({c}), '')) > {n}, false)" for c, n in _TEXTS.items())

PARSED = f"""
parsed AS (
  SELECT seq,
    {_RUC} AS ddp_numruc,
    {", ".join(f"nullif(trim({c}), '') AS {c}" for c in _TEXTS)},
    {_EDAD} AS dds_edad,
    {_DEBT} AS deuda,
    CAST({_COND} AS INTEGER) AS condicion,
    CASE WHEN {_RUC_BAD} OR {_EDAD_BAD} OR {_DEBT_BAD} OR {_COND_BAD} THEN 'parse_error'
         WHEN ({_RUC}) IS NULL THEN 'blank_key'
         WHEN {_TOO_LONG} THEN 'too_long' END AS reason
  FROM raw
),
parsed_ok AS (SELECT * EXCLUDE (reason) FROM parsed WHERE reason IS NULL)"""

# --- registry chain over a staging source ---------------------------------------------


def _norm(c: str, allowed: tuple[str, ...], default: str, aliases: dict[str, str] | None = None,
          first: tuple[str, ...] = ()) -> str:
    v = f"upper(trim({c}))"
    parts = [f"WHEN {c} IS NULL OR {c} = '' THEN '{default}'"]
    parts += [f"WHEN {v} = '{a}' THEN '{b}'" for a, b in (aliases or {}).items()]
    parts.append(f"WHEN {v} IN ({', '.join(repr(x) for x in allowed)}) THEN {v}")
    if first:
        parts.append(f"WHEN substr({v}, 1, 1) IN ({', '.join(repr(x) for x in first)}) THEN substr({v}, 1, 1)")
    return "CASE " + " ".join(parts) + f" ELSE '{default}' END"


NORM_COLUMNS = f"""
    ddp_numruc AS ruc,
    ddp_ciiu AS id_ciiu,
    {_norm("ddp_tpoemp", ("A", "B", "C", "D", "E", "CE", "-"), "-", first=("A", "B", "C", "D", "E"))} AS id_tipo_empresa,
    {_norm("ddp_tamano", ("C", "M", "G", "B"), "C")} AS id_tamano,
    ddp_ubigeo AS id_ubicacion,
    {_norm("ddp_estado", ("ACTIVO", "10", "11", "3", "2", "1", "12", "INACTIVO"), "ND", {"2ACTIVO": "ACTIVO"})} AS id_estado,
    {_norm("ddp_flag22", ("HABIDO", "1", "2", "3", "4", "5", "6", "7", "8", "9", "10", "11", "12"), "ND", {"2HABIDO": "HABIDO"})} AS id_condicion,
    {_norm("dds_sexo", ("HOMBRE", "MUJER"), "ND")} AS sexo,
    dds_edad AS edad,
    CAST(greatest(coalesce(deuda, 0), 0) AS DECIMAL(18,2)) AS deuda,
    ddp_flag22 AS flag22"""

SEED_VALUES = {
    "sizes": "(VALUES ('C', 'Pequeña Empresa / Microempresa'), ('M', 'Mediana Empresa'), ('G', 'Grande Empresa'),"
             " ('B', 'Empresa Básica / Sin clasificar')) AS t(id_tamano, descripcion)",
    "types": "(VALUES ('A', 'Persona Natural con Negocio'), ('B', 'Persona Jurídica - Sociedad'),"
             " ('CE', 'Cooperativa Especial'), ('C', 'Cooperativa'),"
             " ('D', 'Empresa Individual de Responsabilidad Ltda'), ('E', 'Empresa del Estado'),"
             " ('-', 'Sin tipo definido')) AS t(id_tipo_empresa, descripcion)",
    "states": "(VALUES ('ACTIVO', 'Contribuyente Activo'), ('10', 'Baja Temporal'), ('11', 'Baja Definitiva'),"
              " ('3', 'Suspendido Temporalmente'), ('2', 'Baja de Oficio'), ('1', 'Inhabilitado'),"
              " ('12', 'Baja Provisional'), ('INACTIVO', 'Contribuyente Inactivo'),"
              " ('ND', 'Estado No Determinado')) AS t(id_estado, descripcion)",
    "conditions": "(VALUES ('HABIDO', 'Domicilio Fiscal Habido (Verificado)'),"
                  " ('12', 'No Habido - Dirección Inexistente'), ('1', 'Pendiente de Verificación'),"
                  " ('5', 'No Hallado'), ('2', 'No Existe la Dirección'), ('3', 'Cerrado'), ('4', 'Ausente'),"
                  " ('6', 'No Habido - Dirección Desconocida'), ('7', 'No Habido - Rehúsa Recibir'),"
                  " ('8', 'No Habido - Temporalmente Ausente'), ('9', 'No Habido - Otros Motivos'),"
                  " ('10', 'No Habido - Mudado sin Informar'), ('11', 'No Habido - Local Cerrado'),"
                  " ('ND', 'Condición No Determinada')) AS t(id_condicion, descripcion)",
}

RULES = [
    ("not_null_ruc", "ruc IS NOT NULL"),
    ("not_null_id_ciiu", "id_ciiu IS NOT NULL"),
    ("not_null_id_tipo_empresa", "id_tipo_empresa IS NOT NULL"),
    ("not_null_id_tamano", "id_tamano IS NOT NULL"),
    ("not_null_id_ubicacion", "id_ubicacion IS NOT NULL"),
    ("not_null_id_estado", "id_estado IS NOT NULL"),
    ("not_null_id_condicion", "id_condicion IS NOT NULL"),
    ("not_null_sexo", "sexo IS NOT NULL"),
    ("not_null_deuda", "deuda IS NOT NULL"),
    ("sexo_valid", "sexo IN ('HOMBRE', 'MUJER', 'ND')"),
    ("edad_range", "edad BETWEEN 0 AND 120"),
    ("deuda_non_negative", "deuda >= 0"),
    ("ruc_positive", "ruc > 0"),
    ("length_id_ciiu", "length(id_ciiu) <= 10"),
    ("length_id_tipo_empresa", "length(id_tipo_empresa) <= 5"),
    ("length_id_tamano", "length(id_tamano) <= 5"),
    ("length_id_ubicacion", "length(id_ubicacion) <= 100"),
    ("length_id_estado", "length(id_estado) <= 50"),
    ("length_id_condicion", "length(id_condicion) <= 50"),
    ("length_sexo", "length(sexo) <= 20"),
    ("length_flag22", "length(flag22) <= 50"),
    ("fk_activity", "(id_ciiu IS NULL OR upper(trim(id_ciiu)) IN (SELECT k FROM activity_keys))"),
    ("fk_company_type", "(id_tipo_empresa IS NULL OR upper(trim(id_tipo_empresa)) IN (SELECT k FROM type_keys))"),
    ("fk_size", "(id_tamano IS NULL OR upper(trim(id_tamano)) IN (SELECT upper(trim(id_tamano)) FROM sizes))"),
    ("fk_place", "(id_ubicacion IS NULL OR upper(trim(id_ubicacion)) IN (SELECT k FROM place_values))"),
    ("fk_state", "(id_estado IS NULL OR upper(trim(id_estado)) IN (SELECT upper(trim(id_estado)) FROM states))"),
    ("fk_condition", "(id_condicion IS NULL OR upper(trim(id_condicion)) IN "
                     "(SELECT upper(trim(id_condicion)) FROM conditions))"),
]
_BROKEN = "list_filter([" + ", ".join(f"CASE WHEN NOT ({p}) THEN '{n}' END" for n, p in RULES) + "], lambda x: x IS NOT NULL)"

SPECIAL = ("SELECT CAST(611077 AS BIGINT) AS ruc, '75113' AS id_ciiu, 'A' AS id_tipo_empresa, 'C' AS id_tamano,"
           " 'CHIMBOTE' AS id_ubicacion, 'ACTIVO' AS id_estado, 'HABIDO' AS id_condicion, 'ND' AS sexo,"
           " CAST(0 AS INTEGER) AS edad, CAST(0 AS DECIMAL(18,2)) AS deuda, 'HABIDO' AS flag22")


def registry_ctes(src: str) -> str:
    """CTEs ``cand, norm, dedup, place_values, activity_values, ..., flagged, valid, special_in, fact, rejected``."""
    return f"""
cand AS (
  SELECT * FROM {src}
  WHERE ddp_numruc >= 10000 AND ddp_ciiu IS NOT NULL AND ddp_tpoemp IS NOT NULL AND ddp_tamano IS NOT NULL
    AND ddp_ubigeo IS NOT NULL AND ddp_estado IS NOT NULL AND ddp_flag22 IS NOT NULL
),
norm AS (SELECT {NORM_COLUMNS}, seq FROM cand),
dedup AS (
  SELECT * EXCLUDE (rn, seq) FROM (
    SELECT *, row_number() OVER (PARTITION BY ruc ORDER BY seq) AS rn FROM norm) WHERE rn = 1
),
place_values AS (
  SELECT upper(trim(ddp_ubigeo)) AS k, min(ddp_ubigeo) AS v FROM {src} WHERE ddp_ubigeo IS NOT NULL GROUP BY 1
),
activity_values AS (
  SELECT upper(trim(ddp_ciiu)) AS k, min(ddp_ciiu) AS v FROM {src} WHERE ddp_ciiu IS NOT NULL GROUP BY 1
),
activities AS (
  SELECT '75113' AS id_ciiu, 'Actividad económica código 75113' AS descripcion, '75' AS division
  UNION ALL
  SELECT v, 'Actividad económica código ' || v, left(v, 2) FROM activity_values WHERE k <> '75113'
),
activity_keys AS (SELECT DISTINCT upper(trim(id_ciiu)) AS k FROM activities),
places AS (
  SELECT v AS id_ubicacion, v AS nombre_distrito, 'Santa' AS provincia, 'Áncash' AS departamento FROM place_values
),
sizes AS (SELECT * FROM {SEED_VALUES["sizes"]}),
types AS (SELECT * FROM {SEED_VALUES["types"]}),
states AS (SELECT * FROM {SEED_VALUES["states"]}),
conditions AS (SELECT * FROM {SEED_VALUES["conditions"]}),
type_keys AS (SELECT DISTINCT upper(trim(id_tipo_empresa)) AS k FROM types),
flagged AS (SELECT *, {_BROKEN} AS broken_rules FROM dedup),
valid AS (SELECT * EXCLUDE (broken_rules) FROM flagged WHERE len(broken_rules) = 0),
special_in AS (SELECT * FROM ({SPECIAL}) s WHERE NOT EXISTS (SELECT 1 FROM valid WHERE valid.ruc = s.ruc)),
special_flagged AS (SELECT *, {_BROKEN} AS broken_rules FROM special_in),
fact AS (
  SELECT * FROM valid
  UNION ALL
  SELECT * EXCLUDE (broken_rules) FROM special_flagged WHERE len(broken_rules) = 0
),
rejected AS (
  SELECT * FROM flagged WHERE len(broken_rules) > 0
  UNION ALL
  SELECT * FROM special_flagged WHERE len(broken_rules) > 0
)"""


FACT_WITH = "WITH " + DIRTY.strip() + "," + registry_ctes("dirty")
PARSED_WITH = "WITH " + DIRTY.strip() + "," + RAW_TEXT.strip() + "," + PARSED.strip() + "," + registry_ctes("parsed_ok")


def _on_fact(select: str) -> str:
    return FACT_WITH + "\n" + select


def _pct(n: str, total: str) -> str:
    return f"coalesce(CAST({n} AS DOUBLE) / CAST({total} AS DOUBLE) * 100.0, 0.0)"


_MEAN = "CAST(sum(deuda) AS DOUBLE) / CAST(count(deuda) AS DOUBLE)"
_SUM = "CAST(sum(deuda) AS DOUBLE)"
_FACT_OUT = ("ruc, id_ciiu, id_tipo_empresa, id_tamano, id_ubicacion, id_estado, id_condicion, sexo, edad, "
             "CAST(deuda AS DOUBLE) AS deuda, flag22")


def _long(analysis: str, cat: str, metric: str, value: str, text: str, src: str) -> str:
    return (f"SELECT '{analysis}' AS nombre_analisis, CAST({cat} AS VARCHAR) AS categoria, '{metric}' AS metrica, "
            f"CAST(CAST({value} AS DECIMAL(18,4)) AS DOUBLE) AS valor_numerico, {text} AS valor_texto FROM {src}")


_A1 = f"(SELECT coalesce(id_estado, 'ND') AS cat, count(*) AS n, {_SUM} AS debt_total FROM {{src}} GROUP BY id_estado)"
_C1 = ("(SELECT coalesce(CASE id_tamano WHEN 'C' THEN 'Micro/Peq' WHEN 'M' THEN 'Mediana' WHEN 'G' THEN 'Grande' "
       "WHEN 'B' THEN 'Básica' END, id_tamano) AS label, n, "
       "coalesce(CAST(n AS DOUBLE) / CAST(sum(n) OVER () AS DOUBLE) * 100.0, 0.0) AS share_pct "
       "FROM (SELECT id_tamano, count(*) AS n FROM {src} GROUP BY id_tamano))")
_MONEY = "'S/ ' || format('{:,.2f}', coalesce(debt_total, 0.0))"


_CNT = "format('{{:,}}', {0})"
_CNT_PCT = "format('{{:,}} ({{:.1f}}%)', {0}, {1})"
_MONEY_OF = "'S/ ' || format('{{:,.2f}}', coalesce({0}, 0.0))"
_NAMES = {"A1": "Salud Fiscal - Por Estado", "A2": "Salud Fiscal - Estadísticas Deuda",
          "B1": "Geografía - Por Ubicación", "C1": "Estructura - Por Tamaño", "C2": "Estructura - Por Tipo Empresa",
          "D": "Sectores Económicos", "E": "Demografía", "F": "Calidad de Datos"}


def _lr(name: str, cat: str, metric: str, value: str, text: str, src: str) -> str:
    return (f"SELECT '{_NAMES[name]}' AS nombre_analisis, CAST({cat} AS VARCHAR) AS categoria, "
            f"{metric} AS metrica, CAST(CAST({value} AS DECIMAL(18,4)) AS DOUBLE) AS valor_numerico, "
            f"{text} AS valor_texto FROM {src}")


_BAND = ("CASE WHEN edad IS NOT NULL AND edad > 0 THEN CASE WHEN edad < 30 THEN '< 30 años' "
         "WHEN edad < 40 THEN '30-39 años' WHEN edad < 50 THEN '40-49 años' WHEN edad < 60 THEN '50-59 años' "
         "WHEN edad < 70 THEN '60-69 años' ELSE '70+ años' END END")
_RUN_ALL_CTES = f"""
, a1 AS (SELECT coalesce(id_estado, 'ND') AS cat, count(*) AS n, CAST(sum(deuda) AS DOUBLE) AS debt_total
         FROM fact GROUP BY id_estado),
a2 AS (SELECT count(*) FILTER (WHERE deuda > 0) AS debtors,
         coalesce(CAST(sum(deuda) FILTER (WHERE deuda > 0) AS DOUBLE), 0.0) AS debt_total,
         coalesce(CAST(sum(deuda) FILTER (WHERE deuda > 0) AS DOUBLE)
                  / CAST(count(deuda) FILTER (WHERE deuda > 0) AS DOUBLE), 0.0) AS debt_avg,
         coalesce(CAST(quantile_disc(deuda, 0.5) FILTER (WHERE deuda > 0) AS DOUBLE), 0.0) AS debt_median,
         coalesce(CAST(max(deuda) FILTER (WHERE deuda > 0) AS DOUBLE), 0.0) AS debt_max FROM fact),
b1 AS (SELECT substr(id_ubicacion, 1, 24) AS label, count(*) AS n, CAST(sum(deuda) AS DOUBLE) AS debt_total
       FROM fact GROUP BY id_ubicacion ORDER BY n DESC, id_ubicacion LIMIT 15),
c1g AS (SELECT id_tamano, count(*) AS n FROM fact GROUP BY id_tamano),
c1 AS (SELECT coalesce(CASE id_tamano WHEN 'C' THEN 'Micro/Peq' WHEN 'M' THEN 'Mediana' WHEN 'G' THEN 'Grande'
              WHEN 'B' THEN 'Básica' END, id_tamano) AS label, n,
              {_pct("n", "(SELECT sum(n) FROM c1g)")} AS p FROM c1g),
c2g AS (SELECT id_tipo_empresa, count(*) AS n FROM fact GROUP BY id_tipo_empresa),
c2 AS (SELECT coalesce(CASE id_tipo_empresa WHEN 'A' THEN 'Persona Natural' WHEN 'B' THEN 'Persona Jurídica'
              WHEN 'CE' THEN 'Cooperativa' WHEN 'C' THEN 'Cooperativa' WHEN 'D' THEN 'EIRL'
              WHEN 'E' THEN 'Empresa Estado' WHEN '-' THEN 'Sin definir' END, id_tipo_empresa) AS label, n,
              {_pct("n", "(SELECT sum(n) FROM c2g)")} AS p FROM c2g),
d1 AS (SELECT id_ciiu, count(*) AS n FROM fact GROUP BY id_ciiu ORDER BY n DESC, id_ciiu LIMIT 20),
d2 AS (SELECT 'SECTOR_52xx' AS sector, 'total' AS metric, count_if(id_ciiu LIKE '52%') AS v FROM fact
       UNION ALL SELECT 'SECTOR_52xx', 'activos', count_if(id_ciiu LIKE '52%' AND id_estado = 'ACTIVO') FROM fact
       UNION ALL SELECT 'SECTOR_15xx', 'total', count_if(id_ciiu LIKE '15%') FROM fact
       UNION ALL SELECT 'SECTOR_70_55xx', 'total', count_if(id_ciiu LIKE '70%' OR id_ciiu LIKE '55%') FROM fact),
e1g AS (SELECT sexo, count(*) AS n, avg(edad) AS age FROM fact GROUP BY sexo),
e1 AS (SELECT sexo, n, coalesce(age, 0.0) AS age, {_pct("n", "(SELECT sum(n) FROM e1g)")} AS p FROM e1g),
e2 AS (SELECT {_BAND} AS band, count(*) AS n FROM fact GROUP BY 1),
f1 AS ({" UNION ALL ".join(f"SELECT '{c}' AS col, count(*) FILTER (WHERE {c} IS NULL) AS nulls, count(*) AS t FROM fact"
                           for c in ["edad", "deuda", "id_ciiu", "id_tipo_empresa", "id_estado", "id_condicion"])}),
f2 AS (SELECT count_if(id_estado = 'ND') AS nd_estado, count_if(id_condicion = 'ND') AS nd_condicion,
       count_if(id_tipo_empresa = '-') AS sin_tipo,
       count(*) - count_if(id_estado = 'ND') - count_if(id_condicion = 'ND') AS clean FROM fact)"""
_RUN_ALL_SELECT = f"""
{_lr("A1", "cat", "'cantidad'", "n", "CAST(n AS VARCHAR)", "a1")}
UNION ALL {_lr("A1", "cat", "'deuda_total'", "debt_total", _MONEY_OF.format("debt_total"), "a1")}
UNION ALL {_lr("A2", "'DEUDA'", "'con_deuda'", "debtors", _CNT.format("debtors"), "a2")}
UNION ALL {_lr("A2", "'DEUDA'", "'deuda_total'", "debt_total", _MONEY_OF.format("debt_total"), "a2")}
UNION ALL {_lr("A2", "'DEUDA'", "'deuda_promedio'", "debt_avg", _MONEY_OF.format("debt_avg"), "a2")}
UNION ALL {_lr("A2", "'DEUDA'", "'deuda_mediana'", "debt_median", _MONEY_OF.format("debt_median"), "a2")}
UNION ALL {_lr("A2", "'DEUDA'", "'deuda_maxima'", "debt_max", _MONEY_OF.format("debt_max"), "a2")}
UNION ALL {_lr("B1", "label", "'empresas'", "n", "CAST(n AS VARCHAR)", "b1")}
UNION ALL {_lr("B1", "label", "'deuda_total'", "debt_total", _MONEY_OF.format("debt_total"), "b1")}
UNION ALL {_lr("C1", "label", "'cantidad'", "n", _CNT_PCT.format("n", "p"), "c1")}
UNION ALL {_lr("C2", "label", "'cantidad'", "n", _CNT_PCT.format("n", "p"), "c2")}
UNION ALL {_lr("D", "id_ciiu", "'empresas'", "n", "CAST(n AS VARCHAR)", "d1")}
UNION ALL {_lr("D", "sector", "metric", "v", _CNT.format("v"), "d2")}
UNION ALL {_lr("E", "sexo", "'cantidad'", "n", _CNT_PCT.format("n", "p"), "e1")}
UNION ALL {_lr("E", "sexo", "'edad_promedio'", "age", "format('{:.1f} años', age)", "e1")}
UNION ALL {_lr("E", "band", "'cantidad'", "n", "CAST(n AS VARCHAR)", "(SELECT * FROM e2 WHERE band IS NOT NULL)")}
UNION ALL {_lr("F", "col", "'nulos'", "nulls", _CNT_PCT.format("nulls", _pct("nulls", "t")), "f1")}
UNION ALL {_lr("F", "'CALIDAD'", "'nd_estado'", "nd_estado", _CNT.format("nd_estado"), "f2")}
UNION ALL {_lr("F", "'CALIDAD'", "'nd_condicion'", "nd_condicion", _CNT.format("nd_condicion"), "f2")}
UNION ALL {_lr("F", "'CALIDAD'", "'sin_tipo'", "sin_tipo", _CNT.format("sin_tipo"), "f2")}
UNION ALL {_lr("F", "'CALIDAD'", "'total_limpios'", "clean", _CNT.format("clean"), "f2")}"""
_RUN_ALL = _RUN_ALL_CTES + "\n" + _RUN_ALL_SELECT


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["a1_state_profile"] = _on_fact(
        f"SELECT id_estado, count(*) AS n, {_SUM} AS debt_total, {_MEAN} AS debt_avg, "
        "row_number() OVER (ORDER BY count(*) DESC, id_estado ASC NULLS LAST) AS row_no FROM fact GROUP BY id_estado")
    q["a1b_orders_by_status"] = f"""
SELECT o_orderstatus, count(*) AS n, CAST(sum(price) AS DOUBLE) AS debt_total,
  CAST(sum(price) AS DOUBLE) / CAST(count(price) AS DOUBLE) AS debt_avg
FROM (SELECT o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders) GROUP BY o_orderstatus"""
    pos = "FILTER (WHERE deuda > 0)"
    stats = f"""
SELECT count(*) {pos} AS debtors,
  coalesce(CAST(sum(deuda) {pos} AS DOUBLE), 0.0) AS debt_total,
  coalesce(CAST(sum(deuda) {pos} AS DOUBLE) / CAST(count(deuda) {pos} AS DOUBLE), 0.0) AS debt_avg,
  coalesce(CAST(max(deuda) {pos} AS DOUBLE), 0.0) AS debt_max,
  coalesce(CAST(min(deuda) {pos} AS DOUBLE), 0.0) AS debt_min,
  coalesce(CAST(quantile_disc(deuda, 0.5) {pos} AS DOUBLE), 0.0) AS debt_median,
  coalesce(CAST(quantile_disc(deuda, 0.9) {pos} AS DOUBLE), 0.0) AS debt_p90,
  {_pct(f"count(*) {pos}", "count(*)")} AS debtors_pct
FROM {{src}}"""
    q["a2b_customer_balance_stats"] = stats.format(
        src="(SELECT CAST(c_acctbal AS DECIMAL(18,2)) AS deuda FROM customer)")
    q["a2_debt_stats"] = _on_fact(f"""
SELECT count(*) {pos} AS debtors,
  coalesce(CAST(sum(deuda) {pos} AS DOUBLE), 0.0) AS debt_total,
  coalesce(CAST(sum(deuda) {pos} AS DOUBLE) / CAST(count(deuda) {pos} AS DOUBLE), 0.0) AS debt_avg,
  coalesce(CAST(max(deuda) {pos} AS DOUBLE), 0.0) AS debt_max,
  coalesce(CAST(min(deuda) {pos} AS DOUBLE), 0.0) AS debt_min,
  coalesce(CAST(quantile_disc(deuda, 0.5) {pos} AS DOUBLE), 0.0) AS debt_median,
  coalesce(CAST(quantile_disc(deuda, 0.9) {pos} AS DOUBLE), 0.0) AS debt_p90,
  {_pct(f"count(*) {pos}", "count(*)")} AS debtors_pct
FROM fact""")
    b1 = """
SELECT id_ubicacion, substr(id_ubicacion, 1, 24) AS place_label, n, active, debt_total, activities FROM (
  SELECT {key} AS id_ubicacion, count(*) AS n,
    CAST(count_if(id_estado = 'ACTIVO') AS BIGINT) AS active, CAST(sum(deuda) AS DOUBLE) AS debt_total,
    count(DISTINCT id_ciiu) AS activities
  FROM fact GROUP BY 1 ORDER BY n DESC, id_ubicacion ASC LIMIT 15)"""
    q["b1_top_places"] = _on_fact(b1.format(key="id_ubicacion"))
    q["b3_long_places"] = _on_fact(b1.format(key="id_ubicacion || ', DISTRITO DE LA PROVINCIA'"))
    q["b2_top_places_ci"] = _on_fact(b1.format(key="upper(trim(id_ubicacion))"))
    q["c1_size_profile"] = _on_fact(f"""
, g AS (SELECT id_tamano, count(*) AS n, {_SUM} AS debt_total, avg(edad) AS age_avg FROM fact GROUP BY id_tamano)
SELECT id_tamano, n, debt_total, age_avg, {_pct("n", "(SELECT sum(n) FROM g)")} AS share_pct,
  coalesce(CASE id_tamano WHEN 'C' THEN 'Micro/Peq' WHEN 'M' THEN 'Mediana' WHEN 'G' THEN 'Grande'
           WHEN 'B' THEN 'Básica' END, id_tamano) AS label
FROM g""")
    q["c2_type_profile"] = _on_fact(f"""
, g AS (SELECT id_tipo_empresa, count(*) AS n FROM fact GROUP BY id_tipo_empresa)
SELECT id_tipo_empresa, n, {_pct("n", "(SELECT sum(n) FROM g)")} AS share_pct,
  coalesce(CASE id_tipo_empresa WHEN 'A' THEN 'Persona Natural' WHEN 'B' THEN 'Persona Jurídica'
    WHEN 'CE' THEN 'Cooperativa' WHEN 'C' THEN 'Cooperativa' WHEN 'D' THEN 'EIRL' WHEN 'E' THEN 'Empresa Estado'
    WHEN '-' THEN 'Sin definir' END, id_tipo_empresa) AS label
FROM g""")
    q["d1_top_activities"] = _on_fact(f"""
SELECT id_ciiu, count(*) AS n, CAST(count_if(id_estado = 'ACTIVO') AS BIGINT) AS active, {_SUM} AS debt_total
FROM fact GROUP BY id_ciiu ORDER BY n DESC, id_ciiu ASC LIMIT 20""")
    q["d2_sector_rollup"] = _on_fact("""
SELECT 'SECTOR_52xx' AS sector, 'total' AS metric, CAST(count_if(id_ciiu LIKE '52%') AS BIGINT) AS value, 0 AS ord FROM fact
UNION ALL SELECT 'SECTOR_15xx', 'total', CAST(count_if(id_ciiu LIKE '15%') AS BIGINT), 10 FROM fact
UNION ALL SELECT 'SECTOR_70_55xx', 'total', CAST(count_if(id_ciiu LIKE '70%' OR id_ciiu LIKE '55%') AS BIGINT), 20 FROM fact
UNION ALL SELECT 'SECTOR_52xx', 'activos', CAST(count_if(id_ciiu LIKE '52%' AND id_estado = 'ACTIVO') AS BIGINT), 1 FROM fact""")
    q["e1_sex_profile"] = _on_fact(f"""
, g AS (SELECT sexo, count(*) AS n, {_MEAN} AS debt_avg, avg(edad) AS age_avg FROM fact GROUP BY sexo)
SELECT sexo, n, debt_avg, age_avg, {_pct("n", "(SELECT sum(n) FROM g)")} AS share_pct FROM g""")
    band = ("CASE WHEN edad IS NOT NULL AND edad > 0 THEN CASE WHEN edad < 30 THEN {0} WHEN edad < 40 THEN {1} "
            "WHEN edad < 50 THEN {2} WHEN edad < 60 THEN {3} WHEN edad < 70 THEN {4} ELSE {5} END END")
    labels = ["'< 30 años'", "'30-39 años'", "'40-49 años'", "'50-59 años'", "'60-69 años'", "'70+ años'"]
    q["e2_age_bands"] = _on_fact(f"""
, g AS (SELECT {band.format(*labels)} AS age_band, {band.format(*range(1, 7))} AS band_no, count(*) AS n
        FROM fact GROUP BY 1, 2)
SELECT age_band, CAST(band_no AS INTEGER) AS band_no, n, {_pct("n", "(SELECT sum(n) FROM g)")} AS share_pct,
  row_number() OVER (ORDER BY age_band) AS row_no
FROM g WHERE age_band IS NOT NULL""")
    cols = ["edad", "deuda", "id_ciiu", "id_tipo_empresa", "id_estado", "id_condicion"]
    parts = [f"SELECT '{c}' AS column_name, {i} AS ord, count(*) FILTER (WHERE {c} IS NULL) AS nulls, count(*) AS _total FROM fact"
             for i, c in enumerate(cols)]
    q["f1_null_profile"] = _on_fact(f"""
, p AS ({" UNION ALL ".join(parts)})
SELECT column_name, ord, nulls, {_pct("nulls", "_total")} AS null_pct,
  CASE WHEN {_pct("nulls", "_total")} < 1.0 THEN 'ok' WHEN {_pct("nulls", "_total")} < 10.0 THEN 'warn' ELSE 'bad' END AS grade
FROM p""")
    q["f2_default_codes"] = _on_fact("""
SELECT count(*) AS total,
  CAST(count_if(id_estado = 'ND') AS BIGINT) AS nd_estado,
  CAST(count_if(id_condicion = 'ND') AS BIGINT) AS nd_condicion,
  CAST(count_if(id_tipo_empresa = '-') AS BIGINT) AS sin_tipo,
  CAST(count_if(id_estado <> 'ND' AND id_condicion <> 'ND') AS BIGINT) AS clean_total_exact,
  count(*) - CAST(count_if(id_estado = 'ND') AS BIGINT) - CAST(count_if(id_condicion = 'ND') AS BIGINT) AS clean_total
FROM fact""")
    q["n1_normalize_codes"] = "WITH " + DIRTY.strip() + f"""
SELECT {NORM_COLUMNS.replace("CAST(greatest(coalesce(deuda, 0), 0) AS DECIMAL(18,2)) AS deuda",
                              "CAST(CAST(greatest(coalesce(deuda, 0), 0) AS DECIMAL(18,2)) AS DOUBLE) AS deuda")},
  seq FROM dirty"""
    q["m1_migrate"] = _on_fact(f"SELECT {_FACT_OUT} FROM fact")
    q["m2_rejected_by_rule"] = _on_fact(
        "SELECT rule, count(*) AS n FROM (SELECT unnest(broken_rules) AS rule FROM rejected) GROUP BY rule")
    q["m3_duplicates"] = ("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem "
                          "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
    q["g1_grow_places"] = _on_fact("SELECT * FROM places")
    q["g3_grow_activities"] = _on_fact("SELECT id_ciiu, descripcion, division FROM activities WHERE id_ciiu <> '75113'")
    q["g2_insert_if_absent"] = _on_fact(
        f"SELECT {_FACT_OUT} FROM ({SPECIAL}) s WHERE NOT EXISTS (SELECT 1 FROM fact WHERE fact.ruc = s.ruc)")
    q["g2b_special_row_accepted"] = _on_fact(
        f"SELECT {_FACT_OUT} FROM ({SPECIAL}) s WHERE NOT EXISTS (SELECT 1 FROM fact WHERE fact.ruc = s.ruc)")
    raw = f"""
, raw_rows AS (
  SELECT CASE WHEN k % 101 = 0 THEN NULL WHEN k % 103 = 0 THEN -k ELSE ddp_numruc END AS ruc,
    CASE WHEN k % 107 = 0 THEN repeat('9', 12) WHEN k % 109 = 0 THEN 'X' || ddp_ciiu ELSE ddp_ciiu END AS id_ciiu,
    CASE WHEN k % 113 = 0 THEN NULL WHEN k % 127 = 0 THEN 'ABCDEFG' ELSE ddp_tpoemp END AS id_tipo_empresa,
    CASE WHEN k % 131 = 0 THEN 'TOOLONG' ELSE ddp_tamano END AS id_tamano,
    CASE WHEN k % 137 = 0 THEN NULL WHEN k % 139 = 0 THEN repeat('Z', 101) WHEN k % 149 = 0 THEN 'NOWHERE' ELSE ddp_ubigeo END AS id_ubicacion,
    CASE WHEN k % 151 = 0 THEN NULL WHEN k % 157 = 0 THEN repeat('E', 51) ELSE ddp_estado END AS id_estado,
    CASE WHEN k % 163 = 0 THEN NULL WHEN k % 167 = 0 THEN repeat('C', 51) ELSE ddp_flag22 END AS id_condicion,
    CASE WHEN k % 173 = 0 THEN repeat('S', 21) ELSE dds_sexo END AS sexo,
    dds_edad AS edad,
    CASE WHEN k % 179 = 0 THEN NULL WHEN k % 181 = 0 THEN -1 ELSE deuda END AS deuda,
    CASE WHEN k % 191 = 0 THEN repeat('F', 51) ELSE ddp_flag22 END AS flag22
  FROM (SELECT *, seq AS k FROM dirty)
)"""
    q["m4_rules_before_cleaning"] = _on_fact(
        raw + f"\nSELECT rule, count(*) AS n FROM (SELECT unnest({_BROKEN}) AS rule FROM raw_rows) GROUP BY rule")
    fk = [(n, p) for n, p in RULES if n.startswith("fk_")]
    q["q1_orphans"] = _on_fact(
        ", rows_ AS (SELECT * FROM dedup UNION ALL SELECT * FROM special_in)\n"
        + " UNION ALL ".join(f"SELECT '{n}' AS fk, CAST(count_if(NOT {p}) AS BIGINT) AS orphans FROM rows_" for n, p in fk))
    uniq = [("CONTRIBUYENTE", "fact", "ruc"), ("ACTIVIDAD_ECONOMICA", "activities", "upper(trim(id_ciiu))"),
            ("TIPO_EMPRESA", "types", "upper(trim(id_tipo_empresa))"),
            ("TAMANO_EMPRESA", "sizes", "upper(trim(id_tamano))"),
            ("UBICACION_GEOGRAFICA", "places", "upper(trim(id_ubicacion))"),
            ("ESTADO_TRIBUTARIO", "states", "upper(trim(id_estado))"),
            ("CONDICION_DOMICILIO", "conditions", "upper(trim(id_condicion))")]
    q["q2_unique_keys"] = _on_fact("\n" + " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, (SELECT count(*) FROM (SELECT {k} FROM {t} GROUP BY 1 HAVING count(*) > 1))"
        f" AS duplicate_keys" for n, t, k in uniq))
    q["s1_star"] = _on_fact("""
SELECT c.ruc, c.sexo, c.edad, CAST(c.deuda AS DOUBLE) AS deuda,
  ae.id_ciiu AS codigo_ciiu, ae.descripcion AS actividad_economica, te.descripcion AS tipo_empresa,
  tm.descripcion AS tamano_empresa, ub.nombre_distrito AS distrito, ub.provincia, ub.departamento,
  et.descripcion AS estado_tributario, cd.descripcion AS condicion_domicilio
FROM fact c
JOIN activities ae ON upper(trim(c.id_ciiu)) = upper(trim(ae.id_ciiu))
JOIN types te ON upper(trim(c.id_tipo_empresa)) = upper(trim(te.id_tipo_empresa))
JOIN sizes tm ON upper(trim(c.id_tamano)) = upper(trim(tm.id_tamano))
JOIN places ub ON upper(trim(c.id_ubicacion)) = upper(trim(ub.id_ubicacion))
JOIN states et ON upper(trim(c.id_estado)) = upper(trim(et.id_estado))
JOIN conditions cd ON upper(trim(c.id_condicion)) = upper(trim(cd.id_condicion))""")
    q["s2_star_driver"] = """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, o_orderstatus, c_custkey, c_mktsegment,
  n_name, r_name, p_brand, s_name
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
JOIN part ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey"""
    summary = f"""
SELECT count(*) AS total, CAST(count_if(id_estado = 'ACTIVO') AS BIGINT) AS active,
  CAST(count_if(deuda > 0) AS BIGINT) AS with_debt, coalesce({_SUM}, 0.0) AS debt_total,
  coalesce({_MEAN}, 0.0) AS debt_avg, coalesce(CAST(max(deuda) AS DOUBLE), 0.0) AS debt_max
FROM fact"""
    q["r1_summary"] = _on_fact(summary)
    q["r1b_summary_debtors"] = _on_fact(summary + " WHERE deuda > 0")
    q["r2_by_state"] = _on_fact(f"""
SELECT et.descripcion AS estado, count(*) AS n, {_SUM} AS debt_total
FROM fact c JOIN states et ON upper(trim(c.id_estado)) = upper(trim(et.id_estado)) GROUP BY et.descripcion""")
    q["r3_top_places"] = _on_fact(f"""
SELECT ub.nombre_distrito AS ubicacion, count(*) AS n, {_SUM} AS debt_total
FROM fact c JOIN places ub ON upper(trim(c.id_ubicacion)) = upper(trim(ub.id_ubicacion))
GROUP BY ub.nombre_distrito ORDER BY n DESC, ubicacion ASC LIMIT 15""")
    q["r3b_top5_places"] = _on_fact(f"""
SELECT ub.nombre_distrito AS ubicacion, count(*) AS n, {_SUM} AS debt_total
FROM fact c JOIN places ub ON upper(trim(c.id_ubicacion)) = upper(trim(ub.id_ubicacion))
GROUP BY ub.nombre_distrito ORDER BY n DESC, ubicacion ASC LIMIT 5""")
    q["r4_by_size"] = _on_fact(f"""
SELECT tm.descripcion AS tamano, count(*) AS n, {_MEAN} AS debt_avg
FROM fact c JOIN sizes tm ON upper(trim(c.id_tamano)) = upper(trim(tm.id_tamano)) GROUP BY tm.descripcion""")
    q["r5_by_sex"] = _on_fact(f"""
SELECT sexo, count(*) AS n, CAST(sum(edad) // count(edad) AS BIGINT) AS age_avg, {_SUM} AS debt_total
FROM fact GROUP BY sexo""")
    q["r6_top_activities"] = _on_fact(f"""
SELECT ae.id_ciiu AS ciiu, ae.descripcion AS actividad, count(*) AS n, {_SUM} AS debt_total
FROM fact c JOIN activities ae ON upper(trim(c.id_ciiu)) = upper(trim(ae.id_ciiu))
GROUP BY ae.id_ciiu, ae.descripcion ORDER BY n DESC, ciiu ASC, actividad ASC LIMIT 15""")
    a1_all = _A1.format(src="fact")
    c1_deb = _C1.format(src="(SELECT * FROM fact WHERE deuda > 0)")
    q["r7_results_roundtrip"] = _on_fact(
        "SELECT *, row_number() OVER (ORDER BY valor_numerico DESC NULLS LAST, nombre_analisis, categoria, metrica) AS row_no FROM (\n"
        + _long("Salud Fiscal - Por Estado", "cat", "cantidad", "n", "CAST(n AS VARCHAR)", a1_all)
        + "\nUNION ALL " + _long("Salud Fiscal - Por Estado", "cat", "deuda_total", "debt_total", _MONEY, a1_all)
        + "\nUNION ALL " + _long("Estructura - Por Tamaño", "label", "cantidad", "n",
                                 "format('{:,} ({:.1f}%)', n, share_pct)", c1_deb) + ")")
    q["r10_run_times"] = _on_fact("""
SELECT 'Salud Fiscal - Por Estado' AS nombre_analisis, 2 * count(DISTINCT id_estado) AS n, CAST(1 AS BIGINT) AS run_times, true AS within_job FROM fact
UNION ALL SELECT 'Estructura - Por Tamaño', count(DISTINCT id_tamano), 1, true FROM fact""")
    q["r7b_category_max"] = _on_fact("""
, b AS (SELECT substr(min(id_ubicacion), 1, 24) AS label, count(*) AS n, CAST(sum(deuda) AS DOUBLE) AS debt_total
        FROM fact GROUP BY id_ubicacion ORDER BY n DESC, id_ubicacion ASC LIMIT 15),
r AS (SELECT label, CAST(CAST(n AS DECIMAL(18,4)) AS DOUBLE) AS v FROM b
      UNION ALL SELECT label, CAST(CAST(debt_total AS DECIMAL(18,4)) AS DOUBLE) FROM b)
SELECT label AS categoria, max(v) AS max_valor FROM r GROUP BY label""")
    q["j8_run_all"] = _on_fact(_RUN_ALL)
    counts = [("CONTRIBUYENTE", "fact"), ("ACTIVIDAD_ECONOMICA", "activities"), ("TIPO_EMPRESA", "types"),
              ("TAMANO_EMPRESA", "sizes"), ("UBICACION_GEOGRAFICA", "places"), ("ESTADO_TRIBUTARIO", "states"),
              ("CONDICION_DOMICILIO", "conditions")]
    q["r9_sql_star_by_state"] = _on_fact("""
SELECT et.descripcion AS estado_tributario, count(*) AS n, CAST(sum(c.deuda) AS DOUBLE) AS debt_total
FROM fact c
JOIN activities ae ON upper(trim(c.id_ciiu)) = upper(trim(ae.id_ciiu))
JOIN types te ON upper(trim(c.id_tipo_empresa)) = upper(trim(te.id_tipo_empresa))
JOIN sizes tm ON upper(trim(c.id_tamano)) = upper(trim(tm.id_tamano))
JOIN places ub ON upper(trim(c.id_ubicacion)) = upper(trim(ub.id_ubicacion))
JOIN states et ON upper(trim(c.id_estado)) = upper(trim(et.id_estado))
JOIN conditions cd ON upper(trim(c.id_condicion)) = upper(trim(cd.id_condicion))
WHERE c.deuda > 0 GROUP BY et.descripcion""")
    q["r8_table_counts"] = _on_fact(" UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {t}" for n, t in counts))
    q["r8b_all_table_counts"] = _on_fact(
        _RUN_ALL_CTES + ",\nresults_ AS (" + _RUN_ALL_SELECT + ")\n" + " UNION ALL ".join(
            f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {t}"
            for n, t in counts + [("TMP_DataOZ_Staging", "dirty"), ("RESULTADO_SPARK", "results_")]))
    q["p1_parse_rows"] = PARSED_WITH + """
SELECT seq, ddp_numruc, ddp_ciiu, ddp_tpoemp, ddp_tamano, ddp_ubigeo, ddp_estado, ddp_flag22, dds_sexo,
  dds_edad, CAST(deuda AS DOUBLE) AS deuda, condicion, reason FROM parsed"""
    q["i1_csv_roundtrip"] = PARSED_WITH + """
SELECT ddp_numruc, ddp_ciiu, ddp_tpoemp, ddp_tamano, ddp_ubigeo, ddp_estado, ddp_flag22, dds_sexo,
  dds_edad, CAST(deuda AS DOUBLE) AS deuda, condicion FROM parsed_ok"""
    q["l1_load_stats"] = PARSED_WITH + """
SELECT coalesce(reason, 'staged') AS stage, count(*) AS n FROM parsed GROUP BY 1
UNION ALL SELECT 'read', count(*) FROM parsed
UNION ALL SELECT 'candidates', count(*) FROM cand
UNION ALL SELECT 'deduplicated', count(*) FROM dedup
UNION ALL SELECT 'migrated', count(*) FROM fact
UNION ALL SELECT 'rejected', count(*) FROM rejected
UNION ALL SELECT 'new_activities', count(*) FROM activities WHERE id_ciiu <> '75113'
UNION ALL SELECT 'new_places', count(*) FROM places
UNION ALL SELECT 'new_company_types', count(*) FROM (
  SELECT DISTINCT upper(trim(t)) AS k FROM (
    SELECT """ + _norm("ddp_tpoemp", ("A", "B", "C", "D", "E", "CE", "-"), "-", first=("A", "B", "C", "D", "E")) + """ AS t
    FROM parsed_ok WHERE ddp_tpoemp IS NOT NULL)) WHERE k NOT IN (SELECT k FROM type_keys)"""
    q["h1_has_rows"] = _on_fact("SELECT count(*) >= 100 AS has_rows FROM (SELECT 1 FROM fact LIMIT 100)")
    return q
