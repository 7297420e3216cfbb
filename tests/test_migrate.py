"""Migration semantics: filter -> normalise -> first-row-wins -> rules."""

from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry_analytics.operators.dedup import duplicate_keys, first_wins
from registry_analytics.operators.quality import Rule, rule_counts, split_valid
from registry_analytics.plans.lookups import grow_lookups, seed_lookups
from registry_analytics.plans.migrate import migrate
from registry_analytics.schemas import STAGING

COLS = [f.name for f in STAGING.fields]


def staging(spark, rows):
    base = dict(ddp_numruc=None, ddp_ciiu="5211", ddp_tpoemp="A", ddp_tamano="C", ddp_ubigeo="CHIMBOTE",
                ddp_estado="ACTIVO", ddp_flag22="HABIDO", dds_sexo="MUJER", dds_edad=30, deuda=Decimal("1.00"),
                condicion=0)
    data = [tuple({**base, **r}[c] for c in COLS) + (i,) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, T.StructType(STAGING.fields + [T.StructField("seq", T.LongType())]))


def test_first_row_rejected_drops_its_duplicates(spark):
    st = staging(spark, [
        dict(ddp_numruc=20001, dds_edad=150),   # first row of the key breaks the age rule
        dict(ddp_numruc=20001, dds_edad=40),    # its duplicate must not take its place
        dict(ddp_numruc=20002),
        dict(ddp_numruc=9999),                  # key below 10000
        dict(ddp_numruc=20003, ddp_ciiu=None),  # required code missing
        dict(ddp_numruc=20004, deuda=Decimal("-3.00"), ddp_estado="2ACTIVO", ddp_tpoemp="B9"),
    ])
    lk, _ = grow_lookups(st, seed_lookups(spark))
    m = migrate(st, lk)
    fact = {r.ruc: r for r in m.fact.collect()}
    assert set(fact) == {20002, 20004, 611077}  # CHIMBOTE is a grown place, so the special row is valid
    assert fact[20004].deuda == Decimal("0.00") and fact[20004].id_estado == "ACTIVO"
    assert fact[20004].id_tipo_empresa == "B"
    rej = m.rejected.collect()
    assert [(r.ruc, r.broken_rules) for r in rej] == [(20001, ["edad_range"])]
    assert m.deduped.count() == 3
    assert m.special.count() == 1


def test_special_row_rejected_when_place_missing(spark):
    st = staging(spark, [dict(ddp_numruc=20002, ddp_ubigeo="Lima")])
    lk, _ = grow_lookups(st, seed_lookups(spark))
    m = migrate(st, lk)
    assert sorted(r.ruc for r in m.fact.collect()) == [20002]
    assert [(r.ruc, r.broken_rules) for r in m.rejected.collect()] == [(611077, ["fk_place"])]


def test_special_row_not_inserted_when_present(spark):
    st = staging(spark, [dict(ddp_numruc=611077, dds_sexo="HOMBRE")])
    lk, _ = grow_lookups(st, seed_lookups(spark))
    m = migrate(st, lk)
    assert [(r.ruc, r.sexo) for r in m.fact.collect()] == [(611077, "HOMBRE")]


def test_rule_split_null_passes_and_two_rules(spark):
    df = spark.createDataFrame([(1, None, "X"), (2, 200, "X"), (3, 200, "ZZZZZZ"), (4, 10, "A")],
                               "id int, age int, code string")
    rules = [Rule("age", F.col("age").between(0, 120)), Rule("code_len", F.length("code") <= 3)]
    valid, rejected = split_valid(df, rules)
    assert sorted(r.id for r in valid.collect()) == [1, 4]
    got = {r.id: r.broken_rules for r in rejected.collect()}
    assert got == {2: ["age"], 3: ["age", "code_len"]}
    counts = {r.rule: r.n for r in rule_counts(rejected).collect()}
    assert counts == {"age": 2, "code_len": 1}


def test_first_wins_and_duplicates(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (2, 5, "z")], "k int, o int, v string")
    assert sorted((r.k, r.v) for r in first_wins(df, "k", ["o"]).collect()) == [(1, "a"), (2, "z")]
    assert [(r.k, r.n) for r in duplicate_keys(df, "k").collect()] == [(1, 3)]


def test_csv_to_results_end_to_end(spark):
    import os

    from registry_analytics.plans.jobs import ANALYSIS_NAMES, run_registry_from_csv
    from registry_analytics.schemas import RAW_COLUMNS
    from registry_analytics.session import new_work_dir
    from registry_analytics.sources.results import load_results

    path = new_work_dir(spark, "test-e2e")
    os.makedirs(path, exist_ok=True)
    lines = [",".join(RAW_COLUMNS),
             "20001,5211,A7,c,Chimbote,2ACTIVO,2HABIDO,hombre,40,-3.50,",
             "20001,5211,B,M,Chimbote,ACTIVO,HABIDO,MUJER,41,10.00,1",     # duplicate key: dropped
             "20002,1511,CE,G,CHIMBOTE,10,ZZ,MUJER,130,5.00,0",             # age 130: rejected
             "20003,7010,-,B,Santa,INACTIVO,7,X,,1.00,0",
             ",5211,A,C,Santa,ACTIVO,HABIDO,MUJER,30,1.00,0",                # blank key: skipped
             "20004,5211,A,C,Santa,ACTIVO,HABIDO,MUJER,x,1.00,0"]            # bad age: quarantined
    with open(f"{path}/reg.csv", "wb") as f:
        f.write(("\n".join(lines) + "\n").encode("latin-1"))
    reg, results = run_registry_from_csv(spark, path)
    fact = {r.ruc: r for r in reg.fact.collect()}
    assert sorted(fact) == [20001, 20003, 611077]
    assert (fact[20001].id_tipo_empresa, fact[20001].id_tamano, fact[20001].id_estado,
            fact[20001].id_condicion, fact[20001].sexo, str(fact[20001].deuda)) == ("A", "C", "ACTIVO", "HABIDO",
                                                                                    "HOMBRE", "0.00")
    assert [r.ruc for r in reg.rejected.collect()] == [20002]
    stored = {r.nombre_analisis for r in load_results(spark, results).select("nombre_analisis").distinct().collect()}
    assert stored == set(ANALYSIS_NAMES.values())
