"""Row parsing and the quarantine (blank / bad / ragged / too long)."""

from registry_analytics.plans.ingest import parse_staging, read_registry_csv, split_staging
from registry_analytics.schemas import RAW_COLUMNS
from registry_analytics.session import new_work_dir


def raw(spark, rows):
    full = [tuple(r.get(c, "") for c in ("seq",) + RAW_COLUMNS) for r in rows]
    return spark.createDataFrame(full, ", ".join(f"{c} string" for c in ("seq",) + RAW_COLUMNS))


def test_parse_reasons(spark):
    good = {"ddp_numruc": "20123", "ddp_ciiu": "5211", "deuda": "10.5", "dds_edad": "40", "condicion": "1"}
    rows = [
        dict(good, seq="1"),
        dict(good, seq="2", ddp_numruc=""),                       # blank key: skipped, not an error
        dict(good, seq="3", ddp_numruc="", dds_edad="x"),         # bad age wins over blank key
        dict(good, seq="4", ddp_numruc="12.0"),                   # not an integer
        dict(good, seq="5", ddp_numruc=" 12 "),                   # padded integer is fine
        dict(good, seq="6", deuda=""),                            # blank debt -> 0.00
        dict(good, seq="7", deuda="x"),
        dict(good, seq="8", ddp_tpoemp="ABCDEF"),                 # longer than 5
        dict(good, seq="9", dds_edad="", condicion=""),           # blank age NULL, blank condition 0
    ]
    out = {r.seq: r for r in parse_staging(raw(spark, rows), keep=("seq",)).collect()}
    assert out["1"].reason is None and out["1"].ddp_numruc == 20123 and float(out["1"].deuda) == 10.5
    assert out["2"].reason == "blank_key"
    assert out["3"].reason == "parse_error"
    assert out["4"].reason == "parse_error"
    assert out["5"].reason is None and out["5"].ddp_numruc == 12
    assert out["6"].reason is None and float(out["6"].deuda) == 0.0
    assert out["7"].reason == "parse_error"
    assert out["8"].reason == "too_long"
    assert out["9"].reason is None and out["9"].dds_edad is None and out["9"].condicion == 0


def test_csv_latin1_and_ragged(spark, tmp_path):
    path = new_work_dir(spark, "test-csv")
    import os
    os.makedirs(path, exist_ok=True)
    header = ",".join(RAW_COLUMNS)
    lines = [
        header,
        "20001,5211,A,C,Ñaña Ánimas,ACTIVO,HABIDO,MUJER,33,10.00,1",
        "20002,5211,A,C,CHIMBOTE,ACTIVO,HABIDO,MUJER,33",                 # short line
        "20003,5211,A,C,CHIMBOTE,ACTIVO,HABIDO,MUJER,33,1.00,1,extra",    # long line
    ]
    with open(f"{path}/part.csv", "wb") as f:
        f.write(("\n".join(lines) + "\n").encode("latin-1"))
    parsed = parse_staging(read_registry_csv(spark, path), keep=("seq",))
    rows = {r.ddp_numruc: r for r in parsed.collect()}
    assert rows[20001].ddp_ubigeo == "Ñaña Ánimas" and rows[20001].reason is None
    assert rows[20002].reason == "ragged"
    assert rows[20003].reason == "ragged"
    staging, quarantine = split_staging(parsed)
    assert staging.count() == 1 and quarantine.count() == 2


def test_file_order_sequence(spark):
    path = new_work_dir(spark, "test-seq")
    import os
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/a.csv", "w") as f:
        f.write(",".join(RAW_COLUMNS) + "\n" + "".join(f"{30000 + i},1,A,C,X,ACTIVO,HABIDO,MUJER,1,1,1\n"
                                                       for i in range(50)))
    df = read_registry_csv(spark, path).orderBy("seq")
    keys = [int(r.ddp_numruc) for r in df.select("ddp_numruc").collect()]
    assert keys == sorted(keys)
