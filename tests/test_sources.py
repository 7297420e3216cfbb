"""Sources: load gate, table counts, observed row count, JDBC options."""

import pytest
from pyspark.sql import functions as F

from registry_analytics.sources.files import count_on_read, has_rows, table_counts
from registry_analytics.sources.jdbc import jdbc_options
from registry_analytics.sources.sql import query, register_views


def test_has_rows_and_missing_table(spark):
    df = spark.range(150)
    assert has_rows(df, 100) and not has_rows(df, 151)
    assert not has_rows(spark.range(0), 1)


def test_table_counts_keeps_empty_tables(spark):
    out = {r.table_name: r.n_rows for r in table_counts({"a": spark.range(3), "b": spark.range(0)}).collect()}
    assert out == {"a": 3, "b": 0}


def test_count_on_read_without_extra_pass(spark):
    df, obs = count_on_read(spark.range(42))
    assert df.filter("id % 2 = 0").count() == 21
    assert obs.get["rows"] == 42


def test_jdbc_options_need_bounds_for_parallel_reads():
    o = jdbc_options("jdbc:x://h/db", "T", {"user": "u"}, "id", 1, 1000, num_partitions=8)
    assert o["partitionColumn"] == "id" and o["numPartitions"] == "8" and o["upperBound"] == "1000"
    assert "partitionColumn" not in jdbc_options("jdbc:x://h/db", "T")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x://h/db", "T", partition_column="id")


def test_sql_with_bound_parameters(spark):
    register_views(spark, {"t_nums": spark.range(10)})
    assert query(spark, "SELECT count(*) AS n FROM t_nums WHERE id >= :lo", {"lo": 7}).first().n == 3


def test_load_gate_on_stored_tables(spark):
    from registry_analytics.session import new_work_dir
    from registry_analytics.sources.files import table_has_rows, write_table

    path = new_work_dir(spark, "test-gate")
    assert not table_has_rows(spark, path, 1)          # missing table
    write_table(spark.range(120), path)
    assert table_has_rows(spark, path, 100) and not table_has_rows(spark, path, 121)


def test_csv_by_header_name_and_standard_quoting(spark, tmp_path):
    """Columns in another order, one more column, doubled quotes, backslashes, a quoted line break: as Python's csv reads them."""
    import csv
    import io

    from registry_analytics.sources.files import read_csv_raw

    rows = [["x1", 'EL ""BUEN"" LUGAR', "1"], ["x2", "CALLE\\", "2"], ["x3", "a,b", "3"], ["x4", "two\nlines", "4"]]
    text = "extra,name,key\n" + "".join('%s,"%s",%s\n' % tuple(r) for r in rows)
    (tmp_path / "a.csv").write_text(text, encoding="latin-1")
    want = {(r["key"], r["name"]) for r in csv.DictReader(io.StringIO(text))}
    got = read_csv_raw(spark, str(tmp_path), ["key", "name"], multiline=True)
    assert {(r.key, r.name) for r in got.select("key", "name").collect()} == want
    with pytest.raises(ValueError):
        read_csv_raw(spark, str(tmp_path), ["key", "gone"])


def test_texts_round_like_python(spark):
    from registry_analytics.functions.formats import fmt_count_pct, fmt_money, fmt_years

    values = [12.25, 0.25, 6.25, 0.35, 99.95]
    got = spark.createDataFrame([(v,) for v in values], "x double").select(fmt_count_pct(F.lit(1234), "x"), fmt_years("x")).collect()
    assert [tuple(r) for r in got] == [(f"1,234 ({v:.1f}%)", f"{v:.1f} años") for v in values]
    big = spark.sql("SELECT CAST('200000000000000.55' AS decimal(38,2)) AS x")
    assert big.select(fmt_money("x")).first()[0] == "S/ 200,000,000,000,000.55"


def test_jdbc_predicates_split_rows_not_key_ranges():
    """Keys in two dense runs and a few far ones: ranges by the histogram hold about equal row counts, and cover each row once."""
    from registry_analytics.sources import jdbc

    keys = [*range(1_000, 9_000), *range(500_000, 501_000), 999_999, 7, 7]
    bounds, parts = (min(keys), max(keys)), 8
    assert jdbc.bounds_query("T", "k") == "(SELECT MIN(k) AS lo, MAX(k) AS hi FROM T) b"
    buckets = jdbc.BUCKETS_PER_PARTITION * parts
    width = jdbc.bucket_width(bounds, buckets)
    assert jdbc.histogram_query("T", "k", bounds, buckets) == (
        f"(SELECT FLOOR((k - (7)) / {width}) AS bucket, COUNT(*) AS n FROM T WHERE k IS NOT NULL GROUP BY FLOOR((k - (7)) / {width})) h")
    counts = {}
    for k in keys:
        counts[(k - bounds[0]) // width] = counts.get((k - bounds[0]) // width, 0) + 1
    assert len(counts) <= buckets
    cuts = jdbc.balanced_cuts(counts, bounds, buckets, parts)
    predicates = jdbc.range_predicates("k", cuts)
    assert len(predicates) == parts and predicates[0] == f"k < {cuts[0]} OR k IS NULL" and predicates[-1] == f"k >= {cuts[-1]}"
    con = __import__("duckdb").connect()
    con.execute("CREATE TABLE t AS SELECT unnest(?::BIGINT[]) AS k", [keys])
    con.execute("INSERT INTO t VALUES (NULL), (NULL)")
    sizes = [con.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in predicates]
    assert sum(sizes) == len(keys) + 2 and max(sizes) < 1.5 * len(keys) / parts
    equal = [sum(1 for k in keys if bounds[0] + i * (bounds[1] - bounds[0]) / parts <= k) for i in range(parts)]
    assert equal[0] - equal[1] > 6 * max(sizes) / 1.5  # equal ranges would give one task nearly all rows
    assert jdbc.range_predicates("k", jdbc.balanced_cuts({}, (0, 0), buckets, parts)) == ["1 = 1"]
    assert jdbc.range_predicates("k", jdbc.balanced_cuts({0: 50}, (5, 5), buckets, parts)) == ["1 = 1"]


def exact_percentiles(values, qs):
    import math

    values = sorted(values)
    return [values[max(math.ceil(q * len(values)), 1) - 1] for q in qs]


def test_radix_percentiles_are_exact_for_every_number_type(spark):
    import random
    from decimal import Decimal

    from registry_analytics.operators.ranks import order_key, percentiles_disc

    r = random.Random(1)
    qs = [0, 0.01, 0.25, 0.5, 0.9, 0.999, 1]
    edges = [0.0, 5e-324, -5e-324, 1.7e308, 2.2250738585072014e-308, 2.225073858507201e-308, float("inf"), float("-inf")]
    cases = {
        "double": [r.gauss(0, 1) * 10 ** r.randint(-300, 300) for _ in range(800)] + edges + [s * 2.0**k for k in range(-1074, 1024, 9) for s in (1, -1)],
        "bigint": [r.randint(-(2**63), 2**63 - 1) for _ in range(500)] + [2**63 - 1, -(2**63)],
        "int": [7] * 100 + [8],
        "smallint": [(1 << 14) - 1, 1 << 14] * 5,
        "decimal(18,2)": [Decimal(r.randint(-(10**17), 10**17)).scaleb(-2) for _ in range(400)],
    }
    for kind, values in cases.items():
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], f"x {kind}")
        assert percentiles_disc(df, "x", qs) == exact_percentiles(values, qs), kind
        keys = sorted(set(map(tuple, df.where("x IS NOT NULL").select("x", order_key(F.col("x"), df.schema["x"].dataType)).collect())))
        assert all(a[1] < b[1] for a, b in zip(keys, keys[1:])), kind
    assert percentiles_disc(spark.createDataFrame([], "x int"), "x", [0.5]) == [None]
    with pytest.raises(TypeError):
        percentiles_disc(spark.createDataFrame([("a",)], "x string"), "x", [0.5])


def test_exact_percentiles_at_three_million_distinct_values_of_one_octave(spark):
    from registry_analytics.operators.ranks import percentiles_disc

    df = spark.range(3_000_000).select(((F.col("id") + (1 << 22)) / 100).cast("decimal(18,2)").alias("x"))
    assert [float(v) for v in percentiles_disc(df, "x", [0.1, 0.5, 0.9])] == [((1 << 22) + int(q * 3_000_000) - 1) / 100 for q in (0.1, 0.5, 0.9)]
    mixed = spark.range(1_000_001).select((F.pmod(F.xxhash64("id"), F.lit(10**12)) / 100).cast("decimal(18,2)").alias("x"))
    want = mixed.selectExpr(*[f"percentile_disc({q}) WITHIN GROUP (ORDER BY x) AS p" for q in (0.1, 0.5, 0.9)]).first()
    assert [float(v) for v in percentiles_disc(mixed, "x", [0.1, 0.5, 0.9])] == [float(v) for v in want]
