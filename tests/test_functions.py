import re

import pytest
from pyspark.sql import functions as F

from tidemark.functions.glob import glob_to_regex
from tidemark.functions.lsn import long_to_lsn, lsn_lag, lsn_to_long
from tidemark.functions.names import flat_name, schema_of, table_of, truncate_version
from tidemark.functions.types import catalog_type, category, coerce


@pytest.mark.parametrize("pattern,name,hit", [
    ("ledger.*", "ledger.entries", True),
    ("ledger.*", "public.ledger", False),
    ("*.visits*", "web.visits_2024", True),
    ("*.scratch_*", "web.scratch_x", True),
    ("*", "a.b", True),                     # '*' crosses dots
    ("*", "a/b", False),                    # but not separators
    ("public.t?", "public.t1", True),
    ("public.[ab]x", "public.bx", True),
    ("public.[^ab]x", "public.bx", False),
    ("public.[a-c]x", "public.cx", True),
    ("x\\*", "x*", True),
    ("bad[", "bad[", False),                # malformed matches nothing
])
def test_glob(pattern, name, hit):
    assert bool(re.match(glob_to_regex(pattern), name)) is hit


@pytest.mark.parametrize("pg,cat,hive", [
    ("integer", "INT32", "int"), ("bigint", "INT64", "bigint"), ("boolean", "BOOLEAN", "boolean"),
    ("real", "FLOAT", "float"), ("double precision", "DOUBLE", "double"),
    ("numeric(10,2)", "DECIMAL", "decimal(10,2)"), ("numeric", "DECIMAL", "decimal(38,0)"),
    ("text", "UTF8", "string"), ("json", "JSON", "string"), ("uuid", "UUID", "string"),
    ("timestamp with time zone", "TIMESTAMP_MICROS", "timestamp"), ("date", "DATE", "date"),
    ("time", "TIME_MICROS", "string"), ("bytea", "BYTE_ARRAY", "binary"),
    ("int4range", "UTF8", "string"),
])
def test_type_map(pg, cat, hive):
    from tidemark.functions.types import parse_pg_type
    _, p, s, _ = parse_pg_type(pg)
    assert category(pg) == cat
    assert catalog_type(cat, p, s) == hive


def test_coerce_null_and_zero(spark):
    df = spark.createDataFrame([("12", "t", "1.50", "\\x4142"), ("bad", "yes", "x", "raw"),
                                (None, None, None, None)], "i string, b string, d string, y string")
    r = df.select(coerce(F.col("i"), "integer").alias("i"), coerce(F.col("b"), "boolean").alias("b"),
                  coerce(F.col("d"), "numeric(10,2)").alias("d"),
                  coerce(F.col("y"), "bytea").alias("y"),
                  coerce(F.col("i"), "integer", "zero").alias("iz")).collect()
    assert r[0]["i"] == 12 and r[0]["b"] is True and str(r[0]["d"]) == "1.50"
    assert bytes(r[0]["y"]) == b"AB" and bytes(r[1]["y"]) == b"raw"
    assert r[1]["i"] is None and r[1]["iz"] == 0 and r[1]["b"] is True
    assert r[2]["iz"] is None


def test_lsn(spark):
    df = spark.createDataFrame([("F/FFF00000", "10/100000"), ("0/16B3740", "0/16B4000"),
                                ("zz", "1/0")], "a string, b string")
    r = df.select(lsn_to_long(F.col("a")).alias("n"), lsn_lag(F.col("b"), F.col("a")).alias("lag"),
                  long_to_lsn(lsn_to_long(F.col("b"))).alias("back")).collect()
    assert r[0]["n"] == 0xF << 32 | 0xFFF00000
    assert r[0]["lag"] == (0x10 << 32 | 0x100000) - (0xF << 32 | 0xFFF00000) > 0
    assert r[1]["lag"] == 0x16B4000 - 0x16B3740
    assert r[0]["back"] == "10/100000" and r[2]["n"] is None


def test_names(spark):
    df = spark.createDataFrame([("public.users",), ("billing.invoices",), (".users",),
                                ("nodot",), ("a.b.c",)], "q string")
    r = df.select(schema_of(F.col("q")).alias("s"), table_of(F.col("q")).alias("t"),
                  flat_name(schema_of(F.col("q")), table_of(F.col("q"))).alias("f")).collect()
    assert [x["f"] for x in r] == ["users", "billing_invoices", "users", None, "a_b.c"]
    assert r[3]["s"] is None and r[4]["t"] == "b.c"
    v = spark.createDataFrame([("16.2 (Debian 16.2-1)",), ("(odd) 1",), ("15.4",)], "v string")
    assert [x[0] for x in v.select(truncate_version(F.col("v"))).collect()] == \
        ["16.2", "(odd) 1", "15.4"]


def test_column_and_python_type_maps_agree(spark):
    """The catalog frame's Column form agrees with the Python form for every
    source type name (plus decimals, arrays and an unknown type)."""
    from tidemark.functions.types import PG_CATEGORY, parse_pg_type
    from tidemark.sources.catalog import typed_columns
    names = sorted(PG_CATEGORY) + ["numeric(10,2)", "numeric(7)", "int4[]", "tsrange"]
    df = spark.createDataFrame([(n,) for n in names], "pg_type string")
    got = {r["pg_type"]: (r["category"], r["catalog_type"]) for r in typed_columns(df).collect()}
    for n in names:
        _, p, s, _ = parse_pg_type(n)
        assert got[n] == (category(n), catalog_type(category(n), p, s)), n


def test_a_catalog_column_is_typed_once(spark, tmp_path):
    """The type text is looked at once a row, and the rows of a small file are spread over tasks."""
    from tidemark.plans.tenants import tenant_tables
    from tidemark.sources.catalog import typed_columns
    plan = typed_columns(spark.range(1).select(F.concat(F.lit("int"), "id").alias("pg_type")))._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("regexp_replace") == 1
    spark.range(9).selectExpr("id AS c_custkey", "1 AS c_nationkey", "1.0D AS c_acctbal", "'A' AS c_mktsegment") \
        .coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    t = tenant_tables(spark, str(tmp_path))
    assert "Repartition" in t._jdf.queryExecution().optimizedPlan().toString() and t.count() == 36


def test_epoch_names_and_locations(spark):
    from tidemark.functions.names import epoch_name, location
    df = spark.createDataFrame([(1, "public.orders"), (1234567, "billing.x")],
                               "e bigint, q string")
    r = df.select(epoch_name("epoch=", F.col("e")).alias("n"),
                  location(F.lit("warehouse/cdc"), F.col("q"), F.col("e")).alias("l")).collect()
    assert [x["n"] for x in r] == ["epoch=000001", "epoch=1234567"]
    assert r[0]["l"] == "warehouse/cdc/public.orders/base/__base_epoch=1"


def test_suggest_buckets():
    from tidemark.sources.storage import suggest_buckets
    assert suggest_buckets(100 * 2**40) == 262144          # 100 TiB at 512 MiB
    assert suggest_buckets(0) == 8 and suggest_buckets(3 * 2**30) == 8
    n = suggest_buckets(10 * 2**30 + 1)
    assert n == 32 and n & (n - 1) == 0                      # a power of two


def test_glob_brackets():
    import re as _re

    from tidemark.functions.glob import glob_to_regex
    for bad in ("[]a]", "[-a]", "[a-]", "[", "[a", "[^", "[a-", "a[\\"):
        assert not any(_re.match(glob_to_regex(bad), x) for x in ("a", "-", "]", "[", "")), bad
    assert _re.match(glob_to_regex("[z-aq]"), "q") and not _re.match(glob_to_regex("[z-aq]"), "m")
    assert not _re.match(glob_to_regex("[z-a]"), "b") and _re.match(glob_to_regex("[^z-a]"), "b")
    assert _re.match(glob_to_regex("x[a-c\\]]"), "x]") and not _re.match(glob_to_regex("x[^a-c]"), "xb")


def test_precision_inside_a_type_name():
    from tidemark.functions.types import category, parse_pg_type, spark_type
    assert parse_pg_type("timestamp(3) without time zone") == ("timestamp without time zone", 3, None, False)
    assert category("timestamp(3) without time zone") == category("timestamp without time zone")
    assert spark_type("timestamp(3) with time zone") == spark_type("timestamp with time zone")
    assert category("numeric(10,-2)") == "DECIMAL"
