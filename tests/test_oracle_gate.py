"""Every registered query against its DuckDB twin on the smallest tables."""


import duckdb
import pytest

import __spark_entry__ as E
from tidemark.plans.registry import QUERIES
from tools.check_oracle import TABLES, digest
from tools.check_types import SPARK_TO_DUCK

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    missing = set(QUERIES) - set(E.oracle_sql())
    assert not missing, missing


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["o_orderkey", "o_orderstatus", "o_totalprice", "__deleted_at"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    r = con.execute(E.oracle_sql()[name])
    ocols = [x[0] for x in r.description]
    orows = r.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]
    # column types line up as well (names alone are not enough for the gate)
    duck = {c: t for c, t, *_ in con.execute(f"DESCRIBE {E.oracle_sql()[name]}").fetchall()}
    for f in df.schema.fields:
        s = f.dataType.simpleString()
        want = SPARK_TO_DUCK.get(s, s.upper())
        assert duck[f.name] == want, (f.name, s, duck[f.name])


@pytest.mark.parametrize("name", ["catalog_register", "decode_typed", "tombstone_purge",
                                  "stream_resume", "version_history"])
def test_results_do_not_depend_on_the_session_zone(spark, con, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = E.queries()[name](spark, SF)
        rows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    r = con.execute(E.oracle_sql()[name])
    assert digest(df.columns, rows)[0] == digest([x[0] for x in r.description], r.fetchall())[0]
