import json

from tidemark.__main__ import main
from tidemark.session import fresh_dir

SF = "/root/testdata/sf0.001"


def test_cli_init_compact_status_register(spark, tmp_path, capsys):
    root = fresh_dir(spark, "t_cli")
    cfg = {"sources": {
        "public.orders": {"path": f"{SF}/orders.parquet", "primary_key": ["o_orderkey"],
                          "columns": [{"name": "o_orderkey", "pg_type": "bigint"},
                                      {"name": "o_totalprice", "pg_type": "double precision"}]},
        "public.audit": {"path": f"{SF}/events.parquet", "primary_key": [],
                         "columns": [{"name": "event_id", "pg_type": "bigint"}]}},
        "policy": {"exclude": [], "tags": {}, "policy": {}}}
    tg = spark.createDataFrame([("analyst", "public", "orders", "SELECT")],
                               "grantee string, table_schema string, table_name string, "
                               "privilege_type string")
    cg = spark.createDataFrame([("viewer", "public", "orders", "o_orderkey", "SELECT")],
                               "grantee string, table_schema string, table_name string, "
                               "column_name string, privilege_type string")
    tg.write.parquet(str(tmp_path / "tg"))
    cg.write.parquet(str(tmp_path / "cg"))
    cfg["acl"] = {"table_grants": str(tmp_path / "tg"), "column_grants": str(tmp_path / "cg"),
                  "allow": ["analyst", "viewer"], "aliases": {"analyst": "bi"}}
    path = tmp_path / "cfg.json"
    path.write_text(json.dumps(cfg))
    assert main(["init", "--root", root, "--config", str(path)]) == 0
    capsys.readouterr()
    assert main(["discover", "--config", str(path)]) == 0
    shown = capsys.readouterr().out
    assert "analyst (alias: bi)" in shown and "[o_orderkey]" in shown
    assert main(["compact", "--root", root, "--compacted-at", "2024-02-01 00:00:00"]) == 0
    capsys.readouterr()
    assert main(["status", "--root", root]) == 0
    st = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert st["active_tables"] == 1 and st["excluded_tables"] == 1 and st["roles"] == 2
    assert main(["register", "--root", root, "--db", "t_cli_db"]) == 0
    out = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert out == [{"table": "public.orders", "status": "registered",
                    "name": "t_cli_db.orders", "base_epoch": 0}]
    assert spark.table("t_cli_db.orders").count() == 1500


def test_init_writes_role_profiles(spark):
    from tidemark.plans.snapshot_init import init_tables
    from tidemark.sources import manifest
    root = fresh_dir(spark, "t_roles")
    tg = spark.createDataFrame([("analyst", "public", "orders", "SELECT"),
                                ("ops", "public", "orders", "SELECT")],
                               "grantee string, table_schema string, table_name string, "
                               "privilege_type string")
    cg = spark.createDataFrame([], "grantee string, table_schema string, table_name string, "
                                   "column_name string, privilege_type string")
    init_tables(spark, root, {"public.orders": {
        "path": f"{SF}/orders.parquet", "primary_key": ["o_orderkey"],
        "columns": [{"name": "o_orderkey", "pg_type": "bigint"}]}},
        acl={"table_grants": tg, "column_grants": cg, "allow": ["analyst", "ops"]})
    assert manifest.read_header(spark, root)["roles"] == 2


def test_stream_confirms_columns_from_a_table_that_changes(spark):
    """Columns added at the source: rejects with their values until the source's
    column table, read for each batch, has them; then they are in the deltas."""
    from tidemark.functions.types import struct_for
    from tidemark.sources import manifest, storage
    root = fresh_dir(spark, "t_cli_stream")
    column = {"name": "id", "pg_type": "bigint", "parquet_type": None, "nullable": True,
              "precision": None, "scale": None}
    manifest.publish(spark, root, manifest.entries(spark, [
        ("public.t", "active", [], ["id"], 1, [column], 0, 0, 0, "", "", None)]))

    def run(seq, row, *more):
        spark.createDataFrame([("public.t", "I", {"id": str(seq), **row}, None, None, seq)],
                              "table string, op string, row map<string,string>, lsn string, "
                              "ts timestamp_ntz, seq bigint").write.mode("append").parquet(f"{root}/_landing")
        assert main(["stream", "--root", root, "--landing", f"{root}/_landing",
                     "--checkpoint", f"{root}/_ckpt", *more]) == 0

    def rejects():
        return sorted((r["seq"], r["column_name"], r["raw"])
                      for r in storage.read_rejects(spark, root, "public.t").collect())

    def source(*columns):
        spark.createDataFrame([("public.t", c, t, True, i) for i, (c, t) in enumerate(columns)],
                              "table string, column string, pg_type string, nullable boolean, ordinal int") \
            .write.mode("overwrite").parquet(f"{root}/_source")
        return "--source-columns", f"{root}/_source"

    run(1, {"a": "x", "b": "1"})
    assert rejects() == [(1, "a", "x"), (1, "b", "1")]
    run(2, {"a": "y", "b": "2"}, *source(("id", "bigint"), ("b", "integer")))
    assert rejects() == [(1, "a", "x"), (1, "b", "1"), (2, "a", "y")]
    run(3, {"a": "z", "b": "3"}, *source(("id", "bigint"), ("b", "integer"), ("a", "text")))
    assert rejects() == [(1, "a", "x"), (1, "b", "1"), (2, "a", "y")]
    e = manifest.entry(spark, root, "public.t")
    assert ([c["name"] for c in e["columns"]], e["schema_version"]) == (["id", "b", "a"], 3)
    schema = storage.delta_schema(struct_for([{"name": c["name"], "pg_type": c["pg_type"]} for c in e["columns"]]))
    got = sorted((r["id"], r["b"], r["a"]) for r in storage.read_deltas(spark, root, "public.t", schema).collect())
    assert [(i, b) for i, b, _ in got] == [(1, None), (2, 2), (3, 3)] and [a for *_, a in got] == [None, None, "z"]


def test_cli_log_views_and_sweep(spark, tmp_path, capsys):
    """A log in batches of two, one a run; views follow; a sweep takes what the grace period held."""
    from tests.test_delivery import event, loaded
    from tidemark.operators.events import EVENT_SCHEMA
    root, db = loaded(spark, "t_cli_log"), "t_cli_views"
    spark.createDataFrame([event(s, "I", s, f"v{s}") for s in range(10, 16)], EVENT_SCHEMA).coalesce(1).write.parquet(f"{root}/_log")
    args = ["stream", "--root", root, "--log", f"{root}/_log", "--checkpoint", f"{root}/_c", "--rows", "2", "--wait", "0",
            "--start", "10", "--views-db", db]
    assert main(args) == main(args) == 0
    assert {r["id"] for r in spark.newSession().table(f"{db}.t_live").collect()} == {1, 11, 12, 13, 14}
    assert main(["compact", "--root", root, "--compacted-at", "2024-02-01 00:00:00", "--grace", "3600", "--keep-bases", "1"]) == 0
    assert main(["view", "--root", root, "--table", "t", "--db", db]) == 0
    capsys.readouterr()
    assert main(["sweep", "--root", root, "--grace", "3600"]) == main(["sweep", "--root", root]) == 0
    out = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert out == [{"table": "t", "deltas": [], "bases": []}, {"table": "t", "deltas": [1, 2], "bases": [0]}]
    assert spark.table(f"{db}.t_live").count() == 5
