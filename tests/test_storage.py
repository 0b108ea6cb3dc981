"""Layout, manifest, compaction and plan-shape tests."""

import time
import pytest
from tidemark.sources import fs
from pyspark.sql import functions as F

from tidemark.operators.merge import merge
from tidemark.plans import compaction
from tidemark.plans import storage_queries as SQ
from tidemark.plans.consumer import as_of
from tidemark.plans.feeds import COMPACTED_AT, ORDERS_PK, ORDERS_TABLE
from tidemark.session import fresh_dir
from tidemark.sources import manifest, storage

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_merge_shuffles_only_the_deltas(spark):
    root = fresh_dir(spark, "t_bucket")
    SQ._setup_table(spark, SF, root, buckets=4)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    try:
        base, _ = storage.read_base(spark, root, ORDERS_TABLE, storage.base_schema(SQ.ORDERS_DATA),
                                    buckets=4, pk=ORDERS_PK)
        deltas = storage.read_deltas(spark, root, ORDERS_TABLE,
                                     storage.delta_schema(SQ.ORDERS_DATA), after=0, upto=20)
        out = merge(base, deltas, ORDERS_PK, COMPACTED_AT, strategy="full", null_safe=False)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plan = _plan(out)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 1, plan
    assert "SortMergeJoin" in plan


def test_delta_reads_prune_epochs(spark):
    root = fresh_dir(spark, "t_prune")
    SQ._write_feed(spark, SF, root)
    assert storage.delta_epochs(spark, root, ORDERS_TABLE) == list(range(1, 31))
    d = storage.read_deltas(spark, root, ORDERS_TABLE, storage.delta_schema(SQ.ORDERS_DATA),
                            after=5, upto=7)
    fmt = d._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in fmt or "__epoch" in fmt
    assert sorted({r["__epoch"] for r in d.select("__epoch").collect()}) == [6, 7]
    before = d.count()
    SQ._write_feed(spark, SF, root)            # replay: same partitions, same rows
    assert storage.read_deltas(spark, root, ORDERS_TABLE, storage.delta_schema(SQ.ORDERS_DATA),
                               after=5, upto=7).count() == before


def test_compaction_publishes_then_drops(spark):
    root = fresh_dir(spark, "t_compact")
    SQ._setup_table(spark, SF, root)
    assert compaction.tables_to_compact(spark, root) == [ORDERS_TABLE]
    res = compaction.compact_table(spark, root, ORDERS_TABLE, COMPACTED_AT)
    assert res["status"] == "compacted" and res["base_epoch"] == 20
    feed = SQ.feed_a(spark, SF).filter("__epoch <= 20")
    assert res["applied"] == feed.count() and res["deltas"] == 20 and res["purged"] == 0
    e = manifest.entry(spark, root, ORDERS_TABLE)
    assert e["base_epoch"] == 20 and e["row_count"] == res["rows"]
    assert storage.delta_epochs(spark, root, ORDERS_TABLE) == list(range(21, 31))
    assert storage.base_epochs(spark, root, ORDERS_TABLE) == [0, 20]
    assert compaction.tables_to_compact(spark, root) == []
    assert compaction.compact_table(spark, root, ORDERS_TABLE, COMPACTED_AT)["status"] == \
        "up to date"
    assert manifest.read_header(spark, root)["last_compacted_at"] == COMPACTED_AT
    # epochs between the old base and the new one are gone: an error, not a wrong answer
    try:
        as_of(spark, root, ORDERS_TABLE, 5, COMPACTED_AT)
        raise AssertionError("expected ValueError")
    except ValueError:
        pass
    assert as_of(spark, root, ORDERS_TABLE, 0, COMPACTED_AT).count() == \
        spark.read.parquet(f"{SF}/orders.parquet").count()


def test_purge_in_compaction(spark):
    root = fresh_dir(spark, "t_purge")
    SQ._setup_table(spark, SF, root)
    res = compaction.compact_table(spark, root, ORDERS_TABLE, COMPACTED_AT,
                                   now="2024-03-10 00:00:00", retention_days=30)
    assert res["purged"] == res["tombstones_before_purge"] > 0
    df, _ = storage.read_base(spark, root, ORDERS_TABLE, storage.base_schema(SQ.ORDERS_DATA))
    assert df.filter(F.col("__deleted_at").isNotNull()).count() == 0


def test_leftovers_of_a_dead_publisher_are_overwritten(spark):
    """A crash between a segment or snapshot and its header must not wedge the manifest."""
    root = fresh_dir(spark, "t_left")
    SQ._setup_table(spark, SF, root)
    manifest.read_tables(spark, root).limit(0).write.json(f"{root}/_manifest/log/s=1")
    manifest.read_tables(spark, root).limit(0).write.json(f"{root}/_manifest/tables/v=2")
    manifest.update_tables(spark, root, spark.createDataFrame(
        [(ORDERS_TABLE, 26)], "table string, latest_delta_epoch bigint"))
    assert manifest.entry(spark, root, ORDERS_TABLE)["latest_delta_epoch"] == 26
    manifest.publish(spark, root, manifest.read_tables(spark, root))
    assert manifest.entry(spark, root, ORDERS_TABLE)["latest_delta_epoch"] == 26


def test_tables_without_a_header_are_an_error(spark):
    root = fresh_dir(spark, "t_headless")
    assert manifest.read_header(spark, root) == {}
    spark.range(1).write.json(f"{root}/_manifest/tables/v=1")
    with pytest.raises(RuntimeError):
        manifest.read_tables(spark, root)


def test_headers_are_numbered_and_old_ones_go(spark):
    root = fresh_dir(spark, "t_headers")
    for i in range(20):
        manifest.write_header(spark, root, {"i": i})
    assert manifest.read_header(spark, root)["i"] == 19
    assert len(manifest._headers(spark, root)) <= 18


def test_lock_belongs_to_its_owner(spark):
    root = fresh_dir(spark, "t_lock")
    lock = f"{root}/_manifest/_publish.lock"
    with manifest.publish_lock(spark, root):
        with pytest.raises(TimeoutError):
            with manifest.publish_lock(spark, root, wait_s=0.3):
                pass
        # a live owner renews: it is not broken even by a waiter with a short lease
        fs.delete(spark, lock)
        fs.create_exclusive(spark, lock, "another")
    assert fs.read_text(spark, lock) == "another"     # not ours any more: left alone
    time.sleep(1.1)
    with manifest.publish_lock(spark, root, lease_s=1.0, wait_s=5):
        pass                                            # the dead owner's lock is broken
    assert not fs.exists(spark, lock)


def test_one_failing_table_does_not_stop_the_others(spark):
    root = fresh_dir(spark, "t_fail")
    SQ._setup_table(spark, SF, root)
    cols = manifest.entry(spark, root, ORDERS_TABLE)["columns"]
    manifest.update_tables(spark, root, spark.createDataFrame(
        [("public.a", "active", cols, 0, 3)], "table string, status string, columns array<struct<name:string,"
        "pg_type:string,parquet_type:string,nullable:boolean,precision:int,scale:int>>, "
        "base_epoch bigint, latest_delta_epoch bigint"))
    res = {r["table"]: r["status"] for r in compaction.compact_all(spark, root, SQ.COMPACTED_AT)}
    assert res["public.a"].startswith("failed") and res[ORDERS_TABLE] == "compacted"


def test_manifest_log_appends_and_folds(spark):
    """Updates append small log segments; reads fold them; every LOG_FOLD
    segments a new snapshot is written and the log starts over."""
    root = fresh_dir(spark, "t_log")
    manifest.publish(spark, root, manifest.entries(spark, [
        ("a.t", "active", [], ["id"], 1, None, 0, 0, 10, "", ""),
        ("b.t", "active", [], ["id"], 1, None, 0, 0, 20, "", "")]))
    for e in range(1, manifest.LOG_FOLD + 3):
        manifest.update_tables(spark, root, spark.createDataFrame(
            [("a.t", e)], "table string, latest_delta_epoch bigint"))
        h = manifest.read_header(spark, root)
        assert len(h["log"]) < manifest.LOG_FOLD
        if e == 3:
            got = {r["table"]: (r["latest_delta_epoch"], r["row_count"])
                   for r in manifest.read_tables(spark, root).collect()}
            assert got == {"a.t": (3, 10), "b.t": (0, 20)} and h["tables_version"] == 1
    h = manifest.read_header(spark, root)
    assert h["tables_version"] == 2 and len(h["log"]) == 2
    assert manifest.entry(spark, root, "a.t")["latest_delta_epoch"] == manifest.LOG_FOLD + 2
    assert manifest.entry(spark, root, "b.t")["row_count"] == 20


def test_parallel_compaction_of_many_tables(spark):
    """Three tables compacted concurrently: every publish lands (retries)."""
    from tidemark.plans.feeds import feed_a, orders_base
    root = fresh_dir(spark, "t_many")
    names = ["public.orders", "shop.orders", "audit.orders"]
    entries = []
    for i, t in enumerate(names):
        storage.write_base(orders_base(spark, SF), root, t, 0, buckets=2 if i == 1 else None,
                           pk=ORDERS_PK)
        storage.write_delta(feed_a(spark, SF), root, t)
        entries.append((t, "active", [], ORDERS_PK, 1, SQ.ORDERS_COLUMNS, 0, 10 + i, None,
                        f"{root}/{t}", "", 2 if i == 1 else None))
    manifest.publish(spark, root, manifest.entries(spark, entries))
    res = compaction.compact_all(spark, root, COMPACTED_AT, parallelism=3)
    assert sorted(r["status"] for r in res) == ["compacted"] * 3, res
    got = {r["table"]: r["base_epoch"] for r in manifest.read_tables(spark, root).collect()}
    assert got == {"public.orders": 10, "shop.orders": 11, "audit.orders": 12}
    assert spark.conf.get("spark.sql.shuffle.partitions") != "2"      # no leak


def test_first_compaction_without_base(spark):
    root = fresh_dir(spark, "t_nobase")
    SQ._write_feed(spark, SF, root)
    entry = manifest.entries(spark, [(ORDERS_TABLE, "active", [], ORDERS_PK, 1, SQ.ORDERS_COLUMNS, 0, 30, None, "", "",
          None)])
    manifest.publish(spark, root, entry)
    res = compaction.compact_table(spark, root, ORDERS_TABLE, COMPACTED_AT)
    assert res["status"] == "compacted" and res["rows"] > 0
    assert storage.delta_epochs(spark, root, ORDERS_TABLE) == []
    df, e = storage.read_base(spark, root, ORDERS_TABLE, storage.base_schema(SQ.ORDERS_DATA))
    assert e == 30 and df.count() == res["rows"]


def test_no_primary_key_is_an_error(spark):
    root = fresh_dir(spark, "t_nopk")
    entry = manifest.entries(spark, [(ORDERS_TABLE, "active", [], [], 1, SQ.ORDERS_COLUMNS, 0, 3, None, "", "", None)])
    manifest.publish(spark, root, entry)
    try:
        compaction.compact_table(spark, root, ORDERS_TABLE, COMPACTED_AT)
        raise AssertionError("expected ValueError")
    except ValueError as e:
        assert "primary key" in str(e)


def test_bucketed_base_reads_added_columns_as_null(spark):
    from pyspark.sql import types as T
    root = fresh_dir(spark, "t_bucket_evolve")
    SQ._setup_table(spark, SF, root, buckets=2)
    wider = T.StructType(storage.base_schema(SQ.ORDERS_DATA).fields +
                         [T.StructField("note", T.StringType())])
    df, _ = storage.read_base(spark, root, ORDERS_TABLE, wider, buckets=2, pk=ORDERS_PK)
    assert df.columns[-1] == "note" and df.filter("note IS NOT NULL").count() == 0
    assert as_of(spark, root, ORDERS_TABLE, 3, COMPACTED_AT).count() > 0


def test_compaction_retry_after_partial_write(spark):
    """A failed attempt left a partial base directory: the retry replaces it."""
    root = fresh_dir(spark, "t_retry")
    SQ._setup_table(spark, SF, root)
    junk = spark.createDataFrame([(999999, "junk", 0.0, None)],
                                 "o_orderkey bigint, o_orderstatus string, o_totalprice double, "
                                 "__deleted_at timestamp_ntz")
    junk.write.parquet(f"{root}/{ORDERS_TABLE}/base/__base_epoch=20")   # leftover, unpublished
    assert manifest.entry(spark, root, ORDERS_TABLE)["base_epoch"] == 0
    res = compaction.compact_table(spark, root, ORDERS_TABLE, COMPACTED_AT)
    df, e = storage.read_base(spark, root, ORDERS_TABLE, storage.base_schema(SQ.ORDERS_DATA))
    assert e == 20 and df.filter("o_orderkey = 999999").count() == 0
    assert df.count() == res["rows"]


def test_touched_buckets_only(spark):
    """Bucket directories: a compaction rewrites just the buckets its deltas
    touch; the others keep their epoch and files; reads see every bucket."""
    from tidemark.plans.feeds import orders_base
    root = fresh_dir(spark, "t_touch")
    n = 32
    rows, written = storage.write_base_buckets(orders_base(spark, SF), root, ORDERS_TABLE, 0,
                                               n, ORDERS_PK)
    vec = [0 if b in written else None for b in range(n)]
    few = spark.createDataFrame(
        [(5, "U", "x", 1.0, 1, 1, None, None), (7, "D", None, None, 2, 1, None, None),
         (999999, "I", "n", 2.0, 3, 2, None, None)],
        "o_orderkey bigint, __op string, o_orderstatus string, o_totalprice double, "
        "__seq bigint, __epoch bigint, __lsn string, __ts timestamp_ntz")
    storage.write_delta(few, root, ORDERS_TABLE)
    manifest.publish(spark, root, manifest.entries(spark, [
        (ORDERS_TABLE, "active", [], ORDERS_PK, 1, SQ.ORDERS_COLUMNS, 0, 2, rows, "", "", None,
         vec)]))
    touched = {r[0] for r in few.select(storage.bucket_of(ORDERS_PK, n)).distinct().collect()}
    res = compaction.compact_table(spark, root, ORDERS_TABLE, COMPACTED_AT)
    assert res["buckets_rewritten"] == len(touched) <= 3 and res["rows"] == rows + 1
    e = manifest.entry(spark, root, ORDERS_TABLE)
    assert {b for b, v in enumerate(e["bucket_epochs"]) if v == 2} == touched
    assert all(v == 0 for b, v in enumerate(e["bucket_epochs"]) if b not in touched)
    cur = as_of(spark, root, ORDERS_TABLE, 2, COMPACTED_AT)
    got = {r["o_orderkey"]: (r["o_orderstatus"], r["__deleted_at"]) for r in
           cur.filter("o_orderkey IN (5, 7, 999999)").collect()}
    assert got[5] == ("x", None) and got[7][1] is not None and got[999999] == ("n", None)
    assert cur.count() == rows + 1
    # a purge considers every bucket
    change = spark.createDataFrame([(ORDERS_TABLE, 3)], "table string, latest_delta_epoch bigint")
    manifest.update_tables(spark, root, change)
    res = compaction.compact_table(spark, root, ORDERS_TABLE, COMPACTED_AT,
                                   now="2024-04-01 00:00:00", retention_days=30)
    assert res["buckets_rewritten"] == n and res["purged"] == 1 and res["rows"] == rows
    from tidemark.plans.registration import register_all
    assert register_all(spark, root, "t_touch_db")[0]["status"].startswith("skipped")


def test_bucket_write_is_one_file_per_bucket(spark):
    import os
    root = fresh_dir(spark, "t_files")
    SQ._setup_table(spark, SF, root, bucket_dirs=8)
    res = compaction.compact_table(spark, root, ORDERS_TABLE, COMPACTED_AT)
    assert res["buckets_rewritten"] == 8
    base = f"{root}/{ORDERS_TABLE}/base/__base_epoch=20".replace("file:", "")
    for b in os.listdir(base):
        if b.startswith("__bucket="):
            files = [f for f in os.listdir(f"{base}/{b}") if f.endswith(".parquet")]
            assert len(files) == 1, (b, files)


def test_bucket_retry_drops_stale_buckets(spark):
    """A failed attempt wrote a bucket that the retry leaves empty: the retry
    must not keep it (static overwrite of the epoch directory)."""
    root = fresh_dir(spark, "t_stale")
    SQ._setup_table(spark, SF, root, bucket_dirs=8)
    junk = spark.createDataFrame([(1, "junk", 0.0, None)],
                                 "o_orderkey bigint, o_orderstatus string, o_totalprice double, "
                                 "__deleted_at timestamp_ntz")
    junk.write.parquet(f"{root}/{ORDERS_TABLE}/base/__base_epoch=20/__bucket=99")
    compaction.compact_table(spark, root, ORDERS_TABLE, COMPACTED_AT)
    assert 99 not in storage.base_epochs(spark, root, ORDERS_TABLE) and not any(
        d == "__bucket=99" for d in __import__("tidemark.sources.fs", fromlist=["x"])
        .list_dirs(spark, f"{root}/{ORDERS_TABLE}/base/__base_epoch=20"))
