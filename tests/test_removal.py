"""Removal beside readers, and catalog entries that are never missing."""

import threading

import pytest

from tidemark.plans import compaction, consumer, registration, removal
from tidemark.session import fresh_dir
from tidemark.sources import catalog, fs, manifest, storage
from tidemark.streaming.epochs import EpochWriter, change_stream, stream_to_epochs
from tidemark.operators.events import EVENT_SCHEMA
from tests.test_delivery import COLUMNS, STAMP, deliver, event, loaded


def epochs(spark, root):
    return storage.delta_epochs(spark, root, "t"), storage.base_epochs(spark, root, "t")


def changed(spark, root, n):
    """``n`` epochs of one change each, written as deltas and published."""
    first = int(manifest.entry(spark, root, "t")["latest_delta_epoch"] or 0) + 1
    rows = [("U", e, None, None, 1, f"v{e}", e) for e in range(first, first + n)]
    d = spark.createDataFrame(rows, "__op string, __seq bigint, __lsn string, __ts timestamp_ntz, id bigint, v string, __epoch bigint")
    storage.write_delta(d, root, "t")
    manifest.update_tables(spark, root, spark.createDataFrame([("t", first + n - 1)], "table string, latest_delta_epoch bigint"))


def test_pins_hold_what_a_plan_reads(spark):
    root = loaded(spark, "pins")
    changed(spark, root, 3)
    with removal.reading(spark, root, "t") as old:
        planned = old.as_of(2, STAMP, strategy="full")
        compaction.compact_table(spark, root, "t", STAMP, keep_bases=1)
        changed(spark, root, 2)
        with removal.reading(spark, root, "t") as newer:
            compaction.compact_table(spark, root, "t", STAMP, keep_bases=1)
            assert epochs(spark, root) == ([1, 2, 3, 4, 5], [0, 3, 5])
            assert {r["v"] for r in newer.changes_since(3).collect()} == {"v4", "v5"}
        assert [r["v"] for r in planned.collect()] == ["v2"]
        # the newer pin is gone, the older still needs everything above base 0
        assert removal.sweep(spark, root, "t") == {"deltas": [], "bases": [3]}
        old.renew()
        assert removal.pinned(spark, root, "t") == [0]
    assert removal.sweep(spark, root, "t") == {"deltas": [1, 2, 3, 4, 5], "bases": [0]}
    assert epochs(spark, root) == ([], [5]) and consumer.published_bases(manifest.entry(spark, root, "t")) == [5]
    assert not fs.list_files(spark, f"{root}/t/_retired")
    with pytest.raises(KeyError), removal.reading(spark, root, "nothing"):
        pass


def test_grace_and_leases_run_out(spark):
    root = loaded(spark, "grace")
    changed(spark, root, 2)
    compaction.compact_table(spark, root, "t", STAMP, grace_s=3600.0)
    assert epochs(spark, root) == ([1, 2], [0, 2])
    assert removal.sweep(spark, root, "t", 3600.0)["deltas"] == []
    reader = removal.reading(spark, root, "t", lease_s=-1.0)
    reader.__enter__()  # a reader that died
    assert removal.pinned(spark, root, "t") == []
    assert removal.sweep(spark, root, "t", 3600.0, now=removal.time.time() + 3601)["deltas"] == [1, 2]


def test_a_registered_table_is_never_missing(spark):
    root, db, seen, stop = fresh_dir(spark, "in place"), "tidemark_in_place", [], threading.Event()
    cols = [{"name": "id", "pg_type": "bigint"}, {"name": "v", "pg_type": "text"}]
    more = [*cols, {"name": "w", "pg_type": "integer"}]
    spark.createDataFrame([(1, "a")], "id bigint, v string").write.parquet(f"{root}/0")
    spark.createDataFrame([(1, "a", 5)], "id bigint, v string, w int").write.parquet(f"{root}/1")
    catalog.register_table(spark, db, "t", cols, f"{root}/0", {"cdc.base_epoch": "0"})

    def look():
        other = spark.newSession()
        while not stop.is_set():
            seen.append(other.catalog.tableExists(f"{db}.t"))
    watcher = threading.Thread(target=look)
    watcher.start()
    try:
        for i in range(6):
            catalog.register_table(spark, db, "t", more, f"{root}/{(i + 1) % 2}", {"cdc.base_epoch": str(i), "note": "it's"})
    finally:
        stop.set()
        watcher.join()
    assert seen and all(seen)
    rows = spark.table(f"{db}.t").collect()
    assert [(r["id"], r["v"], r["w"]) for r in rows] == [(1, "a", None)]
    props = {r[0]: r[1] for r in spark.sql(f"SHOW TBLPROPERTIES {db}.t").collect()}
    assert props["cdc.base_epoch"] == "5" and props["note"] == "it's"
    # another type needs another declaration
    catalog.register_table(spark, db, "t", [{"name": "id", "pg_type": "text"}], f"{root}/0", {"a": "b"})
    assert dict(spark.table(f"{db}.t").dtypes) == {"id": "string"}


def test_views_follow_the_stream(spark):
    root, db = loaded(spark, "views"), "tidemark_views"
    registration.publish_live_view(spark, root, "t", db)
    spark.createDataFrame([event(10, "U", 1, "a"), event(11, "I", 2, "b"), event(12, "D", 9)], EVENT_SCHEMA).write.parquet(f"{root}/_landing")
    w = EpochWriter.from_manifest(spark, root, checkpoint=f"{root}/_c", published=lambda s, tables: [
        registration.publish_live_view(s, root, t, db) for t in tables])
    stream_to_epochs(change_stream(spark, f"{root}/_landing"), w, f"{root}/_c").awaitTermination()
    other = spark.newSession()
    assert {(r["id"], r["v"]) for r in other.table(f"{db}.t_live").collect()} == {(1, "a"), (2, "b")}
    deliver(spark, root, [event(20, "D", 1)])
    registration.publish_live_view(spark, root, "t", db)
    assert {(r["id"], r["v"]) for r in other.table(f"{db}.t_live").collect()} == {(2, "b")}
    with pytest.raises(KeyError):
        registration.publish_live_view(spark, root, "none", db)
    assert COLUMNS[0]["name"] == "id"
