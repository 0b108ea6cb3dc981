"""Deliveries that come again, and snapshots taken while changes run."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions.types import struct_for
from tidemark.operators.events import EVENT_SCHEMA, after_snapshot
from tidemark.operators.merge import live
from tidemark.plans import compaction, consumer, handover
from tidemark.plans.snapshot_init import init_tables
from tidemark.session import fresh_dir
from tidemark.sources import log, manifest, positions, storage
from tidemark.streaming.epochs import EpochWriter, change_stream, stream_to_epochs
from tidemark.streaming.published import drain_changes

STAMP = "2024-02-01 00:00:00"
COLUMNS = [{"name": "id", "pg_type": "bigint", "nullable": False}, {"name": "v", "pg_type": "text", "nullable": True}]


def lsn(n):
    return f"0/{n:X}"


def event(seq, op, key, v=None, table="t"):
    row = {"id": str(key)} | ({} if op == "D" else {"v": v})
    return (table, op, row, lsn(seq), None, seq, None, None)


def loaded(spark, name, rows=((1, "x"),), tables=("t",), **kw):
    root = fresh_dir(spark, name)
    path = f"{root}/_source"
    spark.createDataFrame(list(rows), "id bigint, v string").write.parquet(path)
    init_tables(spark, root, {t: {"columns": COLUMNS, "primary_key": ["id"], "path": path} | kw.get("spec", {}) for t in tables},
                **{k: v for k, v in kw.items() if k != "spec"})
    return root


def deliver(spark, root, events, stream="a"):
    spark.createDataFrame(events, EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/_landing-{stream}")
    ckpt = f"{root}/_checkpoint-{stream}"
    q = stream_to_epochs(change_stream(spark, f"{root}/_landing-{stream}"), EpochWriter.from_manifest(spark, root, checkpoint=ckpt), ckpt)
    q.awaitTermination()
    assert q.exception() is None


def state(spark, root, table="t"):
    e = manifest.entry(spark, root, table)
    return {r["id"]: r["v"] for r in live(consumer.as_of(spark, root, table, e["latest_delta_epoch"], STAMP)).collect()}


def ledger(spark, root):
    return {(r["epoch"], r["table"]): (r["landed"], r["written"], r["replayed"], r["in_snapshot"])
            for r in positions.delivery_ledger(spark, root).collect()}


def test_an_old_event_that_comes_again_does_not_win(spark):
    root = loaded(spark, "again")
    old, new = event(10, "U", 1, "a"), event(20, "U", 1, "b")
    deliver(spark, root, [old, new, old])
    deliver(spark, root, [old])
    assert state(spark, root) == {1: "b"}
    assert ledger(spark, root) == {(1, "t"): (2, 2, 0, 0), (2, "t"): (1, 0, 1, 0)}
    # nor once its deltas are compacted away, nor through another stream
    compaction.compact_table(spark, root, "t", STAMP)
    deliver(spark, root, [new, old, event(30, "I", 2, "c")], stream="b")
    assert state(spark, root) == {1: "b", 2: "c"}
    assert ledger(spark, root)[3, "t"] == (3, 1, 2, 0)


def test_late_events_that_never_came_are_written(spark):
    """Sources of several partitions: a lower place in another table or key is no replay."""
    root = loaded(spark, "late", tables=("t", "u"))
    deliver(spark, root, [event(100, "I", 7, "late")])
    deliver(spark, root, [event(50, "I", 8, "new"), event(50, "I", 9, "same place"), event(60, "I", 8, "u", "u"),
                          event(100, "I", 7, "late"), event(100, "I", 17, "other row")])
    assert state(spark, root) == {1: "x", 7: "late", 8: "new", 9: "same place", 17: "other row"}
    assert state(spark, root, "u") == {1: "x", 8: "u"}
    assert ledger(spark, root)[2, "t"] == (4, 3, 1, 0)


def test_forgotten_epochs(spark):
    root = loaded(spark, "forgotten")
    deliver(spark, root, [event(10, "U", 1, "a")])
    deliver(spark, root, [event(20, "U", 1, "b")])
    assert positions.drop_positions(spark, root, 1) == [1]
    deliver(spark, root, [event(20, "U", 1, "b")])
    assert ledger(spark, root)[3, "t"] == (1, 0, 1, 0)


def test_events_without_a_place_are_rejects_each(spark):
    root = loaded(spark, "no place")
    lost = ("t", "U", {"id": "1", "v": "z"}, "nowhere", None, None, None, None)
    deliver(spark, root, [lost, lost, event(5, "U", 1, "ok")])
    assert storage.read_rejects(spark, root, "t").count() == 2 and state(spark, root) == {1: "ok"}


@pytest.mark.parametrize(("key_type", "bounds", "keys"), [
    ("bigint", [-5, 10, 11, 400], [None, -6, -5, 9, 10, 11, 399, 400, 10 ** 12]),
    ("text", ["b", "ba", "é"], ["", "a", "b", "b ", "ba", "bz", "é", "z"]),
    ("date", [date(2024, 1, 2), date(2024, 3, 1)], [date(2024, 1, 1), date(2024, 1, 2), date(2024, 2, 29), date(2025, 1, 1)])])
def test_after_snapshot_by_ranges(spark, key_type, bounds, keys):
    starts = [None, *bounds]
    chunks = [{"from_key": handover.key_text(s), "low": lsn(10 * i + 3), "high": lsn(99)} for i, s in enumerate(starts)]
    spark_type = struct_for([{"name": "k", "pg_type": key_type}])["k"].dataType
    rows = [(k, p) for k in keys for p in (None, 0, 3, 4, 13, 14, 23, 24, 33, 34, 43, 44)]
    schema = struct_for([{"name": "k", "pg_type": key_type}, {"name": "p", "pg_type": "bigint"}])
    got = spark.createDataFrame(rows, schema).withColumn("due", after_snapshot(chunks, F.col("k"), spark_type, F.col("p"))).collect()
    for r in got:
        i = sum(1 for b in bounds if r["k"] is not None and r["k"] >= b)
        assert r["due"] == (r["p"] is None or r["k"] is None and r["p"] > 10 * len(bounds) + 3
                            or r["k"] is not None and r["p"] > 10 * i + 3), r


def test_a_snapshot_in_ranges_goes_on_where_it_failed(spark):
    clock, asked = iter(range(100, 200)), []
    rows = [(i, f"v{i}") for i in range(30)]

    def read(lo, hi):
        asked.append((lo, hi))
        if len(asked) == 2:
            raise RuntimeError("source gone")
        return spark.createDataFrame([r for r in rows if (lo is None or r[0] >= lo) and (hi is None or r[0] < hi)], "id bigint, v string")

    root, spec = fresh_dir(spark, "ranges"), {"columns": COLUMNS, "primary_key": ["id"], "ranges": [10, 20], "read": read}
    with pytest.raises(RuntimeError):
        init_tables(spark, root, {"t": spec}, position=lambda: lsn(next(clock)))
    init_tables(spark, root, {"t": spec}, position=lambda: lsn(next(clock)))
    assert asked == [(None, 10), (10, 20), (10, 20), (20, None)]
    e = manifest.entry(spark, root, "t")
    assert [(c["from_key"], c["low"], c["high"]) for c in e["snapshot"]] == [
        (None, lsn(100), lsn(101)), ("10", lsn(103), lsn(104)), ("20", lsn(105), lsn(106))]
    assert e["row_count"] == 30 and state(spark, root) == dict(rows)
    assert handover.start_position(manifest.read_tables(spark, root)).first()[0] == lsn(100)
    # at its own low position a change is held, in the window it replaces the row
    deliver(spark, root, [event(100, "U", 5, "old"), event(101, "U", 5, "window"), event(103, "D", 15), event(104, "D", 16),
                          event(105, "U", 25, "old"), event(110, "D", 29)])
    got = state(spark, root)
    assert got[5] == "window" and got[15] == "v15" and 16 not in got and got[25] == "v25" and 29 not in got
    assert ledger(spark, root)[1, "t"] == (6, 3, 0, 3)


def test_a_whole_snapshot_has_one_range(spark):
    root = loaded(spark, "whole", position=iter([lsn(50), lsn(60)]).__next__)
    deliver(spark, root, [event(49, "U", 1, "old"), event(50, "D", 1), event(55, "U", 1, "newer")])
    assert state(spark, root) == {1: "newer"} and ledger(spark, root)[1, "t"][3] == 2
    assert datetime(2024, 1, 1).isoformat(sep=" ") == handover.key_text(datetime(2024, 1, 1))


def test_a_consumer_passed_by_a_compaction_has_to_resync(spark):
    root, got = loaded(spark, "consumer"), []

    def take(changes, number):
        got.append(sorted((r["__epoch"], r["__op"], r["id"]) for r in changes.collect()))

    def drain(checkpoint="c", **kw):
        drain_changes(spark, root, "t", take, f"{root}/_{checkpoint}", **kw)
    drain()
    assert not got
    deliver(spark, root, [event(10, "U", 1, "a")])
    drain()
    drain()
    assert got == [[(1, "U", 1)]]
    deliver(spark, root, [event(20, "U", 1, "b"), event(21, "I", 2, "c")])
    compaction.compact_table(spark, root, "t", STAMP)
    deliver(spark, root, [event(30, "D", 2)])
    with pytest.raises(consumer.ResyncRequired):
        drain()
    # it takes the state and goes on after its epoch
    assert state(spark, root) == {1: "b"}
    drain("c2", after=2)
    assert got[1:] == [[(3, "D", 2)]]


def test_an_open_epoch_holds_later_ones_back(spark):
    root = loaded(spark, "frontier")
    deliver(spark, root, [event(10, "U", 1, "a")])
    assert manifest.read_header(spark, root)["published_epoch"] == 1
    slow = manifest.allocate_epoch(spark, root, "slow", 0)
    deliver(spark, root, [event(20, "U", 1, "b")], stream="fast")
    assert slow == 2 and manifest.read_header(spark, root)["published_epoch"] == 1
    got = []
    drain_changes(spark, root, "t", lambda df, i: got.append([r["v"] for r in df.collect()]), f"{root}/_c")
    assert got == [["a"]]
    manifest.finish_epoch(spark, root, "slow", slow)
    drain_changes(spark, root, "t", lambda df, i: got.append([r["v"] for r in df.collect()]), f"{root}/_c")
    assert got == [["a"], ["b"]]


def segments(spark, root, parts, rows=5):
    for i, seqs in enumerate(parts):
        spark.createDataFrame([event(s, "I", s, "v") for s in seqs], EVENT_SCHEMA).coalesce(1) \
            .write.option("parquet.block.row.count.limit", rows).parquet(f"{root}/_log/{i:03}")


def test_log_batches_end_at_the_cap_or_the_interval(spark, monkeypatch):
    root = fresh_dir(spark, "log")
    segments(spark, root, [range(10), [10, 11, 11, 11, 12], [14, 13, 15], range(20, 40)])
    now = [0.0]
    monkeypatch.setattr(log.time, "monotonic", lambda: now[0])
    r = log.LogReader({"path": f"{root}/_log", "rows": "6", "interval": "10", "start": "3"})
    assert r.initialOffset() == {"position": 3}
    ends = [r.latestOffset()["position"] for _ in range(7)]
    # events that share the last place come along; the tail waits
    assert ends == [9, 13, 23, 29, 35, 35, 35]
    tail = log.LogReader({"path": f"{root}/_log", "rows": "1000", "interval": "10"})
    assert tail.latestOffset()["position"] == -1
    now[0] = 9.0
    assert tail.latestOffset()["position"] == -1
    now[0] = 10.0
    assert tail.latestOffset()["position"] == 39
    got = [x for p in tail.partitions({"position": 9}, {"position": 21}) for b in tail.read(p) for x in b.column("seq").to_pylist()]
    assert sorted(got) == [10, 11, 11, 11, 12, 13, 14, 15, 20, 21]
    with pytest.raises(RuntimeError):
        tail.partitions({"position": 9}, {"position": 8})
    assert log.LogReader({"path": f"{root}/_nothing"}).latestOffset() == {"position": -1}


def test_log_goes_on_within_a_segment(spark):
    root = loaded(spark, "log stream")
    segments(spark, root, [range(100, 130), range(130, 135)], rows=8)
    ckpt = f"{root}/_checkpoint"

    def run(**kw):
        source = log.log_stream(spark, f"{root}/_log", ckpt, rows=12, interval=0, **kw)
        stream_to_epochs(source, EpochWriter.from_manifest(spark, root, checkpoint=ckpt), ckpt).awaitTermination()
    run(start=109)
    assert log.last_position(spark, ckpt) == 121
    run()
    segments_before = log.last_position(spark, ckpt)
    run()
    run()
    assert segments_before == 133 and log.last_position(spark, ckpt) == 134
    assert {(r["epoch"], r["landed"], r["first_seq"], r["last_seq"]) for r in positions.delivery_ledger(spark, root).collect()} == {
        (1, 12, 110, 121), (2, 12, 122, 133), (3, 1, 134, 134)}
    assert state(spark, root) == {1: "x"} | {s: "v" for s in range(110, 135)}


def test_rejects_of_values_and_order_in_one_read(spark):
    from tidemark.operators.events import decode_rejects, order_rejects
    rows = [("t", "U", {"id": k, "n": v}, lsn(1), None, s, None, None)
            for k, v, s in (("1", "2", 5), ("bad", "2", 6), ("1", "bad", None), ("2", "3", None), (None, "worse", 7))]
    rows.append(("t", "U", {"n": "4"}, "nowhere", None, None, None, None))
    events = spark.createDataFrame(rows, EVENT_SCHEMA)
    columns = [COLUMNS[0], {"name": "n", "pg_type": "integer", "nullable": True}]
    both = decode_rejects(events, columns, ["id"], order=True)
    parts = decode_rejects(events, columns, ["id"]).unionByName(order_rejects(events))
    assert sorted(map(str, both.collect())) == sorted(map(str, parts.collect())) and both.count() == 8
    assert "Union" not in both._jdf.queryExecution().optimizedPlan().toString()


def test_the_feed_is_spread_before_its_texts_are_made(spark, tmp_path):
    from tidemark.plans.feeds import text_feed
    spark.createDataFrame([(i, datetime(2024, 1, 1), 7, "view", 1.5, "{}") for i in range(50)],
                          "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string") \
        .coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    feed = text_feed(spark, str(tmp_path))
    assert "Repartition" in feed._jdf.queryExecution().optimizedPlan().toString() and feed.count() == 50


def test_a_range_of_a_snapshot_merges_only_its_own_keys(spark, monkeypatch):
    from tidemark.plans import stream_queries
    met, whole = [], stream_queries.merge

    def merge(base, changes, *args, **kw):
        met.append([(r[0], r[1]) for x in (base, changes) for r in x.agg(F.min("o_orderkey"), F.max("o_orderkey")).collect()])
        return whole(base, changes, *args, **kw)
    monkeypatch.setattr(stream_queries, "merge", merge)
    stream_queries._snapshot_while_streaming(spark, "/root/testdata/sf0.001", "ranges apart")
    tops = [max(hi for _, hi in x if hi is not None) for x in met]
    lows = [min(lo for lo, _ in x if lo is not None) for x in met]
    assert len(met) == stream_queries.RANGES and all(a < b for a, b in zip(tops, lows[1:], strict=False))
