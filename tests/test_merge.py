"""Merge rule against a sequential fold written in plain Python."""

from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import merge as M

STAMP = "2024-02-01 00:00:00"
STAMP_DT = datetime(2024, 2, 1)
OLD = datetime(2023, 1, 1)


def seq_fold(base, events):
    """The reference behaviour: ordered map updates per key."""
    state = {k: dict(v) for k, v in base.items()}
    for k, op, v, _e, _s in sorted(events, key=lambda x: (x[3], x[4])):
        if op in ("I", "U"):
            state[k] = {"v": v, "__deleted_at": None}
        elif op == "D" and k in state:
            state[k]["__deleted_at"] = STAMP_DT
    return {k: (s["v"], s["__deleted_at"]) for k, s in state.items()}


def run(spark, base, events, strategy):
    b = spark.createDataFrame([(k, v["v"], v["__deleted_at"]) for k, v in base.items()],
                              "k bigint, v string, __deleted_at timestamp_ntz")
    d = spark.createDataFrame(events, "k bigint, __op string, v string, __epoch bigint, __seq bigint")
    out = M.merge(b, d, ["k"], STAMP, strategy=strategy).collect()
    return {r["k"]: (r["v"], r["__deleted_at"]) for r in out}


# Fold cases: per key I; U; D; I,D; D,I; U,D,D; D on absent; tombstoned base
# then U; tombstoned base then D; unknown op last.
CASES_BASE = {1: {"v": "b1", "__deleted_at": None}, 2: {"v": "b2", "__deleted_at": None},
              3: {"v": "b3", "__deleted_at": None}, 6: {"v": "b6", "__deleted_at": None},
              8: {"v": "b8", "__deleted_at": OLD}, 9: {"v": "b9", "__deleted_at": OLD},
              10: {"v": "b10", "__deleted_at": None}, 11: {"v": "b11", "__deleted_at": None}}
CASES_EVENTS = [
    (0, "I", "i0", 1, 1),                                   # insert new key
    (1, "U", "u1", 1, 2),                                   # update
    (2, "D", None, 1, 3),                                   # delete present
    (3, "I", "i3", 1, 4), (3, "D", None, 2, 1),             # I then D: image kept
    (4, "D", None, 1, 5), (4, "I", "i4", 2, 2),             # D on absent, then I
    (5, "D", None, 1, 6),                                   # D on absent only
    (6, "U", "u6", 1, 7), (6, "D", None, 1, 8), (6, "D", None, 2, 3),
    (8, "U", "u8", 3, 1),                                   # tombstoned base then U
    (9, "D", None, 3, 2),                                   # tombstoned base then D
    (10, "U", "u10", 1, 9), (10, "X", "junk", 4, 1),        # unknown op last
    (11, "D", None, 1, 10), (11, "U", "u11", 1, 11),        # D then U same epoch
]


@pytest.mark.parametrize("strategy", ["full", "broadcast"])
def test_fold_cases(spark, strategy):
    got = run(spark, CASES_BASE, CASES_EVENTS, strategy)
    assert got == seq_fold(CASES_BASE, CASES_EVENTS)
    assert got[3] == ("i3", STAMP_DT)      # a trailing D keeps the batch's image
    assert 5 not in got                     # ignored delete
    assert got[8] == ("u8", None)           # an update clears the tombstone


def test_last_event_is_not_enough(spark):
    """Taking the single last event and falling back to the base is wrong."""
    base = {1: {"v": "base", "__deleted_at": None}}
    ev = [(1, "U", "new", 1, 1), (1, "D", None, 1, 2)]
    assert run(spark, base, ev, "full")[1] == ("new", STAMP_DT)


events_st = st.lists(st.tuples(st.integers(0, 6), st.sampled_from(["I", "U", "D", "Q"]),
                               st.text("ab", max_size=2), st.integers(1, 3),
                               st.integers(0, 10_000)),
                     max_size=25, unique_by=lambda x: (x[3], x[4]))
base_st = st.dictionaries(st.integers(0, 6),
                          st.fixed_dictionaries({"v": st.text("xy", max_size=2),
                                                 "__deleted_at": st.sampled_from([None, OLD])}),
                          max_size=5)


@settings(max_examples=25, deadline=None)
@given(base=base_st, events=events_st)
def test_fold_property(spark, base, events):
    want = seq_fold(base, events)
    assert run(spark, base, events, "full") == want
    assert run(spark, base, events, "broadcast") == want


def test_null_and_two_column_keys(spark):
    base = spark.createDataFrame([("a|", "b", "x"), ("a", "|b", "y"), (None, "n", "z")],
                                 "k1 string, k2 string, v string")
    d = spark.createDataFrame([("a|", "b", "U", "x2", 1, 1), (None, "n", "D", None, 1, 2),
                               ("a", None, "I", "new", 1, 3)],
                              "k1 string, k2 string, __op string, v string, __epoch bigint, __seq bigint")
    for strategy in ("full", "broadcast"):
        out = {(r.k1, r.k2): (r.v, r["__deleted_at"])
               for r in M.merge(base, d, ["k1", "k2"], STAMP, strategy=strategy).collect()}
        assert out[("a|", "b")] == ("x2", None)
        assert out[("a", "|b")] == ("y", None)          # no separator collision
        assert out[(None, "n")] == ("z", STAMP_DT)      # NULL key part matches
        assert out[("a", None)] == ("new", None)
        assert len(out) == 4


def test_purge_edges(spark):
    now = "2024-03-01 00:00:00"   # 2024 is a leap year: 30 days back is Jan 31
    df = spark.createDataFrame(
        [(1, None), (2, datetime(2024, 1, 31)), (3, datetime(2024, 1, 30, 23, 59, 59))],
        "k bigint, __deleted_at timestamp_ntz")
    kept = sorted(r["k"] for r in M.purge(df, now, 30).collect())
    assert kept == [1, 2]      # exactly 30 days is kept, 30 days + 1 s is purged


def test_auto_strategy_plans(spark):
    base = spark.range(100).select(F.col("id").alias("k"), F.lit("v").alias("v"))
    d = spark.createDataFrame([(1, "U", "w", 1, 1)],
                              "k bigint, __op string, v string, __epoch bigint, __seq bigint")
    plan = M.merge(base, d, ["k"], STAMP, strategy="auto")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    plan_full = M.merge(base, d, ["k"], STAMP, strategy="auto", broadcast_rows=0) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" in plan_full


def test_partial_images_keep_known_values(spark):
    base = spark.createDataFrame([(1, "a", 10.0)], "k bigint, s string, p double")
    d = spark.createDataFrame(
        [(1, "U", "b", None, ["p"], 1, 1),      # price not sent: keep 10.0
         (2, "I", "n", 5.0, [], 1, 2),
         (2, "U", "m", None, ["p"], 1, 3)],     # keep 5.0 from the insert
        "k bigint, __op string, s string, p double, __unchanged array<string>, "
        "__epoch bigint, __seq bigint")
    for strategy in ("full", "broadcast"):
        got = {r["k"]: (r["s"], r["p"]) for r in
               M.merge(base, d, ["k"], STAMP, strategy=strategy, partial=True).collect()}
        assert got == {1: ("b", 10.0), 2: ("m", 5.0)}
    plain = {r["k"]: r["p"] for r in M.merge(base, d, ["k"], STAMP).collect()}
    assert plain == {1: None, 2: None}          # the source writer's behaviour


def test_key_change_splits(spark):
    from tidemark.operators.events import decode_events, split_key_changes
    ev = spark.createDataFrame(
        [("t", "U", {"id": "2", "v": "x"}, {"id": "1"}, 5),
         ("t", "U", {"id": "3", "v": "y"}, None, 6),
         ("t", "U", {"id": "4", "v": "z"}, {"id": "4"}, 7)],
        "table string, op string, row map<string,string>, old_row map<string,string>, seq bigint")
    out = decode_events(split_key_changes(ev, ["id"]).withColumn("lsn", F.lit(None).cast("string"))
                        .withColumn("ts", F.lit(None).cast("timestamp_ntz")),
                        [{"name": "id", "pg_type": "bigint"}, {"name": "v", "pg_type": "text"}])
    got = sorted((r["__op"], r["id"], r["v"]) for r in out.collect())
    assert got == [("D", 1, None), ("U", 2, "x"), ("U", 3, "y"), ("U", 4, "z")]


@pytest.mark.parametrize("strategy", ["full", "broadcast", "auto"])
def test_edge_inputs(spark, strategy):
    schema = "k bigint, __op string, v string, __epoch bigint, __seq bigint"
    base = spark.createDataFrame([(1, "a")], "k bigint, v string")
    empty_d = spark.createDataFrame([], schema)
    out = M.merge(base, empty_d, ["k"], STAMP, strategy=strategy).collect()
    assert [(r["k"], r["v"], r["__deleted_at"]) for r in out] == [(1, "a", None)]
    only_unknown = spark.createDataFrame([(1, "T", None, 1, 1), (2, "X", "z", 1, 2)], schema)
    out = M.merge(base, only_unknown, ["k"], STAMP, strategy=strategy).collect()
    assert [(r["k"], r["v"]) for r in out] == [(1, "a")]
    empty_b = spark.createDataFrame([], "k bigint, v string")
    d = spark.createDataFrame([(5, "I", "n", 1, 1), (6, "D", None, 1, 2)], schema)
    out = M.merge(empty_b, d, ["k"], STAMP, strategy=strategy).collect()
    assert [(r["k"], r["v"]) for r in out] == [(5, "n")]


def test_history_slices_stitch_exactly(spark):
    """One hot key, one epoch, many sequence ranges: versions and valid_to
    match a plain window computed in Python."""
    from tidemark.operators.reads import history
    rows = [(1, "U", "v", 1 if i < 60 else 2, i * 7) for i in range(100)] + \
           [(2, "I", "w", 1, 3)]
    d = spark.createDataFrame(rows, "k bigint, __op string, v string, __epoch bigint, __seq bigint")
    got = {(r["k"], r["__seq"]): (r["version"], r["valid_to"])
           for r in history(d, ["k"], slice_width=50).collect()}
    for k in (1, 2):
        evs = sorted((e, s) for kk, _, _, e, s in rows if kk == k)
        for i, (e, s) in enumerate(evs):
            nxt = evs[i + 1][0] if i + 1 < len(evs) else None
            assert got[(k, s)] == (i + 1, nxt), (k, s, got[(k, s)])


@settings(max_examples=15, deadline=None)
@given(base=base_st, events=events_st, cut=st.integers(0, 4))
def test_two_step_compaction_equals_one(spark, base, events, cut):
    """Compacting epochs <= cut, then the rest, equals one compaction (same
    stamp, no purge): what as-of reads after a compaction rely on."""
    b = spark.createDataFrame([(k, v["v"], v["__deleted_at"]) for k, v in base.items()],
                              "k bigint, v string, __deleted_at timestamp_ntz")
    d = spark.createDataFrame(events, "k bigint, __op string, v string, __epoch bigint, __seq bigint")
    one = M.merge(b, d, ["k"], STAMP, strategy="full")
    step = M.merge(b, d.filter(F.col("__epoch") <= cut), ["k"], STAMP, strategy="broadcast")
    two = M.merge(step, d.filter(F.col("__epoch") > cut), ["k"], STAMP, strategy="full")
    key = lambda r: (r["k"], r["v"], r["__deleted_at"])
    assert sorted(map(key, one.collect())) == sorted(map(key, two.collect()))


def test_forced_broadcast_respects_the_bound(spark):
    base = spark.createDataFrame([(1, "a")], "k bigint, v string")
    d = spark.createDataFrame([(1, "U", "b", 1, 1), (2, "I", "c", 1, 2)],
                              "k bigint, __op string, v string, __epoch bigint, __seq bigint")
    over = M.merge(base, d, ["k"], STAMP, strategy="broadcast", broadcast_rows=1)
    assert "Broadcast" not in over._jdf.queryExecution().analyzed().toString()
    assert over.count() == 2
    assert M.merge(base, d, ["k"], STAMP, strategy="auto", broadcast_rows=1).count() == 2


def test_broadcast_is_bounded_by_bytes_and_by_the_base(spark):
    base = spark.range(100).select(F.col("id").alias("k"), F.lit("v").alias("v"))
    d = spark.createDataFrame([(k, "U", "w" * 1000, 1, k) for k in range(4)],
                              "k bigint, __op string, v string, __epoch bigint, __seq bigint")
    assert M.within_bound(d, 4, 10_000) and not M.within_bound(d, 4, 4_000) and not M.within_bound(d, 3, 10_000)
    assert M.within_bound(d, 4, 10_000, of=base) and not M.within_bound(d, 7, 10_000, of=base.limit(60))
    wide = M.merge(base, d, ["k"], STAMP, strategy="broadcast", broadcast_bytes=4_000)
    assert "Broadcast" not in wide._jdf.queryExecution().analyzed().toString()
    assert wide.count() == 100
