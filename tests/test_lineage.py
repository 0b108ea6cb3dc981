"""Moves of a row's key that don't send every column."""

from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions.types import struct_for
from tidemark.operators import lineage
from tidemark.operators import merge as M
from tidemark.plans import consumer
from tidemark.session import checkpoint, fresh_dir
from tidemark.sources import manifest, storage

STAMP = "2024-02-01 00:00:00"
STAMP_DT = datetime(2024, 1, 1)
SCHEMA = ("k bigint, __op string, s string, p double, __unchanged array<string>, __moved_from struct<k:bigint>, "
          "__epoch bigint, __seq bigint")
BASE = "k bigint, s string, p double, __deleted_at timestamp_ntz"


def move(seq, old, new, s=None, p=None, epoch=1):
    """D(old) and U(new); what is None was not sent."""
    unsent = [c for c, v in (("s", s), ("p", p)) if v is None]
    return [(old, "D", None, None, unsent, None, epoch, seq), (new, "U", s, p, unsent, (old,), epoch, seq)]


def put(seq, k, s, p, op="U", epoch=1):
    return [(k, op, s, p, [], None, epoch, seq)]


def merged(spark, base, events, strategy="full"):
    b, d = spark.createDataFrame(base, BASE), spark.createDataFrame(events, SCHEMA)
    return {r["k"]: (r["s"], r["p"], r["__deleted_at"] is not None)
            for r in M.merge(b, d, ["k"], STAMP, strategy=strategy, partial=True).collect()}


@pytest.mark.parametrize("strategy", ["full", "broadcast"])
def test_values_follow_moves(spark, strategy):
    base = [(1, "a", 1.0, None), (5, "e", 5.0, None), (9, "dead", 9.0, STAMP_DT)]
    # three moves in a row, each sending the status only
    got = merged(spark, base, move(1, 1, 2, s="x") + move(2, 2, 3, s="y") + move(3, 3, 4, s="z"), strategy)
    assert got[4] == ("z", 1.0, False) and got[1][2]
    # there and back: what was sent on the way is kept, what was not is the base's
    got = merged(spark, base, move(1, 1, 2, p=7.0) + move(2, 2, 1), strategy)
    assert got[1] == ("a", 7.0, False) and got[2][2]
    # onto a deleted row: its old image doesn't shine through
    got = merged(spark, base, move(1, 5, 9), strategy)
    assert got[9] == ("e", 5.0, False) and got[5][2]
    # the value of just before the move, not a later one under the old key
    got = merged(spark, base, put(1, 1, "b", 2.0) + move(2, 1, 2) + put(3, 1, "c", 3.0, "I", epoch=2), strategy)
    assert got[2] == ("b", 2.0, False) and got[1] == ("c", 3.0, False)
    # from a key that never was
    assert merged(spark, base, move(1, 77, 78), strategy)[78] == (None, None, False)


def test_rounds_grow_with_the_logarithm_of_a_chain(spark, monkeypatch):
    events = [e for i in range(64) for e in move(i + 1, i, i + 1, epoch=1 + i // 10)]
    rounds = []
    monkeypatch.setattr(lineage, "checkpoint", lambda df: rounds.append(1) or checkpoint(df))
    assert merged(spark, [(0, "first", 0.5, None)], events)[64] == ("first", 0.5, False)
    assert len(rounds) <= 1 + 7


moves_st = st.lists(st.tuples(st.sampled_from(["put", "move", "move", "move", "del", "part"]), st.integers(0, 3),
                              st.integers(0, 3), st.booleans(), st.booleans()), max_size=25)


@settings(max_examples=12, deadline=None)
@given(steps=moves_st)
def test_moves_by_sequential_fold(spark, steps):
    base = [(0, "b0", 0.0, None), (1, "b1", None, None), (2, None, 2.0, STAMP_DT)]
    state = {k: [s, p, d is not None] for k, s, p, d in base}
    events = []
    for i, (what, a, b, has_s, has_p) in enumerate(steps):
        s, p, epoch = f"s{i}" if has_s else None, float(i) if has_p else None, 1 + i // 6
        if what == "move" and a != b:
            events += move(i, a, b, s, p, epoch)
            old = state.get(a, [None, None, True])[:2]
            if a in state:
                state[a][2] = True
            state[b] = [s if has_s else old[0], p if has_p else old[1], False]
        elif what == "put":
            events += put(i, a, s, p, "I", epoch)
            state[a] = [s, p, False]
        elif what == "part":
            events.append((a, "U", s, p, [c for c, v in (("s", s), ("p", p)) if v is None], None, epoch, i))
            old = state.get(a, [None, None, True])[:2]
            state[a] = [s if has_s else old[0], p if has_p else old[1], False]
        elif what == "del":
            events.append((a, "D", None, None, [], None, epoch, i))
            if a in state:
                state[a][2] = True
    assert merged(spark, base, events) == {k: tuple(v) for k, v in state.items()}


def test_changes_of_consumers_carry_the_values(spark):
    """The old key's value may be in the base or in changes that the consumer has already."""
    root = fresh_dir(spark, "moves")
    cols = [{"name": "k", "pg_type": "bigint", "nullable": False}, {"name": "s", "pg_type": "text"},
            {"name": "p", "pg_type": "double precision"}]
    entry = [{**c, "parquet_type": "x", "nullable": True, "precision": None, "scale": None} for c in cols]
    manifest.publish(spark, root, manifest.entries(spark, [
        ("t", "active", [], ["k"], 1, entry, 0, 2, 1, f"{root}/t", "", None, None, None, True)]))
    storage.write_base(spark.createDataFrame([(1, "base", 1.0, None)], BASE), root, "t", 0)
    events = put(1, 5, "five", 5.0) + move(2, 1, 2, s="m", epoch=2) + move(3, 5, 6, p=6.0, epoch=2)
    assert struct_for(cols).names == ["k", "s", "p"]
    schema = storage.delta_schema(struct_for(cols), partial=True, pk=["k"])
    d = spark.createDataFrame(events, SCHEMA).withColumn("__lsn", F.lit(None).cast("string")) \
        .withColumn("__ts", F.lit(None).cast("timestamp_ntz")).select(schema.names)
    storage.write_delta(d, root, "t")
    raw = {(r["k"], r["__op"]): (r["s"], r["p"], r["__unchanged"])
           for r in consumer.changes_since(spark, root, "t", 1).collect()}
    assert raw[2, "U"] == ("m", 1.0, []) and raw[6, "U"] == ("five", 6.0, []) and (5, "U") not in raw
    net = {r["k"]: (r["__op"], r["s"], r["p"]) for r in consumer.changes_since(spark, root, "t", 1, net=True).collect()}
    assert net[2] == ("U", "m", 1.0) and net[6] == ("U", "five", 6.0) and net[1][0] == net[5][0] == "D"
    state = {r["k"]: r["p"] for r in M.live(consumer.as_of(spark, root, "t", 2, STAMP)).collect()}
    assert state == {2: 1.0, 6: 6.0}
