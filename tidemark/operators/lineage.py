"""Values that follow a row when its key moves.

A source that changes a row's key need not send the columns it left alone: their
values are under the old key only.  Each such column of a move points at what
defined it under the old key just before: a sent value, the row in the base, or
an earlier move that didn't send it either.  Chains of moves are followed by
pointer jumping, every pointer doubling its reach each round, with the values
carried along.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.constants import (DEFAULT_BROADCAST_BYTES, DEFAULT_BROADCAST_ROWS, EPOCH, LIVE_OPS,
                                MOVED_FROM, OP, SEQ, UNCHANGED)
from tidemark.session import checkpoint

#: Width of the sequence ranges that a key's changes of one epoch are cut into.
SLICE_WIDTH = 1 << 20


def _unsent(column: str) -> Column:
    return F.coalesce(F.array_contains(F.col(UNCHANGED), F.lit(column)), F.lit(False))


def _is_move() -> Column:
    return F.col(OP).isin(*LIVE_OPS) & F.col(MOVED_FROM).isNotNull() & (F.size(UNCHANGED) > 0)


def resolve_moves(base: DataFrame, deltas: DataFrame, pk: list[str], data_cols: list[str],
                  order: tuple[str, ...] = (EPOCH, SEQ), broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                  broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``deltas`` with the unsent columns of moves filled from the old key's lineage.

    ``deltas`` are all changes after ``base``, with ``__unchanged`` (columns not
    sent) and ``__moved_from`` (the old key as a struct, on the change under the new
    key).  A filled column leaves ``__unchanged``; changes that moved nothing stay
    as they are.  A column that the old key's row never had is NULL.  Without moves
    that lack columns this is ``deltas`` itself, after one job over two columns.

    Only changes of old keys, and base rows of lineage ends, are shuffled.  Under
    a hot key each (epoch, sequence range) is ordered for itself and handed the last
    values of the ones before it.
    """
    if UNCHANGED not in deltas.columns or MOVED_FROM not in deltas.columns:
        return deltas
    moves = deltas.where(_is_move())
    # at most one name per column of the table
    missing = {r[0] for r in moves.select(F.explode(UNCHANGED)).distinct().collect()}
    cols = [c for c in data_cols if c in missing]
    if not cols:
        return deltas
    ends = _follow(checkpoint(_pointers(deltas, moves, pk, cols, order)))
    found = _with_base_values(base, ends, pk, cols, broadcast_rows, broadcast_bytes)
    values = found.groupBy("at").agg(*[
        F.first(F.when(F.col("col") == c, F.struct(F.col(f"v_{c}").alias("v"))), ignorenulls=True).alias(f"__f_{c}")
        for c in cols])
    j = moves.withColumn("at", F.struct(*order)).join(values, "at", "left")
    filled = j.select(*[
        F.when(F.col(f"__f_{c}").isNotNull(), F.col(f"__f_{c}.v")).otherwise(F.col(c)).alias(c) if c in cols
        else F.array_except(UNCHANGED, F.array(*[F.lit(x) for x in cols])).alias(c) if c == UNCHANGED
        else F.col(c) for c in deltas.columns])
    return deltas.where(~F.coalesce(_is_move(), F.lit(False))).unionByName(filled)


def _pointers(deltas: DataFrame, moves: DataFrame, pk: list[str], cols: list[str], order) -> DataFrame:
    """``(at, col, to, key, known, v_<col>...)``: what defined ``col`` under the old key
    just before the move at ``at``: a known value, the move at ``to``, or neither
    (then it is ``key``'s row in the base)."""
    keys = [f"__k{i}" for i in range(len(pk))]
    place = F.struct(*order)
    types = dict(deltas.dtypes)
    asked = moves.select(*[F.col(f"{MOVED_FROM}.{k}").alias(n) for k, n in zip(pk, keys, strict=True)], *order,
                         F.array_intersect(UNCHANGED, F.array(*[F.lit(c) for c in cols])).alias("asks"))
    moved = F.col(MOVED_FROM).isNotNull()
    nowhere = F.lit(None).cast(moves.select(place.alias("p")).schema["p"].dataType)
    defined = [F.when(~_unsent(c), F.struct(F.col(c).alias("v"), nowhere.alias("to")))
                .when(moved, F.struct(F.lit(None).cast(types[c]).alias("v"), place.alias("to"))).alias(f"d_{c}") for c in cols]
    events = deltas.where(F.col(OP).isin(*LIVE_OPS)).select(
        *[F.col(k).alias(n) for k, n in zip(pk, keys, strict=True)], *order, *defined)
    # a move's own change is under another key, so "before" and "up to" are the same here
    rows = (events.join(asked.select(*keys).distinct(), keys, "left_semi")
            .withColumn("asks", F.lit(None).cast("array<string>"))
            .unionByName(asked, allowMissingColumns=True))
    slices = [F.col(order[0]).alias("__s0")]
    if len(order) > 1 and types.get(order[1]) in ("bigint", "int"):
        slices.append(F.floor(F.col(order[1]) / F.lit(SLICE_WIDTH)).alias("__s1"))
    cut = [f"__s{i}" for i in range(len(slices))]
    rows = rows.select("*", *slices)
    within = Window.partitionBy(*keys, *cut).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    own = rows.select(*keys, *cut, "asks", place.alias("at"), *[
        F.last(f"d_{c}", ignorenulls=True).over(within).alias(f"d_{c}") for c in cols]).where("asks IS NOT NULL")
    ends = rows.groupBy(*keys, *cut).agg(*[
        F.max_by(f"d_{c}", F.when(F.col(f"d_{c}").isNotNull(), place)).alias(f"d_{c}") for c in cols])
    before = Window.partitionBy(*keys).orderBy(*cut).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*[F.col(x).alias(f"__j{x}") for x in (*keys, *cut)], *[
        F.last(f"d_{c}", ignorenulls=True).over(before).alias(f"c_{c}") for c in cols])
    same = reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(f"__j{x}")) for x in (*keys, *cut)])
    j = own.join(carried, same, "left")
    each = [F.struct(F.lit(c).alias("col"), F.coalesce(f"d_{c}", f"c_{c}")["to"].alias("to"),
                     F.coalesce(F.coalesce(f"d_{c}", f"c_{c}")["to"].isNull()
                                & F.coalesce(f"d_{c}", f"c_{c}").isNotNull(), F.lit(False)).alias("known"),
                     *[(F.coalesce(f"d_{c}", f"c_{c}")["v"] if x == c else F.lit(None).cast(types[x])).alias(f"v_{x}")
                       for x in cols]) for c in cols]
    asks = F.filter(F.array(*each), lambda s: F.array_contains("asks", s["col"]))
    return j.select("at", F.struct(*[F.col(n).alias(k) for k, n in zip(pk, keys, strict=True)]).alias("key"),
                    F.inline(asks))


def _follow(pointers: DataFrame) -> DataFrame:
    """Pointers that point at no other move any more.  Each round doubles their reach."""
    rest = [c for c in pointers.columns if c not in ("at", "col")]
    while not pointers.where("to IS NOT NULL").isEmpty():
        further = pointers.select(F.col("at").alias("to"), "col", *[F.col(c).alias(f"n_{c}") for c in rest])
        moved = pointers.where("to IS NOT NULL").join(further, ["to", "col"]).select(
            "at", "col", *[F.col(f"n_{c}").alias(c) for c in rest])
        pointers = checkpoint(pointers.where("to IS NULL").unionByName(moved))
    return pointers


def _with_base_values(base: DataFrame, ends: DataFrame, pk: list[str], cols: list[str],
                      broadcast_rows: int, broadcast_bytes: int) -> DataFrame:
    from tidemark.operators.merge import within_bound  # merge uses this module

    known, asked = ends.where("known"), ends.where("NOT known")
    keys = asked.select("key.*").distinct()
    if within_bound(keys, broadcast_rows, broadcast_bytes):
        keys = F.broadcast(keys)
    rows = base.select(*pk, *cols).join(keys, pk, "left_semi")
    rows = rows.select(F.struct(*pk).alias("key"), *[F.col(c).alias(f"b_{c}") for c in cols])
    hit = asked.join(rows, "key", "left").select("at", "col", *[
        F.when(F.col("col") == c, F.col(f"b_{c}")).alias(f"v_{c}") for c in cols])
    return known.select("at", "col", *[f"v_{c}" for c in cols]).unionByName(hit)
