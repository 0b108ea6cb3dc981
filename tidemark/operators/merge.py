"""Merge rule: fold ordered change events per key, apply them to a base.

Per primary key, events are applied in order (epoch, then sequence):

* ``I`` and ``U`` replace the whole row and clear an earlier tombstone;
* ``D`` on a present key keeps the latest image and stamps ``__deleted_at``;
  ``D`` on an absent key is ignored;
* any other op has no effect; keys without events pass through.

The fold is set-based: one aggregate per key over the deltas (partial
aggregation on the map side, so a hot key costs one row per task before the
shuffle; sort-based, since ``max_by`` buffers hold strings and structs),
then one join with the base.  Note that "take the last event" is
*not* enough: a trailing ``D`` must carry forward the last ``I``/``U`` image
of the same batch, so the image is an arg-max restricted to live ops.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.constants import (ALL_META, BROADCAST_BASE_RATIO, DEFAULT_BROADCAST_BYTES,
                                DEFAULT_BROADCAST_ROWS, DELETED_AT, EPOCH, LIVE_OPS, OP, OPS,
                                SEQ, UNCHANGED)
from tidemark.operators.lineage import resolve_moves
from tidemark.session import checkpoint

LAST_OP = "__last_op"
IMG = "__img"
N_IU = "__n_iu"
N_EVENTS = "__n_events"
_IN_BASE = "__in_base"
_ZK = "__zk_"
_FIXED = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def data_columns(df: DataFrame, pk: list[str], exclude=()) -> list[str]:
    """Non-key, non-metadata columns of a frame, in frame order."""
    skip = set(pk) | set(ALL_META) | set(exclude)
    return [c for c in df.columns if c not in skip]


def ts_literal(value) -> Column:
    """A UTC wall-clock literal as ``timestamp_ntz`` (no session-zone shift)."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(value)).cast("timestamp_ntz")


def order_struct(order: list[str] | tuple[str, ...]) -> Column:
    """Total order of events: a struct compares field by field."""
    return F.struct(*[F.col(c) for c in order])


def fold(deltas: DataFrame, pk: list[str], data_cols: list[str],
         order=(EPOCH, SEQ), partial: bool = False) -> DataFrame:
    """One row per key: last op, last live image, live-op and event counts.

    ``order`` must be a total order inside a key; ``(__epoch, __seq)`` is.
    The image is a struct so that NULL column values survive ``max_by``.

    ``partial``: events list columns they did not send in ``__unchanged``;
    each column then takes its own last *sent* value (``__has_<c>`` counts
    the sends), so an unsent value never overwrites a known one.
    """
    ordc = order_struct(order)
    live = F.col(OP).isin(*LIVE_OPS)
    d = deltas.filter(F.col(OP).isin(*OPS))
    counts = [F.max_by(F.col(OP), ordc).alias(LAST_OP), F.count_if(live).alias(N_IU),
              F.count(F.lit(1)).alias(N_EVENTS)]
    if not partial:
        return d.groupBy(*pk).agg(
            *counts, F.max_by(F.struct(*[F.col(c) for c in data_cols]),
                              F.when(live, ordc)).alias(IMG))
    sends = []
    for c in data_cols:
        sent = live & ~F.coalesce(F.array_contains(F.col(UNCHANGED), F.lit(c)), F.lit(False))
        sends += [F.max_by(F.col(c), F.when(sent, ordc)).alias(f"__v_{c}"),
                  F.count_if(sent).alias(f"__has_{c}")]
    z = d.groupBy(*pk).agg(*counts, *sends)
    return z.select(*pk, LAST_OP, N_IU, N_EVENTS,
                    F.struct(*[F.col(f"__v_{c}").alias(c) for c in data_cols]).alias(IMG),
                    *[F.col(f"__has_{c}") for c in data_cols])


def _key_match(left: DataFrame, right: DataFrame, pk: list[str],
               right_prefix: str = _ZK) -> Column:
    """Null-safe equality on every key column (no text concatenation)."""
    return reduce(lambda a, b: a & b,
                  [left[k].eqNullSafe(right[right_prefix + k]) for k in pk])


def _with_deleted_at(base: DataFrame) -> DataFrame:
    if DELETED_AT in base.columns:
        return base
    return base.withColumn(DELETED_AT, F.lit(None).cast("timestamp_ntz"))


def _zero(dt: T.DataType) -> Column | None:
    """A non-NULL stand-in of the key type (paired with an is-null flag)."""
    if isinstance(dt, T.NumericType):
        return F.lit(0).cast(dt)
    if isinstance(dt, T.StringType):
        return F.lit("")
    if isinstance(dt, T.BooleanType):
        return F.lit(False)
    if isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01").cast(dt)
    if isinstance(dt, T.BinaryType):
        return F.lit("").cast(dt)
    return None


def _encode_keys(df: DataFrame, pk: list[str], types: dict[str, T.DataType]):
    """Null-safe key as plain columns: (coalesce(k, zero), k IS NULL) per part.

    Grouping and joining on the same plain columns lets the aggregate's hash
    partitioning satisfy the join: the folded side is shuffled once, not
    again for a ``<=>`` join (which Spark hashes on a different expression).
    """
    enc = []
    for i, k in enumerate(pk):
        z = _zero(types[k])
        if z is None:
            raise TypeError(f"unsupported key type {types[k]} for {k}")
        enc += [F.coalesce(F.col(k), z).alias(f"__kc{i}"), F.col(k).isNull().alias(f"__kn{i}")]
    names = [c for i in range(len(pk)) for c in (f"__kc{i}", f"__kn{i}")]
    return df.select("*", *enc), names


def _decode_keys(pk: list[str], types: dict[str, T.DataType]) -> list[Column]:
    return [F.when(F.col(f"__kn{i}"), F.lit(None).cast(types[k]))
             .otherwise(F.col(f"__kc{i}")).alias(k) for i, k in enumerate(pk)]


def _merged_columns(keys: list[Column], data_cols, stamp: Column,
                    base_present: Column | bool, partial: bool = False):
    changed = F.coalesce(F.col(N_IU), F.lit(0)) > 0

    def taken(c):
        return changed & (F.coalesce(F.col(f"__has_{c}"), F.lit(0)) > 0) if partial else changed
    if base_present is False:
        data = [F.when(taken(c), F.col(f"{IMG}.{c}")).alias(c) for c in data_cols]
    else:
        data = [F.when(taken(c), F.col(f"{IMG}.{c}")).otherwise(F.col(c)).alias(c)
                for c in data_cols]
    prev = F.lit(None).cast("timestamp_ntz") if base_present is False else F.col(DELETED_AT)
    deleted = (F.when(F.col(LAST_OP) == "D", stamp)
                .when(changed, F.lit(None).cast("timestamp_ntz"))
                .otherwise(prev)).alias(DELETED_AT)
    return keys + data + [deleted]


def within_bound(df: DataFrame, rows: int, nbytes: int, of: DataFrame | None = None,
                 of_rows: int | None = None) -> bool:
    """Does ``df`` have at most ``rows`` rows and ``nbytes`` bytes of values (and ``of``
    at least ``BROADCAST_BASE_RATIO`` times its rows)?

    Rows first, which Parquet's footers tell; values are read only of what passed.
    ``of_rows``: the rows of ``of``, where they are known.
    """
    n = df.count()
    if n > rows or of is not None and (of.count() if of_rows is None else of_rows) < n * BROADCAST_BASE_RATIO:
        return False
    width = [F.lit(16 * len(df.columns))] + [
        F.coalesce(F.octet_length(F.col(f.name).cast("string")), F.lit(0))
        for f in df.schema.fields if not isinstance(f.dataType, _FIXED)]
    return int(df.agg(F.sum(reduce(lambda a, b: a + b, width).cast("bigint"))).collect()[0][0] or 0) <= nbytes


def merge(base: DataFrame, deltas: DataFrame, pk: list[str], compacted_at,
          order=(EPOCH, SEQ), strategy: str = "auto",
          broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
          null_safe: bool = True, partial: bool = False,
          broadcast_bytes: int = DEFAULT_BROADCAST_BYTES, base_rows: int | None = None) -> DataFrame:
    """Apply ordered deltas to a base; returns base columns + ``__deleted_at``.

    ``strategy``:

    * ``"full"`` — ``base FULL OUTER JOIN fold(deltas)``: the base is shuffled
      once on the key, the fold only by its own aggregation.
    * ``"broadcast"`` — ``base LEFT JOIN broadcast(fold)`` plus the new keys;
      the base is never shuffled.  The fold is written once with
      ``checkpoint()`` (shared folder) and reused by both branches.  Taken
      only while the deltas, which bound the fold, are within
      ``broadcast_rows`` and ``broadcast_bytes``; else this is ``"full"``.
    * ``"auto"`` — as ``"broadcast"``, and only where the base has at least
      ``BROADCAST_BASE_RATIO`` rows per delta row: the split reads the base's
      keys a second time, which pays off only if it spares a large shuffle.

    ``null_safe=False`` groups and joins on the raw key columns (source
    primary keys are NOT NULL).  Then a base bucketed by the key keeps its
    bucketing through the join: with ``spark.sql.shuffle.partitions`` equal
    to the bucket count, only the folded deltas are shuffled.

    ``partial=True`` honours an ``__unchanged`` array column on the deltas
    (columns an update did not send): such values keep the last known one.
    Where a row moved its key (``__moved_from``), that is the old key's.

    ``base_rows``: the base's rows, where the manifest has them; else a job counts them.
    """
    base = _with_deleted_at(base)
    data_cols = data_columns(base, pk)
    types = {f.name: f.dataType for f in base.schema.fields}
    for c in [c for c in data_cols if c not in deltas.columns]:
        deltas = deltas.withColumn(c, F.lit(None).cast(types[c]))
    if partial:
        deltas = resolve_moves(base, deltas, pk, data_cols, tuple(order), broadcast_rows, broadcast_bytes)
    stamp = ts_literal(compacted_at)
    if strategy not in ("auto", "full", "broadcast"):
        raise ValueError(f"unknown merge strategy {strategy!r}")
    if strategy != "full":
        # never broadcast without the bound, even when asked to
        small = within_bound(deltas, broadcast_rows, broadcast_bytes,
                             of=base if strategy == "auto" else None, of_rows=base_rows)
        strategy = "broadcast" if small else "full"
    if null_safe:
        d_enc, kcols = _encode_keys(deltas, pk, types)
        b_enc, _ = _encode_keys(base, pk, types)
        keys = _decode_keys(pk, types)
    else:
        d_enc, b_enc, kcols, keys = deltas, base, list(pk), [F.col(k) for k in pk]
    partial = partial and UNCHANGED in deltas.columns
    z = fold(d_enc, kcols, data_cols, order, partial)
    if strategy == "full":
        j = b_enc.withColumn(_IN_BASE, F.lit(True)).join(z, kcols, "full")
        present = F.col(_IN_BASE).isNotNull()
        keep = present | (F.coalesce(F.col(N_IU), F.lit(0)) > 0)
        return j.filter(keep).select(*_merged_columns(keys, data_cols, stamp, present, partial))
    # broadcast split; z is bounded by the row check, so writing it is cheap
    z = checkpoint(z)
    part1 = b_enc.join(F.broadcast(z), kcols, "left") \
        .select(*_merged_columns(keys, data_cols, stamp, True, partial))
    hit = b_enc.select(*kcols).join(F.broadcast(z.select(*kcols)), kcols, "left_semi")
    fresh = z.filter(F.col(N_IU) > 0).join(hit, kcols, "left_anti")
    part2 = fresh.select(*_merged_columns(keys, data_cols, stamp, False, partial))
    return part1.unionByName(part2)


def live(df: DataFrame) -> DataFrame:
    """Hide tombstoned rows (consumer view)."""
    return df.filter(F.col(DELETED_AT).isNull())


def purge(df: DataFrame, now, retention_days: int = 30) -> DataFrame:
    """Drop tombstones strictly older than the retention (kept at exactly it)."""
    return df.filter(F.col(DELETED_AT).isNull() | (F.col(DELETED_AT) >= _cutoff(now, retention_days)))


def _cutoff(now, retention_days: int) -> Column:
    return ts_literal(now) - F.make_dt_interval(F.lit(retention_days))


def delete_audit(base: DataFrame, deltas: DataFrame, pk: list[str],
                 order=(EPOCH, SEQ), broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                 broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Every delete event with ``__applied``: did it hit a present key?

    A delete applies when its key is in the base or received an ``I``/``U``
    earlier in the change order; otherwise the fold ignores it.  Base keys
    and live events are reduced to one row per key (key columns only, partial
    aggregation) before they meet the deletes in one equi-join.  When the
    deletes' keys are few and small (``broadcast_rows``, ``broadcast_bytes``), the base keys are first
    semi-joined with the broadcast delete keys, so only base keys that some
    delete names are shuffled, not the whole base.
    """
    ordc = order_struct(order)
    otype = deltas.select(ordc.alias("o")).schema["o"].dataType
    dels = deltas.filter(F.col(OP) == "D").withColumn("__ord", ordc)
    base_keys = base.select(*pk)
    if within_bound(dels.select(*pk), broadcast_rows, broadcast_bytes):
        dk = dels.select(*[F.col(k).alias(_ZK + k) for k in pk]).distinct()
        base_keys = base_keys.join(F.broadcast(dk), _key_match(base_keys, dk, pk), "left_semi")
    marks = base_keys.select(*pk, F.lit(1).alias("__b"),
                             F.lit(None).cast(otype).alias("__o")).unionByName(
        deltas.filter(F.col(OP).isin(*LIVE_OPS))
              .select(*pk, F.lit(0).alias("__b"), ordc.alias("__o")))
    per_key = marks.groupBy(*pk).agg(F.max("__b").alias("__in_base"),
                                     F.min("__o").alias("__first_live"))
    per_key = per_key.select(*[F.col(k).alias(_ZK + k) for k in pk],
                             "__in_base", "__first_live")
    j = dels.join(per_key, _key_match(dels, per_key, pk), "left")
    applied = (F.coalesce(F.col("__in_base"), F.lit(0)) == 1) | \
        F.coalesce(F.col("__first_live") < F.col("__ord"), F.lit(False))
    return j.select(*dels.columns, applied.alias("__applied")).drop("__ord")


def compaction_counters(base: DataFrame, deltas: DataFrame,
                        merged: DataFrame | None = None, now=None,
                        retention_days: int = 30) -> DataFrame:
    """Counters of one compaction as a one-row frame.

    ``deltas`` = distinct epochs read, ``applied`` = delta rows read (every
    row counts, as in the fold).  With ``merged``: its ``rows`` and
    ``tombstones``, and with ``now`` how many of them a purge takes away
    (``purged``; deletes without effect are told by ``delete_audit``).
    """
    src = "__src"
    parts = [deltas.select(F.lit("d").alias(src), F.col(OP), F.col(EPOCH),
                           F.lit(None).cast("timestamp_ntz").alias(DELETED_AT)),
             base.select(F.lit("b").alias(src), F.lit(None).cast("string").alias(OP),
                         F.lit(None).cast("bigint").alias(EPOCH),
                         F.lit(None).cast("timestamp_ntz").alias(DELETED_AT))]
    if merged is not None:
        parts.append(merged.select(F.lit("m").alias(src),
                                   F.lit(None).cast("string").alias(OP),
                                   F.lit(None).cast("bigint").alias(EPOCH),
                                   F.col(DELETED_AT)))
    u = reduce(DataFrame.unionByName, parts)
    is_d = F.col(src) == "d"
    aggs = [F.count_distinct(F.when(is_d, F.col(EPOCH))).alias("deltas"),
            F.count_if(is_d).alias("applied"),
            F.count_if(is_d & (F.col(OP) == "I")).alias("inserts"),
            F.count_if(is_d & (F.col(OP) == "U")).alias("updates"),
            F.count_if(is_d & (F.col(OP) == "D")).alias("deletes"),
            F.count_if(F.col(src) == "b").alias("base_rows")]
    if merged is not None:
        aggs += [F.count_if(F.col(src) == "m").alias("rows"),
                 F.count_if((F.col(src) == "m") & F.col(DELETED_AT).isNotNull())
                 .alias("tombstones")]
        if now is not None:
            aggs.append(F.count_if((F.col(src) == "m") & (F.col(DELETED_AT) < _cutoff(now, retention_days)))
                        .alias("purged"))
    # one global aggregate over a tagged union: a single pass, no cross join
    return u.agg(*aggs)
