"""Change events: typed decoding, routing by table, metadata columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.constants import DELTA_META, EPOCH, LSN, MOVED_FROM, OP, SEQ, TS, UNCHANGED
from tidemark.functions.lsn import lsn_to_long
from tidemark.functions.types import decode_row, rejects

#: ``old_row``: the old key image of a change that moved its key; ``unchanged``:
#: columns an update did not send.  A source that has neither leaves them out.
EVENT_SCHEMA = ("table string, op string, row map<string,string>, lsn string, ts timestamp_ntz, "
                "seq bigint, old_row map<string,string>, unchanged array<string>")


def with_order(events: DataFrame) -> DataFrame:
    """Events with ``seq``: the source's own, else its log position as a number.

    A source numbers all of its events or none.  Where there is neither, or the
    position is no position, ``seq`` stays NULL: the event has no place in the
    order and is a reject (``order_rejects``).
    """
    at = lsn_to_long(F.col("lsn"))
    return events.withColumn("seq", F.coalesce("seq", at) if "seq" in events.columns else at)


def order_rejects(events: DataFrame) -> DataFrame:
    """(seq, table, column_name, raw) for every event without a place in the order."""
    return events.where("seq IS NULL").select("seq", "table", F.lit(SEQ).alias("column_name"),
                                              F.col("lsn").alias("raw"))


def decode_events(events: DataFrame, columns: list[dict], on_error: str = "null",
                  keep_meta: bool = True, primary_key: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """Event rows -> typed delta rows (``__op`` + schema columns + metadata).

    ``columns`` is the manifest column list ({name, pg_type, nullable}).
    Keys absent from a row image (e.g. non-key columns of a delete) are NULL;
    columns an update did not send are named in ``__unchanged``, and the old key of one
    that moved (``split_key_changes``) is in ``__moved_from``, if the events say so.
    """
    meta = [F.col("op").alias(OP)]
    if keep_meta:
        meta += [F.col("seq").alias(SEQ), F.col("lsn").alias(LSN), F.col("ts").alias(TS)]
        if "unchanged" in events.columns:
            meta.append(F.col("unchanged").alias(UNCHANGED))
            if primary_key and "moved_from" in events.columns:
                keys = [c for c in columns if c["name"] in primary_key]
                meta.append(F.when(F.col("moved_from").isNotNull(), F.struct(*decode_row(F.col("moved_from"), keys)))
                            .alias(MOVED_FROM))
    return events.select(*meta, *decode_row(F.col("row"), columns, on_error))


def split_key_changes(events: DataFrame, pk: list[str], old_row: str = "old_row") -> DataFrame:
    """An update that changed its primary key becomes ``D(old key)`` followed
    by the update under the new key (same sequence number: the two touch
    different keys, so their relative order does not matter).

    ``old_row`` is the old key image the source sends when a key changes
    (NULL otherwise); on the update it becomes ``moved_from``.  One ``inline`` per
    event: no join, no shuffle.
    """
    if old_row not in events.columns:
        return events
    moved = F.col(old_row).isNotNull() & F.exists(
        F.array(*[F.lit(k) for k in pk]),
        lambda k: ~F.element_at(F.col(old_row), k).eqNullSafe(F.element_at(F.col("row"), k)))
    rest = [c for c in events.columns if c not in ("op", "row", old_row)]
    new = F.struct(F.col("op").alias("op"), F.col("row").alias("row"), F.when(moved, F.col(old_row)).alias("moved_from"))
    gone = F.struct(F.lit("D").alias("op"), F.col(old_row).alias("row"),
                    F.lit(None).cast("map<string,string>").alias("moved_from"))
    return events.select(*rest, F.inline(F.when(moved, F.array(gone, new))
                                          .otherwise(F.array(new))))


def after_snapshot(chunks: list, key: Column, key_type, position: Column) -> Column:
    """Is a change of ``key`` at ``position`` not in the snapshot yet?

    A binary search over the ranges, as an expression.  A change without a key or
    position passes (it becomes a reject)."""
    def low(a: int, b: int) -> Column:
        if b - a == 1:
            return lsn_to_long(F.lit(chunks[a]["low"]))
        mid = (a + b) // 2
        return F.when(key < F.lit(chunks[mid]["from_key"]).cast(key_type), low(a, mid)).otherwise(low(mid, b))
    return F.coalesce(position > low(0, len(chunks)), F.lit(True))


def decode_rejects(events: DataFrame, columns: list[dict],
                   primary_key: tuple[str, ...] | list[str] = (), order: bool = False) -> DataFrame:
    """(seq, table, column, raw) for every value that failed to parse, and for
    every part of ``primary_key`` that is missing (``raw`` is NULL); with ``order`` those of
    ``order_rejects`` too, in the same read."""
    return rejects(events, columns, keep=("seq", "table"), required=primary_key,
                   also=((SEQ, F.col("lsn"), F.col("seq").isNull()),) if order else ())


def route(events: DataFrame, active: DataFrame, table_col: str = "table"):
    """Split events into (kept, skipped) by the active-table list.

    The active list holds one row per replicated table; it is broadcast
    only when a size check passes, else both joins shuffle on the table name.
    """
    a = active.select(F.col(table_col)).distinct()
    small = a.count() <= 100_000
    a = F.broadcast(a) if small else a
    return (events.join(a, table_col, "left_semi"),
            events.join(a, table_col, "left_anti"))


def with_meta(df: DataFrame, epoch: int | None = None, op: str | None = None) -> DataFrame:
    """Attach ``__op`` / ``__epoch`` literals to a frame of rows."""
    if op is not None:
        df = df.withColumn(OP, F.lit(op))
    if epoch is not None:
        df = df.withColumn(EPOCH, F.lit(epoch).cast("bigint"))
    return df


def strip_meta(df: DataFrame) -> DataFrame:
    """Data columns only (drop change metadata)."""
    return df.drop(*[c for c in DELTA_META if c in df.columns])
