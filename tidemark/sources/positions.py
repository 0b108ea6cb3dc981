"""What a stream has landed: the place of each event in the log, and a ledger of deliveries.

    <root>/_positions/__epoch=<n>/   table, seq, event: one row for each event of the batch
    <root>/_ledger/__epoch=<n>/      table, landed, written, replayed, in_snapshot, first_seq, last_seq

Sources deliver at least once: after a restart they send again what was not
confirmed.  An event is known by its table, its place in the order and a hash of
its op and row, so one that comes again is found whatever batch it comes in, and
however long ago its deltas were compacted away.  Only events at or below the
highest place that the manifest has for their table can be old, so a batch
without such events reads nothing here; others read the files whose range of
places theirs overlap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.constants import EPOCH
from tidemark.sources import fs

EVENT_ID = "__event"
_POSITIONS = f"table string, seq bigint, {EVENT_ID} bigint, {EPOCH} bigint"
_LEDGER = ("table string, landed bigint, written bigint, replayed bigint, in_snapshot bigint, "
           f"first_seq bigint, last_seq bigint, {EPOCH} bigint")


def event_id() -> Column:
    """What tells apart events in one place of the order: a hash of op and row."""
    return F.xxhash64("op", F.sort_array(F.map_entries("row")))


def _path(root: str, what: str) -> str:
    return f"{root.rstrip('/')}/{what}"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    if not fs.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def write_positions(events: DataFrame, root: str, epoch: int) -> None:
    """Remember the events of ``epoch`` (a replay of the batch replaces them)."""
    (events.where("seq IS NOT NULL").select("table", "seq", EVENT_ID).sortWithinPartitions("table", "seq")
           .write.mode("overwrite").parquet(f"{_path(root, '_positions')}/{EPOCH}={epoch}"))


def landed_before(spark: SparkSession, root: str, table: str, epoch: int, first_seq: int, last_seq: int) -> DataFrame:
    """``(seq, __event)`` of a table's events of earlier epochs within a range of places."""
    return _read(spark, _path(root, "_positions"), _POSITIONS).where(
        (F.col("table") == table) & F.col("seq").between(first_seq, last_seq) & (F.col(EPOCH) < epoch)) \
        .select("seq", EVENT_ID)


def drop_positions(spark: SparkSession, root: str, upto: int) -> list[int]:
    """Forget the events of epochs up to ``upto``, once the source can't send them again."""
    path = _path(root, "_positions")
    gone = sorted(int(d.split("=", 1)[1]) for d in fs.list_dirs(spark, path) if d.startswith(EPOCH + "="))
    gone = [e for e in gone if e <= upto]
    for e in gone:
        fs.delete(spark, f"{path}/{EPOCH}={e}")
    return gone


def write_ledger(spark: SparkSession, root: str, epoch: int, rows: list[tuple]) -> None:
    """One row per table of the batch (``_LEDGER`` without the epoch)."""
    (spark.createDataFrame(rows, _LEDGER.rsplit(",", 1)[0]).coalesce(1)
          .write.mode("overwrite").parquet(f"{_path(root, '_ledger')}/{EPOCH}={epoch}"))


def delivery_ledger(spark: SparkSession, root: str) -> DataFrame:
    """Per epoch and table: events ``landed`` (each counted once a batch), those
    ``written`` as deltas or rejects, those ``replayed`` (landed in an earlier epoch), the
    changes that the table's snapshot holds already (a move of a key is two), and the
    range of places."""
    return _read(spark, _path(root, "_ledger"), _LEDGER).withColumnRenamed(EPOCH, "epoch")
