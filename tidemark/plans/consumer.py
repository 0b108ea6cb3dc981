"""Consumer reads against the storage layout: as-of an epoch, live view, changes.

Only what the manifest publishes is read: its bases, and deltas up to its newest
epoch.  A base that a compaction is writing, or left behind, is not there yet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.constants import EPOCH
from tidemark.functions.types import struct_for
from tidemark.operators import merge as M
from tidemark.operators import reads as R
from tidemark.operators.lineage import resolve_moves
from tidemark.sources import manifest, storage


def _schema(entry: dict):
    return struct_for([{"name": c["name"], "pg_type": c["pg_type"]} for c in entry["columns"]])


class ResyncRequired(ValueError):
    """The changes asked for are gone: pull the whole table again."""


def published_bases(entry: dict) -> list[int]:
    """Epochs of the bases the manifest names, the newest last."""
    known = set(entry.get("base_epochs") or [])
    return sorted(known | ({int(entry["base_epoch"])} if entry.get("base_epoch") is not None else {0}))


def as_of(spark: SparkSession, root: str, table: str, epoch: int, stamp,
          strategy: str = "auto", entry: dict | None = None) -> DataFrame:
    """State at ``epoch``: newest base <= epoch, plus its later deltas <= epoch.
    ``entry``: the manifest's, where the caller has read (and pinned) it.

    Deltas at or below the newest base are gone after compaction, so an
    epoch between an older base and the newest one cannot be rebuilt: that
    is an error, never a silently wrong answer.
    """
    e = entry or manifest.entry(spark, root, table)
    if e is None:
        raise KeyError(table)
    data = _schema(e)
    pk = list(e["primary_key"])
    upto = min(epoch, int(e.get("latest_delta_epoch") or 0))
    partial = bool(e.get("partial_images"))
    schema = storage.delta_schema(data, partial=partial, pk=pk)
    if e.get("bucket_epochs") is not None:
        b = int(e.get("base_epoch") or 0)
        if epoch < b:
            raise ValueError(f"epoch {epoch} of {table} is not addressable: the bucket "
                             f"layout keeps the state at {b} and later deltas only")
        base = storage.read_base_buckets(spark, root, table, storage.base_schema(data),
                                         list(e["bucket_epochs"]))
        deltas = storage.read_deltas(spark, root, table, schema, after=b, upto=upto)
        return M.merge(base, deltas, pk, stamp, strategy=strategy, partial=partial)
    buckets = int(e["buckets"]) if e.get("buckets") else None
    base, b = storage.read_base(spark, root, table, storage.base_schema(data), upto=epoch,
                                buckets=buckets, pk=pk, published=published_bases(e))
    b = b or 0
    newest = published_bases(e)[-1]
    if b < newest and epoch > b:
        raise ValueError(f"epoch {epoch} of {table} is not addressable: deltas after "
                         f"base {b} up to {newest} were consumed by compaction")
    deltas = storage.read_deltas(spark, root, table, schema, after=b, upto=upto)
    # a bucketed base keeps its bucketing through a join on the raw key
    return M.merge(base, deltas, pk, stamp, strategy=strategy, null_safe=not buckets,
                   partial=partial)


def changes_since(spark: SparkSession, root: str, table: str, epoch: int | None,
                  net: bool = False, upto: int | None = None, entry: dict | None = None) -> DataFrame:
    """Changes of a table after a consumer's watermark (and up to epoch ``upto``), from storage.

    ``net``: one row per key, its last op and image, instead of every change.  Where
    the table has updates that did not send every column, the changes name those in
    ``__unchanged``, and a net image lists what was never sent after the watermark there.
    A consumer that never pulled, or whose watermark is below the compacted
    base (its changes are gone), gets ``ResyncRequired``.
    """
    e = entry or manifest.entry(spark, root, table)
    if e is None:
        raise KeyError(table)
    base = int(e.get("base_epoch") or 0)
    if epoch is None or epoch < base:
        raise ResyncRequired(f"{table}: changes after {epoch} are in base {base} already")
    partial = bool(e.get("partial_images"))
    data, pk = _schema(e), list(e["primary_key"])
    names = [c["name"] for c in e["columns"] if c["name"] not in pk]
    # what a moved row left unsent may be in changes that the consumer has already, or in the base
    deltas = storage.read_deltas(spark, root, table, storage.delta_schema(data, partial=partial, pk=pk),
                                 after=base if partial else epoch,
                                 upto=min(int(e.get("latest_delta_epoch") or 0), upto if upto is not None else 1 << 62))
    if partial:
        deltas = resolve_moves(_published_base(spark, root, table, e, data), deltas, pk, names) \
            .where(F.col(EPOCH) > epoch)
    if not net:
        return deltas
    return R.net_changes_since(deltas, pk, epoch, data_cols=names, partial=partial)


def _published_base(spark: SparkSession, root: str, table: str, e: dict, data) -> DataFrame:
    if e.get("bucket_epochs") is not None:
        return storage.read_base_buckets(spark, root, table, storage.base_schema(data), list(e["bucket_epochs"]))
    base, _ = storage.read_base(spark, root, table, storage.base_schema(data), pk=list(e["primary_key"]),
                                buckets=int(e["buckets"]) if e.get("buckets") else None, published=published_bases(e))
    return base


def live_view(spark: SparkSession, root: str, table: str, view: str, stamp) -> DataFrame:
    """Temp view of the current base + uncompacted deltas, tombstones hidden."""
    e = manifest.entry(spark, root, table)
    df = M.live(as_of(spark, root, table, int(e["latest_delta_epoch"] or 0), stamp))
    df.createOrReplaceTempView(view)
    return spark.table(view)
