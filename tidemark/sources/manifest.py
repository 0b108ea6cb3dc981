"""The manifest: the contract between the writer and its consumers.

Layout under ``<root>/_manifest``:

    header-<n>.json       small document: version, source, roles,
                          updated_at, last_compacted_at, tables_version
    tables/v=<n>/         JSON lines, one row per table (status, tags,
                          primary key, schema columns, epochs, row count)
    log/s=<k>/            JSON lines: field changes of some tables

Table entries are written and read by Spark, so a catalog of any size never
passes through the driver.  Each publish renames a complete header file to the
next number and the highest number counts, so there always is a header, and it
names the table version and log segments that belong together.  Updates (one per micro-batch, one per compaction) append a
log segment holding only the changed tables: O(changes), not O(tables).
Readers fold the log onto the snapshot with one per-table arg-max; every
``LOG_FOLD`` segments the fold is written as a new snapshot.
"""

from __future__ import annotations

import json
import re
import threading
import time
import uuid
from contextlib import contextmanager
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import fs

COLUMN = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("pg_type", T.StringType()),
    T.StructField("parquet_type", T.StringType()), T.StructField("nullable", T.BooleanType()),
    T.StructField("precision", T.IntegerType()), T.StructField("scale", T.IntegerType())])

#: A key range of the first snapshot: where it begins (text of the first key column, NULL: at
#: the start), and the log positions from before and after it was read.
SNAPSHOT_CHUNK = T.StructType([
    T.StructField("from_key", T.StringType()), T.StructField("low", T.StringType()),
    T.StructField("high", T.StringType())])

TABLE_ENTRY = T.StructType([
    T.StructField("table", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("primary_key", T.ArrayType(T.StringType())),
    T.StructField("schema_version", T.LongType()),
    T.StructField("columns", T.ArrayType(COLUMN)),
    T.StructField("base_epoch", T.LongType()),
    T.StructField("latest_delta_epoch", T.LongType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("path", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("buckets", T.LongType()),     # Spark-bucketed base (NULL: plain)
    # bucket-directory layout: current base epoch of each key-hash bucket
    # (NULL element: bucket empty); NULL: another layout
    T.StructField("bucket_epochs", T.ArrayType(T.LongType())),
    # every base published so far; readers look at no other
    T.StructField("base_epochs", T.ArrayType(T.LongType())),
    # TRUE once a delta held an update that did not send every column
    T.StructField("partial_images", T.BooleanType()),
    # highest place in the source's order that a stream has landed
    T.StructField("position", T.LongType()),
    # key ranges of the snapshot, in key order
    T.StructField("snapshot", T.ArrayType(SNAPSHOT_CHUNK)),
])

#: Fields that only grow: of several writers the largest value counts.
_GROWING = ("base_epoch", "latest_delta_epoch", "schema_version", "position")
#: Old headers that stay for readers that are about to open them.
_HEADERS_KEPT = 16


def entries(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Entries frame from positional tuples; trailing fields may be omitted."""
    n = len(TABLE_ENTRY.fields)
    return spark.createDataFrame([tuple(r) + (None,) * (n - len(r)) for r in rows], TABLE_ENTRY)


def _dir(root: str) -> str:
    return f"{root.rstrip('/')}/_manifest"


def _headers(spark: SparkSession, root: str) -> list[int]:
    found = (re.fullmatch(r"header-(\d+)\.json", f) for f in fs.list_files(spark, _dir(root)))
    return sorted(int(m[1]) for m in found if m)


def read_header(spark: SparkSession, root: str) -> dict:
    numbers = _headers(spark, root)
    if not numbers:
        if fs.exists(spark, f"{_dir(root)}/tables"):
            raise RuntimeError(f"{_dir(root)} has tables but no header")
        return {}
    return json.loads(fs.read_text(spark, f"{_dir(root)}/header-{numbers[-1]}.json"))


def write_header(spark: SparkSession, root: str, header: dict) -> None:
    header = dict(header)
    header["updated_at"] = header.get("updated_at") or \
        datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    numbers = _headers(spark, root)
    fs.write_new(spark, f"{_dir(root)}/header-{(numbers or [0])[-1] + 1}.json",
                 json.dumps(header, sort_keys=True))
    for n in numbers[:-_HEADERS_KEPT]:
        fs.delete(spark, f"{_dir(root)}/header-{n}.json")


def allocate_epoch(spark: SparkSession, root: str, stream: str, batch_id: int) -> int:
    """The epoch of micro-batch ``batch_id`` of ``stream`` (its checkpoint).

    Under the publish lock: a replay of the stream's last batch gets the
    epoch it had; a new batch gets one past the newest epoch of any table
    and any stream.  Epochs stay global, increasing and never reused, even
    with several streams writing into one root.  Only each stream's last
    allocation is kept (Spark replays at most the last uncommitted batch).
    """
    with publish_lock(spark, root):
        header = read_header(spark, root)
        streams = dict(header.get("streams") or {})
        last = streams.get(stream)
        if last and int(last["batch"]) == batch_id:
            return int(last["epoch"])
        if last and int(last["batch"]) > batch_id:
            raise RuntimeError(f"stream {stream}: batch {batch_id} after {last['batch']}")
        newest = header.get("newest_epoch")
        if newest is None:  # no stream has finished an epoch under this root
            newest = read_tables(spark, root).agg(F.max("latest_delta_epoch")).collect()[0][0]
        epoch = max([int(newest or 0), *(int(v["epoch"]) for v in streams.values())]) + 1
        header["newest_epoch"] = epoch
        streams[stream] = {"batch": batch_id, "epoch": epoch}
        header["streams"] = streams
        header.pop("updated_at", None)
        write_header(spark, root, header)
        return epoch


def finish_epoch(spark: SparkSession, root: str, stream: str | None, epoch: int) -> None:
    """A batch without anything to publish is over."""
    with publish_lock(spark, root):
        header = read_header(spark, root)
        _finish(header, stream, epoch)
        header.pop("updated_at", None)
        write_header(spark, root, header)


def _finish(header: dict, stream: str | None, epoch: int) -> None:
    """``published_epoch``: up to it no stream has an epoch open."""
    streams = {k: dict(v) for k, v in (header.get("streams") or {}).items()}
    if stream in streams and int(streams[stream]["epoch"]) == epoch:
        streams[stream]["published"] = epoch
    header["streams"] = streams
    newest = max([epoch, int(header.get("newest_epoch") or 0)])
    begun = [int(v["epoch"]) for v in streams.values() if v.get("published") != v["epoch"]]
    header["newest_epoch"] = newest
    header["published_epoch"] = min([newest, *(e - 1 for e in begun)])


LOG_FOLD = 64
_LSEQ = "__lseq"


def _read_snapshot(spark: SparkSession, root: str, header: dict) -> DataFrame:
    v = header.get("tables_version")
    if v is None:
        return spark.createDataFrame([], TABLE_ENTRY)
    return spark.read.schema(TABLE_ENTRY).json(f"{_dir(root)}/tables/v={v}")


def read_tables(spark: SparkSession, root: str) -> DataFrame:
    """One row per table: the snapshot with the live log folded on top.

    Per table and field, the newest non-NULL logged value wins (an arg-max
    over the log's sequence numbers), for epochs the largest; tables only in
    the snapshot or only in the log are kept.  One small aggregate and one
    join, no driver-side merging.
    """
    header = read_header(spark, root)
    snap = _read_snapshot(spark, root, header)
    segs = header.get("log") or []
    if not segs:
        return snap
    log_schema = T.StructType(TABLE_ENTRY.fields + [T.StructField(_LSEQ, T.LongType())])
    log = spark.read.schema(log_schema).json([f"{_dir(root)}/log/s={k}" for k in segs])
    fields = [f.name for f in TABLE_ENTRY.fields if f.name != "table"]
    last = log.groupBy("table").agg(*[
        (F.max(c) if c in _GROWING else
         F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(_LSEQ)))).alias("__n_" + c)
        for c in fields])
    return snap.join(last, "table", "full").select("table", *[_folded(c) for c in fields])


def _folded(c: str) -> Column:
    """The later of the values ``__n_<c>`` and ``<c>``; of an epoch the larger."""
    pick = F.greatest if c in _GROWING else F.coalesce
    return pick(F.col("__n_" + c), F.col(c)).alias(c)


@contextmanager
def publish_lock(spark: SparkSession, root: str, lease_s: float = 600.0,
                 wait_s: float = 600.0):
    """Serialise manifest publishes (streamer and compactor, D18).

    A lock file created exclusively, holding its owner's token.  The owner
    renews it while it works, so only the lock of a dead owner grows older
    than ``lease_s`` and is broken; and it removes the lock only while the
    token is its own.
    """
    lock, token = f"{_dir(root)}/_publish.lock", uuid.uuid4().hex
    start, delay = time.time(), 0.05
    while not fs.create_exclusive(spark, lock, token):
        age, owner = fs.age_seconds(spark, lock), _owner(spark, lock)
        if age is not None and age > lease_s and _break(spark, lock, owner, token):
            continue
        if time.time() - start > wait_s:
            raise TimeoutError(f"manifest of {root} locked for {wait_s}s")
        time.sleep(delay)
        delay = min(delay * 2, 2.0)
    done = threading.Event()

    def renew():
        while not done.wait(lease_s / 4):
            if _owner(spark, lock) == token:
                fs.touch(spark, lock)
    keeper = threading.Thread(target=renew, daemon=True)
    keeper.start()
    try:
        yield
    finally:
        done.set()
        keeper.join()
        if _owner(spark, lock) == token:
            fs.delete(spark, lock)


def _owner(spark: SparkSession, lock: str) -> str | None:
    try:
        return fs.read_text(spark, lock)
    except Py4JJavaError:       # gone between the look and the read
        return None


def _break(spark: SparkSession, lock: str, owner: str | None, token: str) -> bool:
    """Take away a dead owner's lock: of several waiters one renames it, and puts
    it back if it took a newer one."""
    aside = f"{lock}.{token}"
    if not fs.rename(spark, lock, aside):
        return False
    if _owner(spark, aside) != owner and fs.rename(spark, aside, lock):
        return False
    fs.delete(spark, aside)
    return True


def publish(spark: SparkSession, root: str, tables: DataFrame, _locked: bool = False,
            **header_updates) -> int:
    """Write ``tables`` as a new version, then switch the header to it.

    Runs under ``publish_lock``, so a directory of the next version can only
    be what a publisher left that died before its header: it is overwritten.
    """
    if not _locked:
        with publish_lock(spark, root):
            return publish(spark, root, tables, _locked=True, **header_updates)
    header = read_header(spark, root)
    v = int(header.get("tables_version", 0)) + 1
    out = tables.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                          if f.name in tables.columns else
                          F.lit(None).cast(f.dataType).alias(f.name)
                          for f in TABLE_ENTRY.fields])
    target = f"{_dir(root)}/tables/v={v}"
    out.write.mode("overwrite").json(target)
    header.update(header_updates)
    header["tables_version"] = v
    header["log"] = []                    # the snapshot includes every change
    header.pop("updated_at", None)
    if "newest_epoch" not in header_updates:
        header.pop("newest_epoch", None)  # the entries may be anyone's: they tell
    header.setdefault("version", 1)
    write_header(spark, root, header)
    return v


def update_tables(spark: SparkSession, root: str, changes: DataFrame,
                  finished: tuple[str | None, int] | None = None, **header_updates) -> int:
    """Set fields of the tables named in ``changes``, known or new, and publish.

    ``changes`` holds the table name plus the fields to set; other fields
    keep their values (a field cannot be set back to NULL).  The changes
    are appended as a log segment: the cost follows the changed tables, not
    the catalog.  Read, append and header swap happen under one
    ``publish_lock``, so concurrent writers never lose each other's updates.
    ``finished``: the stream and epoch that this completes.
    """
    with publish_lock(spark, root):
        if finished:
            header = read_header(spark, root)
            _finish(header, *finished)
            header_updates |= {k: header[k] for k in ("streams", "newest_epoch", "published_epoch")}
        return _update_once(spark, root, changes, **header_updates)


def _update_once(spark: SparkSession, root: str, changes: DataFrame, **header_updates) -> int:
    """Append ``changes`` as a log segment (only the changed tables), or,
    every ``LOG_FOLD`` segments, fold everything into a new snapshot."""
    header = read_header(spark, root)
    if "latest_delta_epoch" in changes.columns and "newest_epoch" not in header_updates:
        header_updates["newest_epoch"] = None      # set by hand: the entries tell
    segs = list(header.get("log") or [])
    if len(segs) + 1 >= LOG_FOLD:
        # fold: snapshot + log + these changes -> a new snapshot version
        cur = read_tables(spark, root)
        chg = changes.select([F.col(c).alias("__n_" + c) if c != "table" else F.col(c)
                              for c in changes.columns])
        j = cur.join(chg, "table", "full")
        cols = [_folded(f.name)
                if f.name in changes.columns and f.name != "table" else F.col(f.name)
                for f in TABLE_ENTRY.fields]
        # reads version v and its log, writes v+1: another directory
        return publish(spark, root, j.select(*cols), _locked=True, **header_updates)
    k = int(header.get("log_seq", 0)) + 1
    target = f"{_dir(root)}/log/s={k}"
    out = changes.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                           if f.name in changes.columns else
                           F.lit(None).cast(f.dataType).alias(f.name)
                           for f in TABLE_ENTRY.fields], F.lit(k).cast("bigint").alias(_LSEQ))
    out.coalesce(1).write.mode("overwrite").json(target)
    header.update(header_updates)
    header["log"] = segs + [k]
    header["log_seq"] = k
    header.pop("updated_at", None)
    write_header(spark, root, header)
    return k


def entry(spark: SparkSession, root: str, table: str) -> dict | None:
    """One table's entry as a dict (a single small row to the driver)."""
    rows = read_tables(spark, root).filter(F.col("table") == table).limit(1).collect()
    return rows[0].asDict(recursive=True) if rows else None
