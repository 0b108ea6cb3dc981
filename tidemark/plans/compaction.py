"""Compaction jobs: merge a table's deltas into a new base, then publish.

Order of effects per table (each step durable before the next):
1. write the new base at ``latest_delta_epoch`` (a new directory);
2. publish a manifest version naming it;
3. retire the consumed delta partitions (and, with ``keep_bases``, older bases), and
   sweep those that no reader has pinned and whose grace period is over.
A failure before (2) leaves the old base current and every delta in place;
rerunning is safe.  Tables are published one by one, so a failing table
never costs another its deltas.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.constants import DELETED_AT
from tidemark.functions.types import struct_for
from tidemark.operators.merge import merge, purge
from tidemark.plans import removal
from tidemark.plans.consumer import published_bases
from tidemark.sources import manifest, storage


def _columns(entry: dict) -> list[dict]:
    return [{"name": c["name"], "pg_type": c["pg_type"], "nullable": c.get("nullable", True)}
            for c in entry.get("columns") or []]


@contextmanager
def _conf(spark: SparkSession, key: str, value: str | None):
    """Set a session conf for one job, restoring the previous value."""
    if value is None:
        yield
        return
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def compact_table(spark: SparkSession, root: str, table: str, compacted_at,
                  now=None, retention_days: int = 30, strategy: str = "auto",
                  entry: dict | None = None, grace_s: float = 0.0,
                  keep_bases: int | None = None) -> dict:
    """Compact one table up to its newest published epoch; what was done, as a dict.

    ``entry`` is its manifest entry, where the caller has read it already.  Replaced deltas and
    bases go as ``removal`` says: ``grace_s``, ``keep_bases`` (``None``: all stay)."""
    e = entry if entry is not None else manifest.entry(spark, root, table)
    if e is None or e.get("status") != "active":
        return {"table": table, "status": "skipped (not active)"}
    pk = e.get("primary_key") or []
    if not pk:
        raise ValueError(f"no primary key for {table}")
    cols = _columns(e)
    if not cols:
        return {"table": table, "status": "skipped (no schema)"}
    base_e = int(e.get("base_epoch") or 0)
    latest = int(e.get("latest_delta_epoch") or 0)
    if latest <= base_e:
        return {"table": table, "status": "up to date", "base_epoch": base_e}
    assert latest > base_e   # the new base never overwrites the one being read
    data = struct_for(cols)
    if e.get("bucket_epochs") is not None:
        return _compact_buckets(spark, root, table, e, pk, data, base_e, latest,
                                compacted_at, now, retention_days, strategy, grace_s)
    buckets = int(e["buckets"]) if e.get("buckets") else None
    # Bucketed base: fold shuffle partitions = bucket count, so the fold's
    # exchange matches the base's bucketing and the base is never shuffled;
    # keys are primary keys (NOT NULL), joined as plain columns.
    with _conf(spark, "spark.sql.shuffle.partitions", str(buckets) if buckets else None):
        base, _ = storage.read_base(spark, root, table, storage.base_schema(data),
                                    upto=base_e, buckets=buckets, pk=pk,
                                    published=published_bases(e))
        partial = bool(e.get("partial_images"))
        deltas = storage.read_deltas(spark, root, table, storage.delta_schema(data, partial=partial, pk=pk),
                                     after=base_e, upto=latest)
        # counters ride along the write job (no extra pass): delta rows read
        # (every row counts as applied, as in the fold), epochs, pre-purge rows
        read = Observation(f"deltas_{table}_{latest}")
        deltas = deltas.observe(read, F.count(F.lit(1)).alias("applied"))
        n_epochs = sum(1 for x in storage.delta_epochs(spark, root, table) if base_e < x <= latest)
        out = merge(base, deltas, pk, compacted_at,
                    strategy="full" if buckets else strategy, null_safe=not buckets,
                    partial=partial, base_rows=e.get("row_count") if base_e else None)
        merged = Observation(f"merged_{table}_{latest}")
        out = out.observe(merged, F.count(F.lit(1)).alias("rows"),
                          F.count_if(F.col(DELETED_AT).isNotNull()).alias("tombstones"))
        if now is not None:
            out = purge(out, now, retention_days)
        rows = storage.write_base(out, root, table, latest, buckets=buckets, pk=pk)
    counters = {**read.get, **merged.get}
    change = spark.createDataFrame(
        [(table, latest, rows, sorted({*published_bases(e), latest}))],
        "table string, base_epoch bigint, row_count bigint, base_epochs array<bigint>")
    manifest.update_tables(spark, root, change, last_compacted_at=str(compacted_at))
    removal.retire(spark, root, table, latest, keep_bases)
    gone = removal.sweep(spark, root, table, grace_s)
    return {"table": table, "status": "compacted", "base_epoch": latest,
            "rows": rows, "dropped_epochs": len(gone["deltas"]), "dropped_bases": gone["bases"],
            "deltas": n_epochs, "applied": int(counters["applied"]),
            "purged": int(counters["rows"]) - rows,
            "tombstones_before_purge": int(counters["tombstones"])}


def _compact_buckets(spark, root, table, e, pk, data, base_e, latest, compacted_at,
                     now, retention_days, strategy, grace_s) -> dict:
    """Bucket-directory layout: rewrite only the buckets the deltas touch.

    The touched buckets (at most ``n`` small integers) come from the deltas'
    keys; only those buckets of the base are read, merged and written at the
    new epoch, and the manifest's bucket vector is moved for them alone.
    Untouched buckets keep their files and epochs, so compaction I/O grows
    with the changes, not the table.  A purge (``now``) considers every
    bucket, since expired tombstones may sit anywhere.
    """
    vec = list(e["bucket_epochs"])
    n = len(vec)
    partial = bool(e.get("partial_images"))
    deltas = storage.read_deltas(spark, root, table, storage.delta_schema(data, partial=partial, pk=pk),
                                 after=base_e, upto=latest)
    if now is None:
        touched = sorted(r[0] for r in deltas.select(storage.bucket_of(pk, n)).distinct()
                         .collect())
    else:
        touched = list(range(n))
    base = storage.read_base_buckets(spark, root, table, storage.base_schema(data), vec,
                                     only=touched)
    read = Observation(f"deltas_{table}_{latest}")
    deltas = deltas.observe(read, F.count(F.lit(1)).alias("applied"))
    # rows replaced, counted as they are read; without a live bucket there are none
    replaced = None
    if any(vec[b] is not None for b in touched):
        replaced = Observation(f"replaced_{table}_{latest}")
        base = base.observe(replaced, F.count(F.lit(1)).alias("rows"))
    merged = Observation(f"merged_{table}_{latest}")
    # n shuffle partitions + a join on the raw key: the join's hash
    # partitioning is the bucket function, so every task writes whole
    # buckets and the write needs no exchange of its own
    with _conf(spark, "spark.sql.shuffle.partitions", str(n)):
        out = merge(base, deltas, pk, compacted_at, strategy="full", null_safe=False,
                    partial=partial)
        out = out.observe(merged, F.count(F.lit(1)).alias("rows"),
                          F.count_if(F.col(DELETED_AT).isNotNull()).alias("tombstones"))
        if now is not None:
            out = purge(out, now, retention_days)
        rows_written, written = storage.write_base_buckets(out, root, table, latest, n, pk,
                                                           clustered=True)
    before = int(e.get("row_count") or 0)
    old_rows = int(replaced.get["rows"]) if replaced else 0
    written = set(written)
    for b in touched:                     # a touched bucket left empty is NULL
        vec[b] = latest if b in written else None
    counters = {**read.get, **merged.get}
    change = manifest.entries(spark, [(table, None, None, None, None, None, latest, None,
                                       before - old_rows + rows_written, None, None, None,
                                       vec)])
    change = change.select("table", "base_epoch", "row_count", "bucket_epochs")
    manifest.update_tables(spark, root, change, last_compacted_at=str(compacted_at))
    removal.retire(spark, root, table, latest)
    dropped = removal.sweep(spark, root, table, grace_s)["deltas"]
    return {"table": table, "status": "compacted", "base_epoch": latest,
            "rows": before - old_rows + rows_written, "dropped_epochs": len(dropped),
            "buckets_rewritten": len(touched), "buckets": n,
            "applied": int(counters["applied"]), "purged": int(counters["rows"]) - rows_written,
            "tombstones_before_purge": int(counters["tombstones"])}


def tables_to_compact(spark: SparkSession, root: str) -> list[str]:
    """Names of the active tables whose latest delta is newer than their base."""
    due = manifest.read_tables(spark, root).filter(
        "status = 'active' AND latest_delta_epoch > coalesce(base_epoch, 0)")
    return sorted(r["table"] for r in due.select("table").collect())


def compact_all(spark: SparkSession, root: str, compacted_at, parallelism: int = 1,
                **kw) -> list[dict]:
    """Compact every table that needs it; each job reads its own entry.

    ``parallelism > 1`` runs that many table jobs at once (Spark schedules
    concurrent jobs from several threads), so many small tables keep a large
    cluster busy.  Each worker uses its own session (``newSession``: shared
    context and catalog, private SQL conf), so per-table settings do not
    leak; concurrent manifest publishes wait for its lock.  A failing table
    fails only itself, at any ``parallelism``: the others publish, and the
    error is reported in its result.
    """
    due = tables_to_compact(spark, root)

    def one(table):
        try:
            return compact_table(spark.newSession(), root, table, compacted_at, **kw)
        except Exception as e:  # noqa: BLE001 - reported per table
            return {"table": table, "status": f"failed: {type(e).__name__}: {e}"}
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return list(pool.map(one, due))
