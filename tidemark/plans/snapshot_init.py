"""Initial load: resolve the table policy, snapshot every included table to
its base at epoch 0, publish the manifest (active and excluded tables).

Order per table: typed snapshot scan (executors read and write) -> base
epoch 0 -> row count from the write's observation.  The manifest is
published once, after every base exists.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.names import truncate_version
from tidemark.functions.types import category, parse_pg_type
from tidemark.operators.acl import role_profiles
from tidemark.operators.policy import resolve_policy
from tidemark.plans.handover import snapshot_in_ranges
from tidemark.sources import manifest, storage
from tidemark.sources.snapshot import snapshot_scan


def _entry_columns(cols: list[dict]) -> list[dict]:
    out = []
    for c in cols:
        _, p, s, _ = parse_pg_type(c["pg_type"])
        out.append({"name": c["name"], "pg_type": c["pg_type"],
                    "parquet_type": category(c["pg_type"]),
                    "nullable": c.get("nullable", True), "precision": p, "scale": s})
    return out


def init_tables(spark: SparkSession, root: str, sources: dict[str, dict],
                policy: dict | None = None, buckets: int | None = None,
                source_name: str = "source", bucket_dirs: int | None = None,
                acl: dict | None = None, source_info: dict | None = None,
                parallelism: int = 4, position=None) -> DataFrame:
    """Snapshot the included tables; returns the published manifest entries.

    ``sources``: qualified table -> {"columns": [...], "primary_key": [...],
    "path": parquet path} or {"jdbc": {...options}}.  Tables without a
    primary key are excluded (reason ``no primary key``).  Layout: plain,
    Spark-bucketed (``buckets``) or bucket directories (``bucket_dirs``).

    ``position()``, the source's current log position, makes the entries say which changes
    their snapshot holds (``plans.handover``): of each table as a whole, or, where a source
    has ``"ranges"`` (ascending first-key values that cut the table), range by range.

    ``parallelism`` tables are loaded at once.  ``source_info`` goes into the
    header's source: ``server_version`` (cut before its build remark),
    ``init_lsn`` and ``init_time`` of the snapshot.

    ``acl`` (optional): {"table_grants": DF, "column_grants": DF, "allow":
    [...]} -> role profiles written beside the manifest by Spark
    (``_manifest/roles``), their role count in the header.  As in the
    source tool, a failure there is a warning, not a failed load.
    """
    policy = policy or {}
    names = spark.createDataFrame([(t,) for t in sorted(sources)], "table string")
    resolved = resolve_policy(names, policy.get("exclude"), policy.get("tags"),
                              policy.get("policy"))
    # one small row per source table (the catalog), not table data
    decisions = {r["table"]: r for r in resolved.collect()}

    def load(t: str) -> tuple:
        src, r = sources[t], decisions[t]
        pk = list(src.get("primary_key") or [])
        included, reason = r["included"], r["reason"]
        if included and not pk:
            included, reason = False, "no primary key"
        count, vec, chunks = None, None, None
        if included and position and src.get("ranges"):
            if buckets or bucket_dirs:
                raise ValueError("a snapshot in ranges has the plain layout")
            count, chunks = snapshot_in_ranges(spark, root, t, src["columns"], pk, src["ranges"], position,
                                               src.get("read"), src.get("path"), src.get("jdbc"))
        elif included:
            low = position() if position else (source_info or {}).get("init_lsn")
            df = snapshot_scan(spark, src["columns"], path=src.get("path"), jdbc=src.get("jdbc"))
            df = df.withColumn("__deleted_at", F.lit(None).cast("timestamp_ntz"))
            if bucket_dirs:
                count, written = storage.write_base_buckets(df, root, t, 0, bucket_dirs, pk)
                written = set(written)
                vec = [0 if b in written else None for b in range(bucket_dirs)]
            else:
                count = storage.write_base(df, root, t, 0, buckets=buckets, pk=pk)
            if low:
                chunks = [{"from_key": None, "low": low, "high": position() if position else low}]
        return (t, "active" if included else "excluded", list(r["tags"] or []), pk, 1,
                _entry_columns(src["columns"]), 0 if included else None,
                0 if included else None, count, storage.table_root(root, t),
                reason, buckets if included and not bucket_dirs else None, vec, None, None, None, chunks)
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        rows = list(pool.map(load, sorted(sources)))
    entries = manifest.entries(spark, rows)
    info = dict(source_info or {})
    if info.get("server_version"):
        info["server_version"] = spark.range(1).select(
            truncate_version(F.lit(info["server_version"]))).first()[0]
    header = {"source": {"name": source_name, **info}}
    if acl:
        try:
            prof = role_profiles(acl["table_grants"], acl["column_grants"], acl.get("allow", []))
            prof.write.mode("overwrite").json(f"{root.rstrip('/')}/_manifest/roles")
            header["roles"] = spark.read.json(f"{root.rstrip('/')}/_manifest/roles") \
                .select("role").distinct().count() if prof.take(1) else 0
        except Exception as e:  # noqa: BLE001 - profiles are optional
            header["roles_error"] = f"{type(e).__name__}: {e}"[:500]
    manifest.publish(spark, root, entries, **header)
    return manifest.read_tables(spark, root)
