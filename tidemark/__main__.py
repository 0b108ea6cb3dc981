"""Command line: ``python -m tidemark <command> ...`` (run with spark-submit
on a cluster).  Configuration is JSON:

    {"sources": {"public.orders": {"path": "...", "primary_key": ["id"],
                                   "columns": [{"name": "id", "pg_type": "bigint"}]}},
     "policy": {"exclude": [...], "tags": {...}, "policy": {...}},
     "buckets": null, "bucket_dirs": null,   # optional base layouts
     "acl": {"table_grants": "...", "column_grants": "...",   # optional (discover)
             "allow": ["analyst"], "aliases": {"analyst": "bi"}}}
"""

from __future__ import annotations

import argparse
import json
import sys


def _spark():
    from tidemark.session import get_spark
    return get_spark()


def _config(path: str | None) -> dict:
    if not path:
        return {}
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def _print(rows) -> None:
    """All rows, a partition at a time, tab-separated under the column names."""
    print("\t".join(rows.columns))
    for r in rows.select(*[rows[c].cast("string") for c in rows.columns]).toLocalIterator():
        print("\t".join("" if v is None else v for v in r))


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tidemark")
    sub = p.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("init", help="snapshot included tables to base epoch 0")
    a.add_argument("--root", required=True)
    a.add_argument("--config", required=True)
    a = sub.add_parser("discover", help="show the table policy decisions")
    a.add_argument("--config", required=True)
    a = sub.add_parser("compact", help="merge deltas into new bases")
    a.add_argument("--root", required=True)
    a.add_argument("--compacted-at", required=True, help="UTC time stamped on deletes")
    a.add_argument("--now", help="purge tombstones older than the retention at this time")
    a.add_argument("--retention-days", type=int, default=30)
    a.add_argument("--parallelism", type=int, default=1)
    a.add_argument("--grace", type=float, default=0.0, help="seconds that replaced files stay for readers")
    a.add_argument("--keep-bases", type=int, help="published bases that stay (default: all)")
    a = sub.add_parser("sweep", help="remove replaced files that no reader has pinned")
    a.add_argument("--root", required=True)
    a.add_argument("--grace", type=float, default=0.0)
    a = sub.add_parser("view", help="publish a table's live rows as a view in the catalog")
    a.add_argument("--root", required=True)
    a.add_argument("--table", required=True)
    a.add_argument("--db", required=True)
    a = sub.add_parser("status", help="manifest summary")
    a.add_argument("--root", required=True)
    a = sub.add_parser("stream", help="change events -> epoch deltas")
    a.add_argument("--root", required=True)
    source = a.add_mutually_exclusive_group(required=True)
    source.add_argument("--landing", help="folder where event files land")
    source.add_argument("--log", help="folder of log segments, read by position")
    a.add_argument("--rows", type=int, default=1000, help="most events of an epoch (--log)")
    a.add_argument("--wait", type=float, default=10.0, help="seconds that an event waits for more (--log)")
    a.add_argument("--start", type=int, help="place after which a new stream begins (--log)")
    a.add_argument("--views-db", help="publish the live views of changed tables there after each epoch")
    a.add_argument("--checkpoint", required=True)
    a.add_argument("--format", default="parquet")
    a.add_argument("--max-files", type=int)
    a.add_argument("--source-columns", help="Parquet table (table, column, pg_type, nullable, ordinal) of the "
                                            "source's columns, read for each batch")
    a.add_argument("--interval", help="processing-time trigger, e.g. '10 seconds'")
    a = sub.add_parser("register", help="register current bases in the catalog")
    a.add_argument("--root", required=True)
    a.add_argument("--db", required=True)
    args = p.parse_args(argv)
    spark = _spark()

    if args.cmd == "init":
        from tidemark.plans.snapshot_init import init_tables
        cfg = _config(args.config)
        acl = cfg.get("acl")
        if acl:
            acl = {"table_grants": spark.read.parquet(acl["table_grants"]),
                   "column_grants": spark.read.parquet(acl["column_grants"]),
                   "allow": acl.get("allow", [])}
        t = init_tables(spark, args.root, cfg["sources"], cfg.get("policy"), cfg.get("buckets"),
                        bucket_dirs=cfg.get("bucket_dirs"), acl=acl)
        _print(t.select("table", "status", "row_count", "reason").orderBy("table"))
    elif args.cmd == "discover":
        from tidemark.operators.policy import policy_totals, resolve_policy
        cfg = _config(args.config)
        pol = cfg.get("policy", {})
        names = spark.createDataFrame([(t,) for t in sorted(cfg["sources"])], "table string")
        r = resolve_policy(names, pol.get("exclude"), pol.get("tags"), pol.get("policy"))
        _print(r.orderBy("table"))
        policy_totals(r).show()
        acl = cfg.get("acl")
        if acl:     # grants exported from the source's information schema
            from tidemark.operators.acl import role_profiles, with_aliases
            prof = role_profiles(spark.read.parquet(acl["table_grants"]),
                                 spark.read.parquet(acl["column_grants"]), acl.get("allow", []))
            _print(with_aliases(prof, acl.get("aliases", {}))
                   .select("display", "table", "all_columns", "columns").orderBy("display", "table"))
    elif args.cmd == "compact":
        from tidemark.plans.compaction import compact_all
        kw = {"now": args.now, "retention_days": args.retention_days} if args.now else {}
        kw |= {"grace_s": args.grace, "keep_bases": args.keep_bases}
        for res in compact_all(spark, args.root, args.compacted_at,
                               parallelism=args.parallelism, **kw):
            print(json.dumps(res))
    elif args.cmd == "sweep":
        from tidemark.plans.removal import sweep
        from tidemark.sources import manifest
        names = manifest.read_tables(spark, args.root).where("status = 'active'").select("table").collect()
        for t in sorted(r["table"] for r in names):
            print(json.dumps({"table": t, **sweep(spark, args.root, t, args.grace)}))
    elif args.cmd == "view":
        from tidemark.plans.registration import publish_live_view
        print(publish_live_view(spark, args.root, args.table, args.db))
    elif args.cmd == "status":
        from tidemark.operators.health import status
        from tidemark.sources import manifest
        header = manifest.read_header(spark, args.root)
        row = status(manifest.read_tables(spark, args.root), detail=True,
                     last_compacted=header.get("last_compacted_at")).collect()[0]
        print(json.dumps({**row.asDict(), **header}, default=str))
    elif args.cmd == "stream":
        from tidemark.streaming.epochs import EpochWriter, change_stream, stream_to_epochs
        trigger = {"processingTime": args.interval} if args.interval else None
        published = None
        if args.views_db:
            from tidemark.plans.registration import publish_live_view

            def published(s, tables):
                for t in tables:
                    publish_live_view(s, args.root, t, args.views_db)
        w = EpochWriter.from_manifest(spark, args.root, checkpoint=args.checkpoint,
                                      source_columns=args.source_columns, published=published)
        if args.log:
            from tidemark.sources.log import log_stream
            events = log_stream(spark, args.log, args.checkpoint, args.rows, args.wait, args.start)
        else:
            events = change_stream(spark, args.landing, args.format, args.max_files)
        q = stream_to_epochs(events, w, args.checkpoint, trigger)
        q.awaitTermination()
    elif args.cmd == "register":
        from tidemark.plans.registration import register_all
        for res in register_all(spark, args.root, args.db):
            print(json.dumps(res))
    return 0


if __name__ == "__main__":
    sys.exit(main())
