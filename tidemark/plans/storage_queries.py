"""Queries that write and read the table layout under the shared folder.

Each call works in a fresh directory under ``spark.checkpoint.dir`` (the
cluster-shared folder), writes with Spark, and returns a frame that reads
the written files back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.constants import EPOCH, TS
from tidemark.functions.names import truncate_version
from tidemark.functions.types import struct_for
from tidemark.operators import merge as M
from tidemark.operators import policy as P
from tidemark.operators import health as H
from tidemark.operators.schema import new_columns, unknown_columns
from tidemark.plans import compaction, removal
from tidemark.plans import oracle as O
from tidemark.plans import tenant_sql as S
from tidemark.plans import tenants as TN
from tidemark.plans.feeds import (COMPACTED_AT, NOTE_FROM_EPOCH, ORDERS_PK, ORDERS_TABLE,
                                  ORDERS_TEXT_COLUMNS, feed_a, orders_base, text_feed,
                                  with_lsn)
from tidemark.plans.registration import publish_live_view
from tidemark.plans.registry import query
from tidemark.session import fresh_dir
from tidemark.sources import catalog as C
from tidemark.sources import manifest, storage

ORDERS_COLUMNS = [{"name": "o_orderkey", "pg_type": "bigint", "nullable": False},
                  {"name": "o_orderstatus", "pg_type": "text", "nullable": True},
                  {"name": "o_totalprice", "pg_type": "double precision", "nullable": True}]
ORDERS_DATA = struct_for(ORDERS_COLUMNS)
_FEED_LSN = f"""SELECT *, {O.lsn_text(O.LSN_N.replace("event_id", "__seq"))} AS __lsn,
       CAST(NULL AS TIMESTAMP) AS __ts FROM ({O.FEED_A})"""


def _write_feed(spark, d, root, with_note=False):
    f = with_lsn(feed_a(spark, d, with_note=with_note)) \
        .withColumn(TS, F.lit(None).cast("timestamp_ntz"))
    storage.write_delta(f, root, ORDERS_TABLE)


@query("delta_roundtrip", _FEED_LSN)
def delta_roundtrip(spark, d):
    root = fresh_dir(spark, "delta_roundtrip")
    _write_feed(spark, d, root)
    _write_feed(spark, d, root)       # replaying every epoch is idempotent
    return storage.read_deltas(spark, root, ORDERS_TABLE, storage.delta_schema(ORDERS_DATA))


@query("base_roundtrip", O.merge_a_sql())
def base_roundtrip(spark, d):
    root = fresh_dir(spark, "base_roundtrip")
    merged = M.merge(orders_base(spark, d), feed_a(spark, d), ORDERS_PK, COMPACTED_AT)
    storage.write_base(merged, root, ORDERS_TABLE, 30)
    df, _ = storage.read_base(spark, root, ORDERS_TABLE, storage.base_schema(ORDERS_DATA))
    return df


@query("schema_union", f"""SELECT * EXCLUDE (note),
       CASE WHEN __epoch >= {NOTE_FROM_EPOCH} THEN note END AS note
FROM (SELECT f.*, e.props AS note FROM ({O.FEED_A}) f JOIN events e ON e.event_id = f.__seq)""")
def schema_union(spark, d):
    """Files before epoch 3 lack ``note``; read back they hold NULL there."""
    root = fresh_dir(spark, "schema_union")
    f = feed_a(spark, d, with_note=True)
    storage.write_delta(f.filter(F.col(EPOCH) < NOTE_FROM_EPOCH).drop("note"), root, ORDERS_TABLE)
    storage.write_delta(f.filter(F.col(EPOCH) >= NOTE_FROM_EPOCH), root, ORDERS_TABLE)
    evolved = struct_for(ORDERS_COLUMNS + [{"name": "note", "pg_type": "text"}])
    schema = storage.delta_schema(evolved, with_source_meta=False)
    schema = T.StructType([x for x in schema.fields if x.name != "__seq"] +
                          [T.StructField("__seq", T.LongType())])
    return storage.read_deltas(spark, root, ORDERS_TABLE, schema)


# The source's current column list for the orders table.
SOURCE_ORDERS_COLUMNS = ORDERS_TEXT_COLUMNS + [
    {"name": "o_clerk", "pg_type": "text", "nullable": True},
    {"name": "note", "pg_type": "jsonb", "nullable": True}]


@query("schema_drift", f"""SELECT DISTINCT 'public.orders' AS "table", 'note' AS column_name,
       'jsonb' AS pg_type, {len(SOURCE_ORDERS_COLUMNS)} AS ordinal
FROM events WHERE event_type <> 'error'
  AND date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 >= {NOTE_FROM_EPOCH}""")
def schema_drift(spark, d):
    """Unknown map keys in the stream, confirmed by the source catalog."""
    ev = text_feed(spark, d, with_note=True)
    unknown = unknown_columns(ev, [c["name"] for c in ORDERS_TEXT_COLUMNS]) \
        .withColumnRenamed("column", "column_name")
    src = spark.createDataFrame(
        [(ORDERS_TABLE, c["name"], c["pg_type"], i + 1) for i, c in enumerate(SOURCE_ORDERS_COLUMNS)],
        "table string, column_name string, pg_type string, ordinal int")
    return new_columns(unknown.withColumnRenamed("column_name", "column"),
                       src.withColumnRenamed("column_name", "column")) \
        .withColumnRenamed("column", "column_name")


COMPACT_UPTO = 20


def _setup_table(spark, d, root, buckets=None, bucket_dirs=None, upto=COMPACT_UPTO):
    """Base at epoch 0 (all orders), deltas for every epoch, manifest saying
    epochs up to ``upto`` are flushed (later ones still in flight; None: every
    epoch is).  ``buckets``:
    Spark-bucketed base; ``bucket_dirs``: bucket-directory layout."""
    vec, rows = None, None
    if bucket_dirs:
        rows, written = storage.write_base_buckets(orders_base(spark, d), root, ORDERS_TABLE,
                                                   0, bucket_dirs, ORDERS_PK)
        written = set(written)
        vec = [0 if b in written else None for b in range(bucket_dirs)]
    else:
        rows = storage.write_base(orders_base(spark, d), root, ORDERS_TABLE, 0,
                                  buckets=buckets, pk=ORDERS_PK)
    _write_feed(spark, d, root)
    if upto is None:
        upto = max(storage.delta_epochs(spark, root, ORDERS_TABLE))
    entry = manifest.entries(spark, [(ORDERS_TABLE, "active", [], ORDERS_PK, 1, ORDERS_COLUMNS,
                                      0, upto, rows, f"{root}/{ORDERS_TABLE}", "",
                                      buckets, vec)])
    manifest.publish(spark, root, entry, source={"name": "orders-db"})


@query("compact_cleanup", f"""SELECT __epoch, count(*) AS events FROM ({O.FEED_A})
WHERE __epoch > {COMPACT_UPTO} GROUP BY __epoch""")
def compact_cleanup(spark, d):
    """After the job only the in-flight epochs (> 20) remain on storage."""
    root = fresh_dir(spark, "compact_cleanup")
    _setup_table(spark, d, root)
    compaction.compact_all(spark, root, COMPACTED_AT)
    rest = storage.read_deltas(spark, root, ORDERS_TABLE, storage.delta_schema(ORDERS_DATA))
    return rest.groupBy(EPOCH).agg(F.count(F.lit(1)).alias("events"))


_AT_END = f"""WITH base AS ({O.ORDERS_BASE}),
feed AS ({O.FEED_A}),
{O.merge_ctes("m", "base", "feed")}
SELECT * FROM m"""


@query("compact_job", _AT_END)
def compact_job(spark, d):
    """The base the compaction job published equals the state at the last epoch."""
    root = fresh_dir(spark, "compact_job")
    _setup_table(spark, d, root, upto=None)
    res = compaction.compact_table(spark, root, ORDERS_TABLE, COMPACTED_AT)
    e = manifest.entry(spark, root, ORDERS_TABLE)
    assert e["base_epoch"] == e["latest_delta_epoch"] and e["row_count"] == res["rows"], e
    df, _ = storage.read_base(spark, root, ORDERS_TABLE, storage.base_schema(ORDERS_DATA))
    return df


COMPACT_BUCKETS = 8


@query("compact_bucketed", _AT_END)
def compact_bucketed(spark, d):
    """Compaction over a key-bucketed base: only the folded deltas shuffle."""
    root = fresh_dir(spark, "compact_bucketed")
    _setup_table(spark, d, root, buckets=COMPACT_BUCKETS, upto=None)
    res = compaction.compact_table(spark, root, ORDERS_TABLE, COMPACTED_AT)
    df, _ = storage.read_base(spark, root, ORDERS_TABLE, storage.base_schema(ORDERS_DATA),
                              buckets=COMPACT_BUCKETS, pk=ORDERS_PK)
    return df


COMPACT_BUCKET_DIRS = 64


@query("compact_touched_buckets", _AT_END)
def compact_touched_buckets(spark, d):
    """Bucket-directory layout: only buckets the deltas touch are rewritten;
    the result read back over every bucket equals the state at the last epoch."""
    root = fresh_dir(spark, "compact_touched")
    _setup_table(spark, d, root, bucket_dirs=COMPACT_BUCKET_DIRS, upto=None)
    res = compaction.compact_table(spark, root, ORDERS_TABLE, COMPACTED_AT)
    e = manifest.entry(spark, root, ORDERS_TABLE)
    assert e["row_count"] == res["rows"], (e["row_count"], res)
    return storage.read_base_buckets(spark, root, ORDERS_TABLE,
                                     storage.base_schema(ORDERS_DATA), e["bucket_epochs"])


@query("catalog_register", _AT_END)
def catalog_register(spark, d):
    """Register the current base as an external table and query it by name."""
    root = fresh_dir(spark, "catalog_register")
    _setup_table(spark, d, root, upto=None)
    compaction.compact_table(spark, root, ORDERS_TABLE, COMPACTED_AT)
    e = manifest.entry(spark, root, ORDERS_TABLE)
    schema, table = ORDERS_TABLE.split(".", 1)
    name = table if schema in ("", "public") else f"{schema}_{table}"
    cols = ORDERS_COLUMNS + [{"name": "__deleted_at", "pg_type": "timestamp"}]
    C.register_table(spark, "tidemark_cdc", name, cols,
                     f"{root}/{ORDERS_TABLE}/base/__base_epoch={e['base_epoch']}",
                     {"classification": "parquet", "cdc.source_schema": schema,
                      "cdc.source_table": table, "cdc.schema_version": str(e["schema_version"]),
                      "cdc.base_epoch": str(e["base_epoch"])})
    return spark.table(f"tidemark_cdc.{name}")


def _tenant_manifest(spark, d):
    t = TN.tenant_tables(spark, d)
    cfg = TN.POLICY_A
    r = P.resolve_policy(t, cfg["exclude"], cfg["tags"], cfg["policy"])
    has_pk = F.col("kind") != "scratch"
    status = F.when(F.col("included") & has_pk, "active").otherwise("excluded")
    reason = F.when(F.col("included") & ~has_pk, "no primary key").otherwise(F.col("reason"))
    cols = F.when((F.col("kind") == "invoices") & (F.col("c_nationkey") == 7),
                  F.lit(None)).otherwise(F.array(F.struct(
                      F.lit("id").alias("name"), F.lit("bigint").alias("pg_type"),
                      F.lit("INT64").alias("parquet_type"), F.lit(False).alias("nullable"),
                      F.lit(None).cast("int").alias("precision"),
                      F.lit(None).cast("int").alias("scale"))))
    return r.select("table", status.alias("status"), "tags",
                    F.when(has_pk, F.array(F.lit("id"))).alias("primary_key"),
                    F.lit(1).cast("bigint").alias("schema_version"), cols.alias("columns"),
                    F.col("c_nationkey").cast("bigint").alias("base_epoch"),
                    (F.col("c_nationkey") + F.col("c_custkey") % 5).cast("bigint")
                    .alias("latest_delta_epoch"),
                    (F.col("c_custkey") % 1000).cast("bigint").alias("row_count"),
                    F.concat_ws("/", F.lit("warehouse/cdc"), "table").alias("path"),
                    reason.alias("reason"))


@query("manifest_status", S.policy_sql(TN.POLICY_A) + f""",
x AS (SELECT r.*, t.kind, t.c_nationkey, t.c_custkey FROM r JOIN ({S.TENANT_TABLES}) t USING ("table")),
m AS (SELECT CASE WHEN reason = '' AND kind <> 'scratch' THEN 'active' ELSE 'excluded' END AS status,
             kind = 'invoices' AND c_nationkey = 7 AS no_schema,
             c_nationkey AS base_epoch, c_nationkey + c_custkey % 5 AS latest, c_custkey % 1000 AS row_count
      FROM x)
SELECT count(*) FILTER (WHERE status = 'active') AS active_tables,
       count(*) FILTER (WHERE status <> 'active') AS excluded_tables,
       CAST(coalesce(max(latest) FILTER (WHERE status = 'active'), 0) AS BIGINT) AS latest_epoch,
       CAST(coalesce(sum(row_count) FILTER (WHERE status = 'active'), 0) AS BIGINT) AS active_rows,
       count(*) FILTER (WHERE status = 'active' AND latest > base_epoch) AS needs_compaction,
       count(*) FILTER (WHERE status = 'active' AND no_schema) AS missing_schema,
       (SELECT count(*) FROM nation) AS role_profiles, '{COMPACTED_AT}' AS last_compacted
FROM m""")
def manifest_status(spark, d):
    """Publish the tenant manifest, read it back, summarise it."""
    root = fresh_dir(spark, "manifest_status")
    manifest.publish(spark, root, _tenant_manifest(spark, d),
                     source={"name": "tenants", "postgres_version": spark.range(1).select(
                         truncate_version(F.lit("16.2 (build 7)"))).first()[0]},
                     roles=spark.read.parquet(f"{d}/nation.parquet").count(),
                     last_compacted_at=COMPACTED_AT)
    tables, header = manifest.read_tables(spark, root), manifest.read_header(spark, root)
    assert header["source"]["postgres_version"] == "16.2", header
    return H.status(tables, roles=header["roles"], detail=True,
                    last_compacted=header["last_compacted_at"])


AS_OF_AFTER_COMPACTION = 25


@query("as_of_after_compaction", f"""WITH base AS ({O.ORDERS_BASE}),
feed AS ({O.feed_a_where(f"__epoch <= {AS_OF_AFTER_COMPACTION}")}),
{O.merge_ctes("m", "base", "feed")}
SELECT * FROM m""")
def as_of_after_compaction(spark, d):
    """K1 on storage: base 20 (compacted) + deltas 21..25 = the state at 25."""
    from tidemark.plans.consumer import as_of
    root = fresh_dir(spark, "as_of")
    _setup_table(spark, d, root)
    compaction.compact_table(spark, root, ORDERS_TABLE, COMPACTED_AT)
    manifest.update_tables(spark, root, spark.createDataFrame(     # the streamer flushed up to 30
        [(ORDERS_TABLE, 30)], "table string, latest_delta_epoch bigint"))
    try:
        as_of(spark, root, ORDERS_TABLE, 10, COMPACTED_AT)
        raise AssertionError("epoch 10 must not be addressable after compaction")
    except ValueError:
        pass
    return as_of(spark, root, ORDERS_TABLE, AS_OF_AFTER_COMPACTION, COMPACTED_AT)


@query("live_view", f"""WITH base AS ({O.ORDERS_BASE}),
feed AS ({O.FEED_A}),
{O.merge_ctes("m", "base", "feed")}
SELECT * FROM m WHERE __deleted_at IS NULL""")
def live_view_q(spark, d):
    """K4: a temp view over the compacted base and the uncompacted deltas."""
    from tidemark.plans.consumer import live_view
    root = fresh_dir(spark, "live_view")
    _setup_table(spark, d, root)
    compaction.compact_table(spark, root, ORDERS_TABLE, COMPACTED_AT)
    change = spark.createDataFrame([(ORDERS_TABLE, 30)], "table string, latest_delta_epoch bigint")
    manifest.update_tables(spark, root, change)       # the streamer flushed up to 30
    return live_view(spark, root, ORDERS_TABLE, "orders_live", COMPACTED_AT)


@query("live_view_catalog", f"""WITH base AS ({O.ORDERS_BASE}),
feed AS ({O.FEED_A}),
{O.merge_ctes("m", "base", "feed")}
SELECT o_orderkey, o_orderstatus, o_totalprice FROM m WHERE __deleted_at IS NULL""")
def live_view_catalog(spark, d):
    """A view in the catalog, read by name from a second session; published again
    after a compaction and after a further epoch."""
    root, db = fresh_dir(spark, "live_view_catalog"), f"tidemark_{uuid.uuid4().hex[:10]}"
    _setup_table(spark, d, root)
    name = publish_live_view(spark, root, ORDERS_TABLE, db)
    before = spark.newSession().table(name).count()
    compaction.compact_table(spark, root, ORDERS_TABLE, COMPACTED_AT)
    publish_live_view(spark, root, ORDERS_TABLE, db)
    second = spark.newSession()
    assert second.table(name).count() == before
    last = max(storage.delta_epochs(spark, root, ORDERS_TABLE))
    manifest.update_tables(spark, root, spark.createDataFrame(
        [(ORDERS_TABLE, last)], "table string, latest_delta_epoch bigint"))
    publish_live_view(spark, root, ORDERS_TABLE, db)
    return second.table(name)


def _unpublished_base(spark, d, root):
    """What a compaction to epoch 29 leaves on storage before it publishes: some
    rows of the new base, and its writer's work folder."""
    some = orders_base(spark, d).where("o_orderkey % 7 = 0")
    storage.write_base(some, root, ORDERS_TABLE, 29)
    storage.write_base(some, root, ORDERS_TABLE, 28)
    some.write.parquet(f"{storage.table_root(root, ORDERS_TABLE)}/base/__base_epoch=28/_temporary/0/x")


@query("live_view_during_compaction", f"""WITH base AS ({O.ORDERS_BASE}),
feed AS ({O.FEED_A}),
{O.merge_ctes("m", "base", "feed")}
SELECT * FROM m WHERE __deleted_at IS NULL""")
def live_view_during_compaction(spark, d):
    """K4 beside a running compaction: only published bases are read."""
    from tidemark.plans.consumer import live_view
    root = fresh_dir(spark, "live_view_during")
    _setup_table(spark, d, root, upto=None)
    _unpublished_base(spark, d, root)
    return live_view(spark, root, ORDERS_TABLE, "orders_live_during", COMPACTED_AT)


@query("as_of_during_compaction", f"""WITH base AS ({O.ORDERS_BASE}),
feed AS ({O.FEED_A}),
{O.merge_ctes("m", "base", "feed")}
SELECT * FROM m""")
def as_of_during_compaction(spark, d):
    """K1 beside a running compaction, after one that was published: base 20,
    every later delta."""
    from tidemark.plans.consumer import as_of
    root = fresh_dir(spark, "as_of_during")
    _setup_table(spark, d, root)
    compaction.compact_table(spark, root, ORDERS_TABLE, COMPACTED_AT)
    last = max(storage.delta_epochs(spark, root, ORDERS_TABLE))
    manifest.update_tables(spark, root, spark.createDataFrame(
        [(ORDERS_TABLE, last)], "table string, latest_delta_epoch bigint"))
    _unpublished_base(spark, d, root)
    return as_of(spark, root, ORDERS_TABLE, last, COMPACTED_AT)


@query("read_planned_before_compaction", f"""WITH base AS ({O.ORDERS_BASE}),
feed AS (SELECT * FROM ({O.FEED_A}) WHERE __epoch <= {COMPACT_UPTO}),
{O.merge_ctes("m", "base", "feed")}
SELECT * FROM m""")
def read_planned_before_compaction(spark, d):
    """A read planned on a pinned base is executed after a compaction replaced base and
    deltas; both stay until the pin is released, then a sweep takes them."""
    root = fresh_dir(spark, "planned_read")
    _setup_table(spark, d, root)
    with removal.reading(spark, root, ORDERS_TABLE) as reader:
        planned = reader.as_of(None, COMPACTED_AT, strategy="full")
        res = compaction.compact_table(spark, root, ORDERS_TABLE, COMPACTED_AT, keep_bases=1)
        assert not res["dropped_epochs"] and not res["dropped_bases"], res
        planned.write.parquet(f"{root}/_read")
    gone = removal.sweep(spark, root, ORDERS_TABLE)
    assert gone["bases"] == [0] and gone["deltas"] == list(range(1, COMPACT_UPTO + 1)), gone
    return spark.read.parquet(f"{root}/_read")


@query("storage_changes_since", f"""SELECT __epoch, __op, count(*) AS events,
       CAST(sum(o_orderkey) AS BIGINT) AS keys
FROM ({O.FEED_A}) WHERE __epoch > 22 AND __epoch <= 26 GROUP BY __epoch, __op""")
def storage_changes_since(spark, d):
    """K2 from storage: after a compaction to 20, the changes after 22 up to the
    published 26; a watermark below the base, or none, is told to pull again."""
    from tidemark.plans.consumer import ResyncRequired, changes_since
    root = fresh_dir(spark, "changes_since")
    _setup_table(spark, d, root)
    compaction.compact_table(spark, root, ORDERS_TABLE, COMPACTED_AT)
    manifest.update_tables(spark, root, spark.createDataFrame(
        [(ORDERS_TABLE, 26)], "table string, latest_delta_epoch bigint"))
    for gone in (None, 19):
        try:
            changes_since(spark, root, ORDERS_TABLE, gone)
            raise AssertionError(f"changes after {gone} are gone")
        except ResyncRequired:
            pass
    return (changes_since(spark, root, ORDERS_TABLE, 22).groupBy("__epoch", "__op")
            .agg(F.count(F.lit(1)).alias("events"), F.sum("o_orderkey").alias("keys")))


@query("manifest_updates", f"""WITH t AS ({S.TENANT_TABLES})
SELECT "table", CASE WHEN c_custkey % 2 = 0 THEN c_nationkey + c_custkey % 5 + 3
                     ELSE c_nationkey + c_custkey % 5 END AS latest_delta_epoch,
       CASE WHEN c_custkey % 3 = 0 THEN 7 ELSE c_custkey % 1000 END AS row_count FROM t
UNION ALL SELECT "table" || '_new', 4, 9 FROM t WHERE c_custkey % 4 = 0""")
def manifest_updates(spark, d):
    """Updates of a published manifest: a higher epoch, then a lower one that
    must not win, row counts, and tables the snapshot doesn't have."""
    root = fresh_dir(spark, "manifest_updates")
    t = TN.tenant_tables(spark, d)
    manifest.publish(spark, root, _tenant_manifest(spark, d), source={"name": "tenants"})
    latest = F.col("c_nationkey") + F.col("c_custkey") % 5
    even = t.where("c_custkey % 2 = 0")
    for change in (even.select("table", (latest + 3).cast("bigint").alias("latest_delta_epoch")),
                   even.select("table", (latest + 1).cast("bigint").alias("latest_delta_epoch")),
                   t.where("c_custkey % 3 = 0").select("table", F.lit(7).cast("bigint").alias("row_count")),
                   t.where("c_custkey % 4 = 0").select(
                       F.concat("table", F.lit("_new")).alias("table"),
                       F.lit(4).cast("bigint").alias("latest_delta_epoch"),
                       F.lit(9).cast("bigint").alias("row_count"))):
        manifest.update_tables(spark, root, change)
    return manifest.read_tables(spark, root).select("table", "latest_delta_epoch", "row_count")


# The source catalog of the initial load (eight test tables).
INIT_TABLES = {
    "public.region": ([("r_regionkey", "integer"), ("r_name", "text")], ["r_regionkey"]),
    "public.nation": ([("n_nationkey", "integer"), ("n_name", "text"),
                       ("n_regionkey", "integer")], ["n_nationkey"]),
    "public.customer": ([("c_custkey", "bigint"), ("c_name", "text"), ("c_nationkey", "integer"),
                         ("c_acctbal", "numeric(12,2)"), ("c_mktsegment", "text")], ["c_custkey"]),
    "public.supplier": ([("s_suppkey", "bigint"), ("s_name", "text"), ("s_nationkey", "integer"),
                         ("s_acctbal", "numeric(12,2)")], ["s_suppkey"]),
    "public.part": ([("p_partkey", "bigint"), ("p_name", "text"), ("p_size", "integer")],
                    ["p_partkey"]),
    "public.orders": ([("o_orderkey", "bigint"), ("o_custkey", "bigint"),
                       ("o_totalprice", "double precision"),
                       ("o_orderdate", "timestamp without time zone")], ["o_orderkey"]),
    "public.lineitem": ([("l_orderkey", "bigint"), ("l_linenumber", "integer"),
                         ("l_quantity", "double precision")], []),
    "public.events": ([("event_id", "bigint"), ("ts", "timestamp without time zone"),
                       ("event_type", "text")], ["event_id"]),
}
INIT_POLICY = {"exclude": ["public.supplier"],
               "tags": {"pii": ["public.customer"], "stream": ["public.event?"]},
               "policy": {"pii": "exclude"}}


def _init_sources(d):
    return {t: {"columns": [{"name": n, "pg_type": ty} for n, ty in cols], "primary_key": pk,
                "path": f"{d}/{t.split('.', 1)[1]}.parquet"}
            for t, (cols, pk) in INIT_TABLES.items()}


@query("init_snapshot", """SELECT 'public.region' AS "table", 'active' AS status,
       (SELECT count(*) FROM region) AS row_count, '' AS reason, '' AS tags
UNION ALL SELECT 'public.nation', 'active', (SELECT count(*) FROM nation), '', ''
UNION ALL SELECT 'public.customer', 'excluded', NULL, 'policy:pii', 'pii'
UNION ALL SELECT 'public.supplier', 'excluded', NULL, 'explicit exclude', ''
UNION ALL SELECT 'public.part', 'active', (SELECT count(*) FROM part), '', ''
UNION ALL SELECT 'public.orders', 'active', (SELECT count(*) FROM orders), '', ''
UNION ALL SELECT 'public.lineitem', 'excluded', NULL, 'no primary key', ''
UNION ALL SELECT 'public.events', 'active', (SELECT count(*) FROM events), '', 'stream'""")
def init_snapshot(spark, d):
    """Initial load of eight test tables: policy, key check, base epoch 0,
    manifest (S1 S2 S8 P6-P9 A7 T4)."""
    from tidemark.plans.snapshot_init import init_tables
    root = fresh_dir(spark, "init")
    t = init_tables(spark, root, _init_sources(d), INIT_POLICY)
    return t.select("table", "status", "row_count", "reason",
                    F.concat_ws(",", "tags").alias("tags"))


@query("init_base_orders", """SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate,
       CAST(NULL AS TIMESTAMP) AS __deleted_at FROM orders""")
def init_base_orders(spark, d):
    """The orders base written by the initial load, read back typed."""
    from tidemark.functions.types import struct_for
    from tidemark.plans.snapshot_init import init_tables
    root = fresh_dir(spark, "init_orders")
    init_tables(spark, root, _init_sources(d), INIT_POLICY)
    cols, _ = INIT_TABLES["public.orders"]
    data = struct_for([{"name": n, "pg_type": ty} for n, ty in cols])
    df, _ = storage.read_base(spark, root, "public.orders", storage.base_schema(data))
    return df
