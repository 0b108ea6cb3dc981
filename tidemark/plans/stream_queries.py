"""Streaming queries: text events landing as files -> epoch deltas."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.constants import EPOCH
from tidemark.functions.lsn import long_to_lsn
from tidemark.functions.types import category, struct_for
from tidemark.operators.events import decode_events
from tidemark.operators.health import table_ledger
from tidemark.operators.merge import live, merge
from tidemark.plans import oracle as O
from tidemark.plans.feeds import (COMPACTED_AT, EPOCH_ORIGIN, NOTE_FROM_EPOCH, ORDERS_PK, ORDERS_TABLE,
                                  ORDERS_TEXT_COLUMNS, lsn_number, orders_base, text_feed)
from tidemark.plans import compaction, consumer
from tidemark.plans.registry import query
from tidemark.plans.snapshot_init import init_tables
from tidemark.plans.storage_queries import SOURCE_ORDERS_COLUMNS
from tidemark.session import fresh_dir
from tidemark.sources import manifest, positions, storage
from tidemark.sources.log import log_stream
from tidemark.streaming.epochs import EpochWriter, change_stream, stream_to_epochs
from tidemark.streaming.published import drain_changes

RESUME_SPLIT = 15


def _day():
    return F.datediff(F.to_date("ts"), F.lit(EPOCH_ORIGIN)) + 1

_DAY_SQL = f"(date_diff('day', DATE '{EPOCH_ORIGIN}', CAST(ts AS DATE)) + 1)"


def _init_manifest(spark, root, tables=(ORDERS_TABLE,)):
    cols = [{"name": c["name"], "pg_type": c["pg_type"], "parquet_type": category(c["pg_type"]),
             "nullable": c["nullable"], "precision": None, "scale": None}
            for c in ORDERS_TEXT_COLUMNS]
    entry = manifest.entries(spark, [(t, "active", [], ORDERS_PK, 1, cols, 0, 0, 0,
                                      f"{root}/{t}", "", None) for t in tables])
    manifest.publish(spark, root, entry, source={"name": "orders-db"})


def _run(spark, root, landing, checkpoint, **kw):
    w = EpochWriter.from_manifest(spark, root, checkpoint=checkpoint, **kw)
    q = stream_to_epochs(change_stream(spark, landing), w, checkpoint)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return w


def _streamed(spark, d, name, split=None, with_note=False, **kw):
    root = fresh_dir(spark, name)
    landing, ckpt = f"{root}/_landing", f"{root}/_checkpoint"
    _init_manifest(spark, root)
    events = text_feed(spark, d, with_note=with_note)
    parts = [events] if split is None else [events.filter(_day() < split),
                                            events.filter(_day() >= split)]
    w = None
    for p in parts:   # each part lands, then the stream (re)starts and drains it
        p.write.mode("append").parquet(landing)
        w = _run(spark, root, landing, ckpt, **kw)
    return root, w


def _decoded_sql(epoch_case: str, note: bool = False) -> str:
    typed = ",\n       ".join(f"TRY_CAST({c} AS {t}) AS {c}" for c, t in O.TEXT_TYPES)
    extra = (f",\n       CASE WHEN op <> 'D' AND {_DAY_SQL} >= {NOTE_FROM_EPOCH} "
             f"THEN props END AS note") if note else ""
    return f"""WITH t AS (SELECT x.*, e.props FROM ({O.TEXT_FEED}) x JOIN events e ON e.event_id = x.seq)
SELECT op AS __op, seq AS __seq, lsn AS __lsn, ts AS __ts,
       {typed}{extra},
       CAST({epoch_case} AS BIGINT) AS __epoch
FROM t"""


@query("stream_to_epochs", _decoded_sql("1"))
def stream_to_epochs_q(spark, d):
    root, _ = _streamed(spark, d, "stream_to_epochs")
    return storage.read_deltas(spark, root, ORDERS_TABLE,
                               storage.delta_schema(struct_for(ORDERS_TEXT_COLUMNS)))


@query("stream_resume", _decoded_sql(f"CASE WHEN {_DAY_SQL} < {RESUME_SPLIT} THEN 1 ELSE 2 END"))
def stream_resume(spark, d):
    """Two runs on one checkpoint: the second resumes and gets epoch 2."""
    root, _ = _streamed(spark, d, "stream_resume", split=RESUME_SPLIT)
    e = manifest.entry(spark, root, ORDERS_TABLE)
    assert e["latest_delta_epoch"] == 2, e
    return storage.read_deltas(spark, root, ORDERS_TABLE,
                               storage.delta_schema(struct_for(ORDERS_TEXT_COLUMNS)))


@query("stream_evolution", _decoded_sql(
    f"CASE WHEN {_DAY_SQL} < {NOTE_FROM_EPOCH} THEN 1 ELSE 2 END", note=True))
def stream_evolution(spark, d):
    """Batch 2 carries a new ``note`` key: confirmed by the source catalog,
    appended to the schema (version 2), written from epoch 2 on."""
    root, w = _streamed(spark, d, "stream_evolution", split=NOTE_FROM_EPOCH, with_note=True,
                        source_columns={ORDERS_TABLE: SOURCE_ORDERS_COLUMNS})
    e = manifest.entry(spark, root, ORDERS_TABLE)
    assert e["schema_version"] == 2, e
    cols = [{"name": c["name"], "pg_type": c["pg_type"]} for c in e["columns"]]
    return storage.read_deltas(spark, root, ORDERS_TABLE, storage.delta_schema(struct_for(cols)))


# Deliveries of one log in overlapping cuts: the first day and the last day of each.
DELIVERIES = ((1, 9), (6, 19), (1, 24), (1, 31))
_FIRST_DELIVERY = "CASE " + " ".join(
    f"WHEN {_DAY_SQL} BETWEEN {a} AND {b} THEN {i}" for i, (a, b) in enumerate(DELIVERIES, 1)) + " END"


def _redelivered(spark, d, name):
    """The feed delivered in overlapping cuts, every fifth event twice within the first."""
    root = fresh_dir(spark, name)
    _init_manifest(spark, root)
    events = text_feed(spark, d)
    for i, (a, b) in enumerate(DELIVERIES):
        part = events.filter(_day().between(a, b))
        if not i:
            part = part.unionByName(part.where("seq % 5 = 0"))
        part.write.mode("append").parquet(f"{root}/_landing")
        _run(spark, root, f"{root}/_landing", f"{root}/_checkpoint")
    return root


@query("stream_redelivery", f"SELECT * FROM ({_decoded_sql(_FIRST_DELIVERY)}) WHERE __epoch IS NOT NULL")
def stream_redelivery(spark, d):
    """A log delivered again in other cuts gives each change once, in the
    epoch that it first arrived in."""
    root = _redelivered(spark, d, "stream_redelivery")
    return storage.read_deltas(spark, root, ORDERS_TABLE, storage.delta_schema(struct_for(ORDERS_TEXT_COLUMNS)))


@query("delivery_ledger", " UNION ALL ".join(
    f"""SELECT CAST({i} AS BIGINT) AS epoch, '{ORDERS_TABLE}' AS "table", count(*) AS landed,
       count(*) FILTER ({_FIRST_DELIVERY} = {i}) AS written, count(*) FILTER ({_FIRST_DELIVERY} < {i}) AS replayed,
       CAST(0 AS BIGINT) AS in_snapshot, min(event_id) AS first_seq, max(event_id) AS last_seq
FROM events WHERE {_DAY_SQL} BETWEEN {a} AND {b}""" for i, (a, b) in enumerate(DELIVERIES, 1)))
def delivery_ledger(spark, d):
    """Events landed, written and replayed per epoch of the same deliveries."""
    return positions.delivery_ledger(spark, _redelivered(spark, d, "delivery_ledger")).select(
        "epoch", "table", "landed", "written", "replayed", "in_snapshot", "first_seq", "last_seq")


# Ranges of the snapshot taken while the feed runs: each begins at a quarter of the keys, is read
# at (i + 1) / 6 of the events and has its positions taken a fortieth before and after.
RANGES = 4
_MARKS = ("(SELECT max(o_orderkey) + 1 AS keys FROM orders)", "(SELECT max(event_id) + 1 AS n FROM events)")
_LOW = f"((least(k * {RANGES} // keys, {RANGES - 1}) + 1) * n // 6 - n // 40)"


def _snapshot_while_streaming(spark, d, name):
    """Snapshot of orders in key ranges, at moving positions; then the stream from the first event."""
    root = fresh_dir(spark, name)
    events = text_feed(spark, d)
    keys, n = (x.collect()[0][0] + 1 for x in (orders_base(spark, d).agg(F.max("o_orderkey")), events.agg(F.max("seq"))))
    data = storage.base_schema(struct_for(ORDERS_TEXT_COLUMNS))
    base = orders_base(spark, d)
    base = base.select(*[(F.col(f.name) if f.name in base.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                         for f in data.fields])
    reads = [(i + 1) * n // 6 for i in range(RANGES)]
    clock = iter([seq for at in reads for seq in (at - n // 40, at + n // 40)])
    now = iter(reads)

    def read(lo, hi):
        """What the source holds of a range at the time: its rows with all their changes so far."""
        within = (F.col("o_orderkey") >= (lo or 0)) & (F.col("o_orderkey") < hi if hi else F.lit(True))
        changes = decode_events(events.where(F.col("seq") <= next(now)), ORDERS_TEXT_COLUMNS).withColumn(EPOCH, F.lit(1).cast("bigint"))
        # a merge is by key, so only the range's rows and changes have to meet
        return live(merge(base.where(within), changes.where(within), ORDERS_PK, COMPACTED_AT)).drop("__deleted_at")

    def position():
        seq = next(clock)
        return spark.range(1).select(long_to_lsn(lsn_number(F.lit(seq)))).first()[0]
    init_tables(spark, root, {ORDERS_TABLE: {
        "columns": ORDERS_TEXT_COLUMNS, "primary_key": ORDERS_PK, "read": read,
        "ranges": [i * keys // RANGES for i in range(1, RANGES)]}}, position=position, parallelism=1)
    _stream_all(spark, root, events)
    return root


@query("snapshot_handover", f"""WITH base AS (
  SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice, CAST(NULL AS INTEGER) AS o_quantity,
         CAST(NULL AS TIMESTAMP) AS __deleted_at FROM orders),
feed AS (SELECT * FROM ({_decoded_sql("1")})),
{O.merge_ctes("m", "base", "feed", data=["o_orderstatus", "o_totalprice", "o_quantity"])}
SELECT o_orderkey, o_orderstatus, o_totalprice, o_quantity FROM m WHERE __deleted_at IS NULL""")
def snapshot_handover(spark, d):
    """A snapshot in four key ranges, read at different positions while changes
    run, and the stream from before the first, give the source's end state."""
    root = _snapshot_while_streaming(spark, d, "snapshot_handover")
    return live(consumer.as_of(spark, root, ORDERS_TABLE, 1, COMPACTED_AT)).select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_quantity")


@query("snapshot_ledger", f"""WITH f AS (
  SELECT event_id, {O._KEY_A} AS k, {O.lsn_text(O.LSN_N)} AS lsn FROM events),
x AS (SELECT f.*, event_id <= {_LOW} AS held FROM f, {_MARKS[0]}, {_MARKS[1]}),
s AS (SELECT {O.lsn_text(O.LSN_N)} AS lsn FROM (SELECT n // 6 - n // 40 AS event_id FROM {_MARKS[1]}))
SELECT '{ORDERS_TABLE}' AS "table", s.lsn AS snapshot_lsn, max(x.event_id) AS last_seq, count(*) AS landed,
       count(*) FILTER (NOT held) AS written, count(*) FILTER (held) AS in_snapshot,
       arg_max(x.lsn, x.event_id) FILTER (NOT held) AS last_lsn FROM x, s GROUP BY s.lsn""")
def snapshot_ledger(spark, d):
    """The snapshot's stored position, and how many changes it held already."""
    root = _snapshot_while_streaming(spark, d, "snapshot_ledger")
    deltas = storage.read_deltas(spark, root, ORDERS_TABLE, storage.delta_schema(struct_for(ORDERS_TEXT_COLUMNS)))
    ledger = table_ledger(deltas.withColumn("table", F.lit(ORDERS_TABLE)), tables=manifest.read_tables(spark, root))
    return ledger.join(positions.delivery_ledger(spark, root), "table").select(
        "table", "snapshot_lsn", "last_seq", "landed", "written", "in_snapshot", "last_lsn")


@query("stream_consumer", _decoded_sql(f"CASE WHEN {_DAY_SQL} < 10 THEN 1 WHEN {_DAY_SQL} < 20 THEN 2 ELSE 3 END"))
def stream_consumer(spark, d):
    """A consumer's stream of published epochs, drained before and after a
    compaction, delivers each change once."""
    root = fresh_dir(spark, "stream_consumer")
    _init_manifest(spark, root)
    events = text_feed(spark, d)

    def land(part):
        part.write.mode("append").parquet(f"{root}/_landing")
        _run(spark, root, f"{root}/_landing", f"{root}/_checkpoint")

    def take(changes, number):
        changes.write.mode("overwrite").parquet(f"{root}/_taken/batch={number}")

    def drain():
        drain_changes(spark, root, ORDERS_TABLE, take, f"{root}/_consumer")
    land(events.filter(_day() < 10))
    land(events.filter(_day().between(10, 19)))
    drain()
    compaction.compact_table(spark, root, ORDERS_TABLE, COMPACTED_AT)
    land(events.filter(_day() >= 20))
    drain()
    return spark.read.parquet(f"{root}/_taken").drop("batch", "__unchanged", "__moved_from")


_CAP = "greatest(1000, n // 8)"
_COUNT = "(SELECT max(event_id) + 1 AS n FROM events)"


@query("stream_row_cap", f"""SELECT CAST((event_id - n // 5 - 1) // {_CAP} + 1 AS BIGINT) AS epoch, count(*) AS events,
       min(event_id) AS first_seq, max(event_id) AS last_seq
FROM events, {_COUNT} WHERE event_id > n // 5 GROUP BY ALL""")
def stream_row_cap(spark, d):
    """A log read by position: from a given place on, at most so many events an
    epoch, going on in the middle of a segment after each of two restarts."""
    root = fresh_dir(spark, "stream_row_cap")
    _init_manifest(spark, root)
    log, ckpt = f"{root}/_log", f"{root}/_checkpoint"
    events = text_feed(spark, d)
    n = events.agg(F.max("seq")).collect()[0][0] + 1
    events.repartitionByRange(7, "seq").sortWithinPartitions("seq").write.parquet(log)
    for run in range(3):
        writer = EpochWriter.from_manifest(spark, root, checkpoint=ckpt)
        source = log_stream(spark, log, ckpt, rows=max(1000, n // 8), interval=0, start=n // 5)
        if run < 2:    # one batch, then the stream ends
            stream_to_epochs(source, writer, ckpt).awaitTermination()
        else:
            q = stream_to_epochs(source, writer, ckpt, {"processingTime": "0 seconds"})
            q.processAllAvailable()
            q.stop()
    schema = storage.delta_schema(struct_for(ORDERS_TEXT_COLUMNS))
    return storage.read_deltas(spark, root, ORDERS_TABLE, schema).groupBy(F.col(EPOCH).alias("epoch")).agg(
        F.count(F.lit(1)).alias("events"), F.min("__seq").alias("first_seq"), F.max("__seq").alias("last_seq"))


# The tables of the routed stream.
STREAM_TABLES = ("public.orders", "public.page_views", "public.payments")
_ROUTE_SQL = """CASE WHEN o_orderstatus IN ('view', 'click') THEN 'public.page_views'
            WHEN o_orderstatus = 'purchase' THEN 'public.payments' ELSE 'public.orders' END"""


def _stream_all(spark, root, events):
    """Land ``events`` and drain them into ``root``."""
    events.write.parquet(f"{root}/_landing")
    _run(spark, root, f"{root}/_landing", f"{root}/_checkpoint")


@query("stream_many_tables", f"""SELECT {_ROUTE_SQL} AS "table", * FROM ({_decoded_sql("1")})""")
def stream_many_tables(spark, d):
    """R2 P5: one batch holds three tables; it is read once, each table gets its deltas."""
    root = fresh_dir(spark, "stream_many_tables")
    _init_manifest(spark, root, STREAM_TABLES)
    status = F.element_at("row", "o_orderstatus")
    _stream_all(spark, root, text_feed(spark, d).withColumn(
        "table", F.when(status.isin("view", "click"), "public.page_views")
                  .when(status == "purchase", "public.payments").otherwise("public.orders")))
    schema = storage.delta_schema(struct_for(ORDERS_TEXT_COLUMNS))
    parts = [storage.read_deltas(spark, root, t, schema).select(F.lit(t).alias("table"), "*")
             for t in STREAM_TABLES]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_BAD_SEQ = f"CASE WHEN seq % 19 = 0 THEN {O.LSN_N.replace('event_id', 'seq')} ELSE seq END"
_BAD_VALUES = "\nUNION ALL\n".join(
    f"SELECT 'reject' AS kind, '{c}' AS name, s FROM t WHERE {c} IS NOT NULL AND TRY_CAST({c} AS {ty}) IS NULL"
    for c, ty in O.TEXT_TYPES if c != "o_orderkey")


@query("stream_bad_keys", f"""WITH f AS ({O.TEXT_FEED}),
t AS (SELECT *, {_BAD_SEQ} AS s, seq % 19 = 0 AND seq % 23 = 0 AS lost,
             seq % 13 = 0 OR seq % 17 = 0 AS no_key FROM f),
r AS (SELECT 'delta' AS kind, op AS name, s FROM t WHERE NOT no_key AND NOT lost
UNION ALL SELECT 'reject', 'o_orderkey', CASE WHEN NOT lost THEN s END FROM t WHERE no_key
UNION ALL SELECT 'reject', '__seq', NULL FROM t WHERE lost
UNION ALL SELECT kind, name, CASE WHEN NOT lost THEN s END FROM ({_BAD_VALUES.replace("s FROM t", "s, lost FROM t")}))
SELECT kind, name, count(*) AS events, CAST(sum(s) AS BIGINT) AS seqs FROM r GROUP BY kind, name""")
def stream_bad_keys(spark, d):
    """Changes with an unreadable or absent key, or without a place in the
    order, become rejects; events without a number are ordered by log position."""
    root = fresh_dir(spark, "stream_bad_keys")
    _init_manifest(spark, root)
    n = F.col("event_id")
    key = lambda k, v: F.when(k != "o_orderkey", v).when(n % 13 == 0, "bad").when(n % 17 != 0, v)
    feed = text_feed(spark, d).withColumn("event_id", F.col("seq"))
    _stream_all(spark, root, feed.select(
        "table", "op", F.transform_values("row", key).alias("row"),
        F.when((n % 19 == 0) & (n % 23 == 0), "nowhere").otherwise(F.col("lsn")).alias("lsn"), "ts",
        F.when(n % 19 != 0, F.col("seq")).alias("seq")))
    schema = storage.delta_schema(struct_for(ORDERS_TEXT_COLUMNS))
    kept = storage.read_deltas(spark, root, ORDERS_TABLE, schema) \
        .select(F.lit("delta").alias("kind"), F.col("__op").alias("name"), F.col("__seq").alias("seq"))
    bad = storage.read_rejects(spark, root, ORDERS_TABLE) \
        .select(F.lit("reject").alias("kind"), F.col("column_name").alias("name"), "seq")
    return kept.unionByName(bad).groupBy("kind", "name").agg(
        F.count(F.lit(1)).alias("events"), F.sum("seq").alias("seqs"))


_PARTIAL_COLS = ("o_orderstatus", "o_totalprice", "o_quantity")
_PARTIAL_IMG = ",\n".join(
    f"""i_{c} AS (SELECT k, {c} FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY seq DESC) AS rn
    FROM ev WHERE op IN ('I', 'U'){" AND NOT unsent" if c == "o_totalprice" else ""}) WHERE rn = 1)"""
    for c in _PARTIAL_COLS)


@query("compact_partial_stream", f"""WITH f AS ({O.TEXT_FEED}),
x AS (SELECT f.*, CAST(f.o_orderkey AS BIGINT) AS k0, e.event_type = 'purchase' AND f.seq % 5 = 0 AS moved,
             old.o_totalprice AS old_price
      FROM f JOIN events e ON e.event_id = f.seq LEFT JOIN orders old ON old.o_orderkey = CAST(f.o_orderkey AS BIGINT) + 1),
ev AS (  -- a moved row's price is that under its old key, which no other change touches
  SELECT k0 AS k, op, seq, op = 'U' AND seq % 3 = 0 AND NOT moved AS unsent, o_orderstatus,
         CASE WHEN NOT (op = 'U' AND seq % 3 = 0) THEN TRY_CAST(o_totalprice AS DECIMAL(12,2))
              WHEN moved THEN CAST(old_price AS DECIMAL(12,2)) END AS o_totalprice,
         TRY_CAST(o_quantity AS INTEGER) AS o_quantity FROM x
  UNION ALL SELECT k0 + 1, 'D', seq, FALSE, NULL, NULL, NULL FROM x WHERE moved),
l AS (SELECT k, op AS last_op FROM (
        SELECT *, row_number() OVER (PARTITION BY k ORDER BY seq DESC) AS rn FROM ev) WHERE rn = 1),
{_PARTIAL_IMG},
z AS (SELECT l.k, l.last_op, s.k IS NOT NULL AS changed, s.o_orderstatus, p.k IS NOT NULL AS has_price,
             p.o_totalprice, q.o_quantity
      FROM l LEFT JOIN i_o_orderstatus s ON s.k = l.k LEFT JOIN i_o_totalprice p ON p.k = l.k
      LEFT JOIN i_o_quantity q ON q.k = l.k)
SELECT coalesce(b.o_orderkey, z.k) AS o_orderkey,
       CASE WHEN z.changed THEN z.o_orderstatus ELSE b.o_orderstatus END AS o_orderstatus,
       CASE WHEN z.has_price THEN z.o_totalprice ELSE CAST(b.o_totalprice AS DECIMAL(12,2)) END AS o_totalprice,
       CASE WHEN z.changed THEN z.o_quantity END AS o_quantity,
       CASE WHEN z.last_op = 'D' THEN TIMESTAMP '{COMPACTED_AT}' END AS __deleted_at
FROM (SELECT *, TRUE AS in_base FROM orders) b FULL OUTER JOIN z ON b.o_orderkey = z.k
WHERE b.in_base OR coalesce(z.changed, FALSE)""")
def compact_partial_stream(spark, d):
    """D6 D7 from end to end: updates that did not send the price and purchases that
    moved their key (some both) go through the stream, the deltas and a compaction."""
    root = fresh_dir(spark, "compact_partial_stream")
    _init_manifest(spark, root)
    data = struct_for(ORDERS_TEXT_COLUMNS)
    base = orders_base(spark, d)
    storage.write_base(base.select(*[
        (F.col(f.name) if f.name in base.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in storage.base_schema(data).fields]), root, ORDERS_TABLE, 0)
    unsent = (F.col("op") == "U") & (F.col("seq") % 3 == 0)
    feed = text_feed(spark, d, with_key_change=True)
    _stream_all(spark, root, feed.withColumn(
        "row", F.when(unsent, F.map_filter("row", lambda k, v: k != "o_totalprice")).otherwise(F.col("row")))
        .withColumn("unchanged", F.when(unsent, F.array(F.lit("o_totalprice")))))
    compaction.compact_table(spark, root, ORDERS_TABLE, COMPACTED_AT)
    df, _ = storage.read_base(spark, root, ORDERS_TABLE, storage.base_schema(data))
    return df.select("o_orderkey", *_PARTIAL_COLS, "__deleted_at")
