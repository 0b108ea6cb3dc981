"""Decode, LSN, routing and ledger queries (text feed and routed stream)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.constants import EPOCH, LSN
from tidemark.functions.lsn import lsn_to_long
from tidemark.functions.names import epoch_name
from tidemark.functions.types import coerce
from tidemark.operators import events as EV
from tidemark.operators import health as H
from tidemark.operators import merge as M
from tidemark.plans import oracle as O
from tidemark.plans.feeds import (ACTIVE_TABLES, COMPACTED_AT, ORDER_B, ORDERS_PK,
                                  ORDERS_TEXT_COLUMNS, feed_a, feed_b, orders_base,
                                  routed_events, text_feed)
from tidemark.plans.registry import query

_typed = ",\n       ".join(f"TRY_CAST({c} AS {t}) AS {c}" for c, t in O.TEXT_TYPES)


@query("decode_typed", f"""WITH t AS ({O.TEXT_FEED})
SELECT op AS __op, seq AS __seq, lsn AS __lsn, ts AS __ts,
       {_typed}
FROM t""")
def decode_typed(spark, d):
    return EV.decode_events(text_feed(spark, d), ORDERS_TEXT_COLUMNS)


_rej = "\nUNION ALL\n".join(
    f"""SELECT seq, "table", '{c}' AS column_name, {c} AS raw FROM t
WHERE {c} IS NOT NULL AND TRY_CAST({c} AS {ty}) IS NULL""" for c, ty in O.TEXT_TYPES)


@query("decode_rejects", f"WITH t AS ({O.TEXT_FEED})\n{_rej}")
def decode_rejects(spark, d):
    return EV.decode_rejects(text_feed(spark, d), ORDERS_TEXT_COLUMNS)


@query("decode_zero_policy", f"""WITH t AS ({O.TEXT_FEED})
SELECT seq AS __seq,
       CASE WHEN o_totalprice IS NULL THEN NULL
            ELSE coalesce(TRY_CAST(o_totalprice AS DECIMAL(12,2)), 0) END AS o_totalprice,
       CASE WHEN o_urgent IS NULL THEN NULL
            ELSE coalesce(TRY_CAST(o_urgent AS BOOLEAN), FALSE) END AS o_urgent,
       CASE WHEN o_quantity IS NULL THEN NULL
            WHEN NOT regexp_full_match(o_quantity, '[+-]?[0-9]+') THEN 0
            ELSE CAST(greatest(-2147483648, least(2147483647, CAST(o_quantity AS HUGEINT))) AS INTEGER) END AS o_quantity
FROM (SELECT * REPLACE (CASE WHEN o_quantity IS NULL THEN NULL
        WHEN seq % 41 = 0 THEN CASE (seq // 41) % 4 WHEN 0 THEN '2147483648' WHEN 1 THEN '-99999999999999999999999'
          WHEN 2 THEN '7.5' ELSE '-2147483648' END ELSE o_quantity END AS o_quantity) FROM t)""")
def decode_zero_policy(spark, d):
    """The source writer's fallback: bad numbers -> 0, integers out of range -> the nearest, bad booleans -> false."""
    odd = F.element_at(F.array(*[F.lit(x) for x in ("2147483648", "-99999999999999999999999", "7.5", "-2147483648")]),
                       (F.floor(F.col("seq") / 41) % 4 + 1).cast("int"))
    t = text_feed(spark, d).withColumn("row", F.transform_values(
        "row", lambda k, v: F.when((k == "o_quantity") & (F.col("seq") % 41 == 0), odd).otherwise(v)))
    types = {c["name"]: c["pg_type"] for c in ORDERS_TEXT_COLUMNS}
    return t.select(F.col("seq").alias("__seq"), *[
        coerce(F.element_at("row", c), types[c], on_error="zero").alias(c)
        for c in ("o_totalprice", "o_urgent", "o_quantity")])


PUBLISHED_EPOCH = 25


@query("epoch_ledger", f"""WITH r AS ({O.ROUTED})
SELECT __epoch, printf('epoch=%06d', __epoch) AS file_name,
       {O.lsn_text("min(__pos)")} AS start_lsn, {O.lsn_text("max(__pos)")} AS end_lsn,
       max(__pos) - min(__pos) AS span_bytes, count(*) AS rows, CASE WHEN __epoch <= {PUBLISHED_EPOCH} THEN 'committed' ELSE 'open' END AS status
FROM r GROUP BY __epoch""")
def epoch_ledger(spark, d):
    led = H.epoch_ledger(routed_events(spark, d), published=PUBLISHED_EPOCH)
    return led.withColumn("file_name", epoch_name("epoch=", F.col(EPOCH)))


@query("latest_epoch", f"""WITH r AS ({O.ROUTED}),
l AS (SELECT __epoch, max(__pos) AS p FROM r GROUP BY __epoch)
SELECT __epoch, {O.lsn_text("p")} AS end_lsn FROM l ORDER BY __epoch DESC LIMIT 1""")
def latest_epoch(spark, d):
    """O3: the newest committed epoch and where it ended (arg-max, no sort)."""
    return H.latest_epoch(H.epoch_ledger(routed_events(spark, d)))


@query("lsn_lag", f"""WITH r AS ({O.ROUTED}),
e AS (SELECT __epoch, max(__pos) AS end_pos, max(__lsn) AS text_max FROM r GROUP BY __epoch)
SELECT __epoch, {O.lsn_text("end_pos")} AS end_lsn,
       (SELECT max(__pos) FROM r) - end_pos AS lag_bytes,
       text_max <> {O.lsn_text("end_pos")} AS text_order_wrong
FROM e""")
def lsn_lag(spark, d):
    """Bytes each epoch's last change trails the newest position.

    The newest position is a scalar subquery (one global aggregate, planned
    once); ``text_order_wrong`` flags epochs where the text maximum of the
    LSNs differs from the numeric one.
    """
    r = routed_events(spark, d).withColumn("__pos", lsn_to_long(F.col(LSN)))
    head = r.select(F.max("__pos")).scalar()
    e = r.groupBy(EPOCH).agg(F.max("__pos").alias("end_pos"),
                             F.max(LSN).alias("text_max"),
                             F.max_by(F.col(LSN), F.col("__pos")).alias("end_lsn"))
    return e.select(EPOCH, "end_lsn", (head - F.col("end_pos")).alias("lag_bytes"),
                    (F.col("text_max") != F.col("end_lsn")).alias("text_order_wrong"))


_active_sql = ", ".join(f"'{t}'" for t in ACTIVE_TABLES)


@query("events_per_epoch_table", f"""WITH r AS ({O.ROUTED})
SELECT __epoch, "table", count(*) AS events FROM r
WHERE "table" IN ({_active_sql}) GROUP BY ALL""")
def events_per_epoch_table(spark, d):
    active = spark.createDataFrame([(t,) for t in ACTIVE_TABLES], "table string")
    kept, _ = EV.route(routed_events(spark, d), active)
    return H.events_per_epoch_table(kept)


@query("route_skipped", f"""WITH r AS ({O.ROUTED})
SELECT "table", count(*) AS events, min(__epoch) AS first_epoch FROM r
WHERE "table" NOT IN ({_active_sql}) GROUP BY ALL""")
def route_skipped(spark, d):
    active = spark.createDataFrame([(t,) for t in ACTIVE_TABLES], "table string")
    _, skipped = EV.route(routed_events(spark, d), active)
    return skipped.groupBy("table").agg(F.count(F.lit(1)).alias("events"),
                                        F.min(EPOCH).alias("first_epoch"))


@query("next_epoch", f"""WITH r AS ({O.ROUTED})
SELECT CAST(coalesce(max(__epoch), 0) + 1 AS BIGINT) AS next_epoch FROM r
WHERE "table" IN ({_active_sql})""")
def next_epoch(spark, d):
    active = spark.createDataFrame([(t,) for t in ACTIVE_TABLES], "table string")
    kept, _ = EV.route(routed_events(spark, d), active)
    tables = kept.groupBy("table").agg(F.max(EPOCH).alias("latest_delta_epoch"))
    return H.next_epoch(tables)


@query("table_ledger", f"""WITH r AS ({O.ROUTED})
SELECT "table", arg_max(__epoch, __seq) AS last_epoch, arg_max(__lsn, __seq) AS last_lsn,
       count(*) AS rows, CAST(CASE WHEN "table" = 'public.orders' THEN 2 ELSE 1 END AS BIGINT) AS schema_version,
       'F/E0000000' AS snapshot_lsn
FROM r WHERE "table" IN ({_active_sql}) GROUP BY ALL
UNION ALL SELECT 'public.quiet', NULL, NULL, 0, 1, 'F/E0000000'""")
def table_ledger(spark, d):
    active = spark.createDataFrame([(t,) for t in ACTIVE_TABLES], "table string")
    kept, _ = EV.route(routed_events(spark, d), active)
    versions = {"public.orders": 2} | {t: 1 for t in ACTIVE_TABLES if t != "public.orders"} | {"public.quiet": 1}
    tables = spark.createDataFrame(list(versions.items()), "table string, schema_version bigint")
    return H.table_ledger(kept, tables=tables, snapshot_lsn="F/E0000000")


@query("compaction_ledger", f"""WITH base AS ({O.ORDERS_BASE}),
fa AS ({O.FEED_A}), fb AS ({O.FEED_B}),
{O.merge_ctes("ma", "base", "fa")},
{O.merge_ctes("mb", "base", "fb", order=O.ORDER_B)}
SELECT 'public.orders' AS "table", 30 AS base_epoch, count(*) AS rows,
       count(__deleted_at) AS tombstones FROM ma
UNION ALL
SELECT 'public.orders_b', 90, count(*), count(__deleted_at) FROM mb""")
def compaction_ledger(spark, d):
    base = orders_base(spark, d)
    ma = M.merge(base, feed_a(spark, d), ORDERS_PK, COMPACTED_AT)
    mb = M.merge(base, feed_b(spark, d), ORDERS_PK, COMPACTED_AT, order=ORDER_B)

    def tag(df, t, e):
        return df.withColumn("table", F.lit(t)).withColumn("__base_epoch", F.lit(e))
    allb = (tag(base, "public.orders", 0).unionByName(tag(ma, "public.orders", 30))
            .unionByName(tag(base, "public.orders_b", 0))
            .unionByName(tag(mb, "public.orders_b", 90)))
    return H.compaction_ledger(allb).withColumn("base_epoch", F.col("base_epoch").cast("int"))


_typed_null = ",\n       ".join(
    f"CAST(NULL AS {t}) AS {c}" for c, t in O.TEXT_TYPES if c != "o_orderkey")


@query("decode_key_change", f"""WITH t AS (
  SELECT *, {O._KEY_A.replace("user_id", "x.user_id").replace("event_id", "x.event_id")} AS k
  FROM (SELECT x.*, e.user_id, e.event_id, e.event_type AS et
        FROM ({O.TEXT_FEED}) x JOIN events e ON e.event_id = x.seq) x)
SELECT 'D' AS __op, seq AS __seq, lsn AS __lsn, ts AS __ts, k + 1 AS o_orderkey,
       {_typed_null}
FROM t WHERE et = 'purchase' AND event_id % 5 = 0
UNION ALL
SELECT op AS __op, seq AS __seq, lsn AS __lsn, ts AS __ts,
       {_typed}
FROM t""")
def decode_key_change(spark, d):
    """A moved primary key decodes as D(old key) + U(new key)."""
    ev = EV.split_key_changes(text_feed(spark, d, with_key_change=True), ["o_orderkey"])
    return EV.decode_events(ev, ORDERS_TEXT_COLUMNS)
