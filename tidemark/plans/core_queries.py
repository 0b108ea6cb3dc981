"""Merge, compaction, tombstone and delete-audit queries (feeds A and B)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import merge as M
from tidemark.operators import reads as R
from tidemark.plans import oracle as O
from tidemark.plans.feeds import (COMPACTED_AT, ORDER_B, ORDERS_PK, feed_a, feed_moves,
                                  feed_b, orders_base)
from tidemark.plans.registry import query


@query("merge_live", O.merge_a_sql("SELECT * FROM m WHERE __deleted_at IS NULL"))
def merge_live(spark, d):
    """Flagship: live view of orders after feed A (base + deltas, no tombstones)."""
    m = M.merge(orders_base(spark, d), feed_a(spark, d), ORDERS_PK, COMPACTED_AT)
    return M.live(m)


@query("compact_with_tombstones", O.merge_a_sql())
def compact_with_tombstones(spark, d):
    return M.merge(orders_base(spark, d), feed_a(spark, d), ORDERS_PK, COMPACTED_AT)


@query("compact_scale", O.merge_b_sql())
def compact_scale(spark, d):
    return M.merge(orders_base(spark, d), feed_b(spark, d), ORDERS_PK, COMPACTED_AT,
                   order=ORDER_B, strategy="full")


@query("compact_broadcast_split", O.merge_b_sql())
def compact_broadcast_split(spark, d):
    """Feed B by the broadcast split while the deltas stay within the bounds
    (true at the test scales), by the full outer join beyond."""
    return M.merge(orders_base(spark, d), feed_b(spark, d), ORDERS_PK, COMPACTED_AT,
                   order=ORDER_B, strategy="broadcast")


@query("compact_auto", O.merge_b_sql())
def compact_auto(spark, d):
    """Feed B as ``auto`` chooses: its deltas outnumber the base, so the full join."""
    return M.merge(orders_base(spark, d), feed_b(spark, d), ORDERS_PK, COMPACTED_AT,
                   order=ORDER_B, strategy="auto")


# Two-step compaction, then purge: step-1 tombstones expire, step-2 stay.
T1, T2, PURGE_NOW, SPLIT_EPOCH = ("2024-01-11 00:00:00", "2024-02-01 00:00:00",
                                  "2024-02-10 00:00:01", 10)


@query("tombstone_purge", f"""WITH base AS ({O.ORDERS_BASE}),
f1 AS ({O.feed_a_where(f"__epoch <= {SPLIT_EPOCH}")}),
f2 AS ({O.feed_a_where(f"__epoch > {SPLIT_EPOCH}")}),
{O.merge_ctes("m1", "base", "f1", stamp=T1)},
{O.merge_ctes("m2", "m1", "f2", stamp=T2)}
SELECT * FROM m2
WHERE __deleted_at IS NULL
   OR __deleted_at >= TIMESTAMP '{PURGE_NOW}' - INTERVAL 30 DAY""")
def tombstone_purge(spark, d):
    feed = feed_a(spark, d)
    m1 = M.merge(orders_base(spark, d), feed.filter(F.col("__epoch") <= SPLIT_EPOCH),
                 ORDERS_PK, T1)
    m2 = M.merge(m1, feed.filter(F.col("__epoch") > SPLIT_EPOCH), ORDERS_PK, T2)
    return M.purge(m2, PURGE_NOW, retention_days=30)


_DELETE_AUDIT_SQL = f"""WITH feed AS ({O.FEED_A})
SELECT d.o_orderkey, d.__epoch, d.__seq FROM feed d
WHERE d.__op = 'D' AND {{neg}} (
  EXISTS (SELECT 1 FROM orders b WHERE b.o_orderkey = d.o_orderkey)
  OR EXISTS (SELECT 1 FROM feed g WHERE g.o_orderkey = d.o_orderkey
             AND g.__op IN ('I', 'U')
             AND (g.__epoch < d.__epoch OR (g.__epoch = d.__epoch AND g.__seq < d.__seq))))"""


@query("delete_matched", _DELETE_AUDIT_SQL.format(neg=""))
def delete_matched(spark, d):
    a = M.delete_audit(orders_base(spark, d), feed_a(spark, d), ORDERS_PK)
    return a.filter(F.col("__applied")).select("o_orderkey", "__epoch", "__seq")


@query("delete_ignored", _DELETE_AUDIT_SQL.format(neg="NOT"))
def delete_ignored(spark, d):
    a = M.delete_audit(orders_base(spark, d), feed_a(spark, d), ORDERS_PK)
    return a.filter(~F.col("__applied")).select("o_orderkey", "__epoch", "__seq")


COUNTERS_NOW = "2024-02-05 00:00:00"


@query("compact_counters", O.merge_a_sql(f""", p AS (
  SELECT CASE WHEN o_orderkey % 2 = 0 AND __deleted_at IS NOT NULL
              THEN TIMESTAMP '2024-01-01' ELSE __deleted_at END AS __deleted_at FROM m)
SELECT
  (SELECT count(DISTINCT __epoch) FROM feed) AS deltas,
  (SELECT count(*) FROM feed) AS applied,
  (SELECT count(*) FROM feed WHERE __op = 'I') AS inserts,
  (SELECT count(*) FROM feed WHERE __op = 'U') AS updates,
  (SELECT count(*) FROM feed WHERE __op = 'D') AS deletes,
  (SELECT count(*) FROM base) AS base_rows,
  (SELECT count(*) FROM m) AS rows,
  (SELECT count(*) FROM m WHERE __deleted_at IS NOT NULL) AS tombstones,
  (SELECT count(*) FROM p WHERE __deleted_at < TIMESTAMP '{COUNTERS_NOW}' - INTERVAL 10 DAY) AS purged"""))
def compact_counters(spark, d):
    base, feed = orders_base(spark, d), feed_a(spark, d)
    merged = M.merge(base, feed, ORDERS_PK, COMPACTED_AT)
    # tombstones of even keys are older than the retention
    aged = merged.withColumn("__deleted_at", F.when(
        F.col("__deleted_at").isNotNull() & (F.col("o_orderkey") % 2 == 0),
        M.ts_literal("2024-01-01 00:00:00")).otherwise(F.col("__deleted_at")))
    return M.compaction_counters(base, feed, aged, now=COUNTERS_NOW, retention_days=10)


@query("latest_change_window", f"""WITH feed AS ({O.FEED_A})
SELECT * FROM feed f WHERE NOT EXISTS (
  SELECT 1 FROM feed g WHERE g.o_orderkey = f.o_orderkey
  AND (g.__epoch > f.__epoch OR (g.__epoch = f.__epoch AND g.__seq > f.__seq)))""")
def latest_change_window(spark, d):
    return R.latest(feed_a(spark, d), ORDERS_PK)


@query("version_history", f"""WITH feed AS ({O.FEED_A})
SELECT *, row_number() OVER w AS version, __epoch AS valid_from,
       lead(__epoch) OVER w AS valid_to
FROM feed WINDOW w AS (PARTITION BY o_orderkey ORDER BY __epoch, __seq)""")
def version_history(spark, d):
    return R.history(feed_a(spark, d), ORDERS_PK)


AS_OF_EPOCH = 15


@query("state_as_of_epoch", f"""WITH base AS ({O.ORDERS_BASE}),
feed AS ({O.feed_a_where(f"__epoch <= {AS_OF_EPOCH}")}),
{O.merge_ctes("m", "base", "feed")}
SELECT * FROM m WHERE __deleted_at IS NULL""")
def state_as_of_epoch(spark, d):
    s = R.state_as_of(orders_base(spark, d), 0, feed_a(spark, d), ORDERS_PK,
                      AS_OF_EPOCH, COMPACTED_AT)
    return M.live(s)


SINCE_EPOCH = 20


@query("changes_since_epoch", O.feed_a_where(f"__epoch > {SINCE_EPOCH}"))
def changes_since_epoch(spark, d):
    return R.changes_since(feed_a(spark, d), SINCE_EPOCH)


@query("net_changes_since", f"""WITH ev AS ({O.feed_a_where(f"__epoch > {SINCE_EPOCH}")}),
l AS (SELECT o_orderkey, __op, count(*) OVER (PARTITION BY o_orderkey) AS events,
             row_number() OVER (PARTITION BY o_orderkey ORDER BY __epoch DESC, __seq DESC) AS rn
      FROM ev),
i AS (SELECT o_orderkey, o_orderstatus, o_totalprice,
             row_number() OVER (PARTITION BY o_orderkey ORDER BY __epoch DESC, __seq DESC) AS rn
      FROM ev WHERE __op IN ('I', 'U'))
SELECT l.o_orderkey, l.__op, i.o_orderstatus, i.o_totalprice, l.events
FROM l LEFT JOIN i ON i.o_orderkey = l.o_orderkey AND i.rn = 1
WHERE l.rn = 1""")
def net_changes_since(spark, d):
    return R.net_changes_since(feed_a(spark, d), ORDERS_PK, SINCE_EPOCH)


# Two-column key whose parts contain the separator: customers 2j and 2j+1
# of a segment map to ('SEG|', 'j') and ('SEG', '|j'); joined as text with
# '|' both would read 'SEG||j|'.  Orders update / delete / insert them.
_KEY2 = ["k1", "k2"]


def _key2(custkey, segment):
    even = (custkey % 2) == 0
    k1 = F.concat(segment, F.when(even, F.lit("|")).otherwise(F.lit("")))
    k2 = F.concat(F.when(even, F.lit("")).otherwise(F.lit("|")),
                  (custkey / 2).cast("bigint").cast("string"))
    return k1.alias("k1"), k2.alias("k2")


def _key2_sql(custkey, segment):
    return (f"{segment} || CASE WHEN {custkey} % 2 = 0 THEN '|' ELSE '' END AS k1, "
            f"CASE WHEN {custkey} % 2 = 0 THEN '' ELSE '|' END || "
            f"CAST({custkey} // 2 AS VARCHAR) AS k2")


@query("merge_two_column_key", f"""WITH base AS (
  SELECT {_key2_sql("c_custkey", "c_mktsegment")}, c_name AS v,
         CAST(NULL AS TIMESTAMP) AS __deleted_at FROM customer),
feed AS (
  SELECT {_key2_sql("c.c_custkey", "c.c_mktsegment")},
         CASE o.o_orderstatus WHEN 'F' THEN 'D' WHEN 'P' THEN 'I' ELSE 'U' END AS __op,
         CASE WHEN o.o_orderstatus <> 'F' THEN o.o_orderpriority END AS v,
         CAST(year(o.o_orderdate) AS BIGINT) AS __epoch, o.o_orderkey AS __seq
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey),
{O.merge_ctes("m", "base", "feed", pk=_KEY2, data=["v"])}
SELECT * FROM m""")
def merge_two_column_key(spark, d):
    cust = spark.read.parquet(f"{d}/customer.parquet")
    orders = spark.read.parquet(f"{d}/orders.parquet")
    base = cust.select(*_key2(F.col("c_custkey"), F.col("c_mktsegment")),
                       F.col("c_name").alias("v"))
    op = (F.when(F.col("o_orderstatus") == "F", "D")
           .when(F.col("o_orderstatus") == "P", "I").otherwise("U"))
    feed = (orders.join(cust, orders.o_custkey == cust.c_custkey)
            .select(*_key2(F.col("c_custkey"), F.col("c_mktsegment")),
                    op.alias("__op"),
                    F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")).alias("v"),
                    F.year("o_orderdate").cast("bigint").alias("__epoch"),
                    F.col("o_orderkey").alias("__seq")))
    return M.merge(base, feed, _KEY2, COMPACTED_AT, strategy="full")


_STAMP = COMPACTED_AT


@query("merge_moved_keys", f"""WITH RECURSIVE base AS ({O.ORDERS_BASE}),
mv AS ({O.FEED_MOVES}),
{O.lineage_ctes("o_orderstatus", "no_status")},
{O.lineage_ctes("o_totalprice", "no_price")},
ops AS (SELECT o_orderkey AS k, __op, __epoch, __seq FROM mv
        UNION ALL SELECT old, 'D', __epoch, __seq FROM mv WHERE old IS NOT NULL),
last AS (SELECT k, __op AS last_op FROM (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY __epoch DESC, __seq DESC) AS rn FROM ops) WHERE rn = 1),
live AS (SELECT DISTINCT k FROM ops WHERE __op <> 'D')
SELECT coalesce(b.o_orderkey, l.k) AS o_orderkey,
       CASE WHEN s.at IS NOT NULL THEN s.o_orderstatus ELSE b.o_orderstatus END AS o_orderstatus,
       CASE WHEN p.at IS NOT NULL THEN p.o_totalprice ELSE b.o_totalprice END AS o_totalprice,
       CASE WHEN l.last_op = 'D' THEN TIMESTAMP '{_STAMP}' WHEN v.k IS NOT NULL THEN NULL ELSE b.__deleted_at END AS __deleted_at
FROM base b FULL OUTER JOIN last l ON b.o_orderkey = l.k LEFT JOIN live v ON v.k = l.k
     LEFT JOIN end_o_orderstatus s ON s.at = l.k LEFT JOIN end_o_totalprice p ON p.at = l.k
WHERE b.o_orderkey IS NOT NULL OR v.k IS NOT NULL""")
def merge_moved_keys(spark, d):
    """D6 with D7: moves of a row's key that don't send every column take the values
    along, through chains of moves, back to a key it had, and onto deleted rows."""
    return M.merge(orders_base(spark, d), feed_moves(spark, d), ORDERS_PK, COMPACTED_AT, partial=True)


@query("merge_partial_images", f"""WITH base AS ({O.ORDERS_BASE}),
ev AS (
  SELECT o_orderkey, __op, o_orderstatus, __epoch, __seq,
         __op = 'U' AND __seq % 3 = 0 AS unsent,
         CASE WHEN __op = 'U' AND __seq % 3 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice
  FROM ({O.FEED_A}) WHERE __op IN ('I', 'U', 'D')),
l AS (SELECT o_orderkey, __op AS last_op FROM (
        SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY __epoch DESC, __seq DESC) rn
        FROM ev) WHERE rn = 1),
s AS (SELECT o_orderkey, o_orderstatus FROM (
        SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY __epoch DESC, __seq DESC) rn
        FROM ev WHERE __op IN ('I', 'U')) WHERE rn = 1),
p AS (SELECT o_orderkey, o_totalprice FROM (
        SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY __epoch DESC, __seq DESC) rn
        FROM ev WHERE __op IN ('I', 'U') AND NOT unsent) WHERE rn = 1),
z AS (SELECT l.o_orderkey, l.last_op, s.o_orderkey IS NOT NULL AS changed, s.o_orderstatus,
             p.o_orderkey IS NOT NULL AS has_price, p.o_totalprice
      FROM l LEFT JOIN s ON s.o_orderkey = l.o_orderkey LEFT JOIN p ON p.o_orderkey = l.o_orderkey)
SELECT coalesce(b.o_orderkey, z.o_orderkey) AS o_orderkey,
       CASE WHEN z.changed THEN z.o_orderstatus ELSE b.o_orderstatus END AS o_orderstatus,
       CASE WHEN z.changed AND z.has_price THEN z.o_totalprice ELSE b.o_totalprice END AS o_totalprice,
       CASE WHEN z.last_op = 'D' THEN TIMESTAMP '{_STAMP}' WHEN z.changed THEN NULL
            ELSE b.__deleted_at END AS __deleted_at
FROM (SELECT *, TRUE AS in_base FROM base) b FULL OUTER JOIN z ON b.o_orderkey = z.o_orderkey
WHERE b.in_base OR coalesce(z.changed, FALSE)""")
def merge_partial_images(spark, d):
    """Updates that did not send the price keep the last known price."""
    return M.merge(orders_base(spark, d), feed_a(spark, d, partial=True), ORDERS_PK,
                   COMPACTED_AT, partial=True)
