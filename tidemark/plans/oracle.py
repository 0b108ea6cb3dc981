"""SQL twins of the feeds and a window-based merge, for DuckDB.

The oracle deliberately formulates the merge differently from the library
(``row_number`` windows instead of arg-max aggregates, a correlated
``NOT EXISTS`` instead of semi/anti joins), so agreement is evidence.
"""

from __future__ import annotations

from tidemark.plans.feeds import COMPACTED_AT, EPOCH_ORIGIN, MONTH_ORIGIN_YEAR

ORDERS_BASE = """SELECT o_orderkey, o_orderstatus, o_totalprice,
       CAST(NULL AS TIMESTAMP) AS __deleted_at
FROM orders"""

_OP_A = "CASE WHEN event_type = 'error' THEN 'D' WHEN event_type = 'signup' THEN 'I' ELSE 'U' END"
_KEY_A = "user_id * 110 + (event_id % 10) * 11"
_EPOCH_A = f"CAST(date_diff('day', DATE '{EPOCH_ORIGIN}', CAST(ts AS DATE)) + 1 AS BIGINT)"

FEED_A = f"""SELECT {_KEY_A} AS o_orderkey,
       {_OP_A} AS __op,
       CASE WHEN event_type <> 'error' THEN event_type END AS o_orderstatus,
       CASE WHEN event_type <> 'error' THEN value END AS o_totalprice,
       event_id AS __seq,
       {_EPOCH_A} AS __epoch
FROM events"""

FEED_B = f"""SELECT l_orderkey AS o_orderkey,
       CASE l_returnflag WHEN 'R' THEN 'D' WHEN 'A' THEN 'U' ELSE 'I' END AS __op,
       CASE WHEN l_returnflag <> 'R' THEN l_linestatus END AS o_orderstatus,
       CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END AS o_totalprice,
       CAST((year(l_shipdate) - {MONTH_ORIGIN_YEAR}) * 12 + month(l_shipdate) AS BIGINT) AS __epoch,
       l_shipdate AS __shipdate, l_linenumber AS __line, l_partkey AS __part,
       l_suppkey AS __supp, l_extendedprice AS __price
FROM lineitem"""

ORDER_A = ["__epoch", "__seq"]
ORDER_B = ["__epoch", "__shipdate", "__line", "__part", "__supp", "__price"]
DATA = ["o_orderstatus", "o_totalprice"]
PK = ["o_orderkey"]


def _on(a: str, b: str, pk) -> str:
    return " AND ".join(f"{a}.{k} IS NOT DISTINCT FROM {b}.{k}" for k in pk)


def merge_ctes(name: str, base: str, feed: str, *, pk=PK, data=DATA,
               order=ORDER_A, stamp: str = COMPACTED_AT) -> str:
    """CTEs ending in ``name`` = merged base (data columns + __deleted_at).

    ``base`` and ``feed`` are names of earlier CTEs / views.
    """
    keys = ", ".join(pk)
    desc = ", ".join(f"{c} DESC" for c in order)
    cols = ", ".join(data)
    sel_keys = ",\n       ".join(
        f"CASE WHEN b.__in_base THEN b.{k} ELSE z.{k} END AS {k}" for k in pk)
    sel_data = ",\n       ".join(
        f"CASE WHEN z.changed THEN z.{c} ELSE b.{c} END AS {c}" for c in data)
    return f"""{name}_ev AS (
  SELECT * FROM {feed} WHERE __op IN ('I', 'U', 'D')),
{name}_last AS (
  SELECT {keys}, __op AS last_op FROM (
    SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {desc}) AS rn
    FROM {name}_ev) WHERE rn = 1),
{name}_img AS (
  SELECT {keys}, {cols} FROM (
    SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {desc}) AS rn
    FROM {name}_ev WHERE __op IN ('I', 'U')) WHERE rn = 1),
{name}_z AS (
  SELECT l.*, i.{pk[0]} IS NOT NULL AS changed, {", ".join("i." + c for c in data)}
  FROM {name}_last l LEFT JOIN {name}_img i ON {_on("l", "i", pk)}),
{name} AS (
  SELECT {sel_keys},
       {sel_data},
       CASE WHEN z.last_op = 'D' THEN TIMESTAMP '{stamp}'
            WHEN z.changed THEN NULL
            ELSE b.__deleted_at END AS __deleted_at
  FROM (SELECT *, TRUE AS __in_base FROM {base}) b
  FULL OUTER JOIN {name}_z z ON {_on("b", "z", pk)}
  WHERE b.__in_base OR coalesce(z.changed, FALSE))"""


def merge_a_sql(select: str = "SELECT * FROM m") -> str:
    return f"""WITH base AS ({ORDERS_BASE}),
feed AS ({FEED_A}),
{merge_ctes("m", "base", "feed")}
{select}"""


def merge_b_sql(select: str = "SELECT * FROM m") -> str:
    return f"""WITH base AS ({ORDERS_BASE}),
feed AS ({FEED_B}),
{merge_ctes("m", "base", "feed", order=ORDER_B)}
{select}"""


def feed_a_where(cond: str) -> str:
    return f"SELECT * FROM ({FEED_A}) WHERE {cond}"


# Feed with moves between four keys per user; ``old`` is the old key of a move's update.
_SLOT = "((event_id // 10) % 4)"
FEED_MOVES = f"""SELECT user_id * 110 + {_SLOT} * 11 AS o_orderkey, {_OP_A} AS __op, event_type AS o_orderstatus,
       value AS o_totalprice, event_id AS __seq, {_EPOCH_A} AS __epoch,
       CASE WHEN event_type = 'purchase'
            THEN user_id * 110 + (CASE WHEN event_id % 7 < 5 THEN {_SLOT} + 3 ELSE {_SLOT} + 1 END % 4) * 11 END AS old,
       CASE WHEN event_type = 'purchase' THEN event_id % 4 <> 0 ELSE {_OP_A} = 'U' AND event_id % 3 = 0 END AS no_price,
       event_type = 'purchase' AND event_id % 2 = 0 AS no_status
FROM events"""


def lineage_ctes(column: str, missing: str) -> str:
    """CTEs ending in ``end_<column>`` = (key, value, hit) of what each key's column last was: pointers of
    moves that lack the column are followed one by one."""
    c = column
    return f"""def_{c} AS (
  -- what sets the column under a key: a sent value, or a move that lacks it (ref)
  SELECT o_orderkey AS k, __epoch, __seq, CASE WHEN NOT {missing} THEN {c} END AS v,
         CASE WHEN {missing} THEN old END AS ref
  FROM mv WHERE __op <> 'D' AND (NOT {missing} OR old IS NOT NULL)),
ask_{c} AS (
  SELECT k, v, ref, __epoch, __seq FROM (
    SELECT *, row_number() OVER (PARTITION BY k ORDER BY __epoch DESC, __seq DESC) AS rn FROM def_{c}) WHERE rn = 1),
prev_{c} AS (
  SELECT r.ref AS key, r.__epoch, r.__seq, d.k AS found, d.v, d.ref, d.__epoch AS e2, d.__seq AS s2
  FROM def_{c} r LEFT JOIN def_{c} d ON d.k = r.ref AND (d.__epoch, d.__seq) < (r.__epoch, r.__seq)
  WHERE r.ref IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY r.__epoch, r.__seq ORDER BY d.__epoch DESC, d.__seq DESC) = 1),
walk_{c} AS (
  SELECT k AS at, CAST(NULL AS BIGINT) AS base_key, v, ref IS NULL AS known, __epoch AS e, __seq AS s, 0 AS depth FROM ask_{c}
  UNION ALL
  SELECT w.at, CASE WHEN p.found IS NULL THEN p.key END, p.v, p.found IS NULL OR p.ref IS NULL, p.e2, p.s2, depth + 1
  FROM walk_{c} w JOIN prev_{c} p ON p.__epoch = w.e AND p.__seq = w.s WHERE NOT w.known),
end_{c} AS (
  SELECT w.at, CASE WHEN w.base_key IS NOT NULL THEN b.{c} ELSE w.v END AS {c}, depth
  FROM walk_{c} w LEFT JOIN base b ON b.o_orderkey = w.base_key WHERE w.known)"""


def lsn_text(n: str) -> str:
    return f"format('{{:X}}/{{:X}}', ({n}) >> 32, ({n}) & 4294967295)"


LSN_N = "(16 * 4294967296 - 536870912 + event_id * 1048576)"

# Text feed: the raw strings of every field (NULL outside the key on D).
TEXT_FEED = f"""SELECT {_OP_A} AS op, event_id AS seq, {lsn_text(LSN_N)} AS lsn, ts,
  'public.orders' AS "table",
  CAST({_KEY_A} AS VARCHAR) AS o_orderkey,
  CASE WHEN event_type <> 'error' THEN event_type END AS o_orderstatus,
  CASE WHEN event_type = 'error' THEN NULL
       WHEN event_id % 97 = 0 AND (event_id // 97) % 4 = 0 THEN 'bad'
       ELSE printf('%.2f', value) END AS o_totalprice,
  CASE WHEN event_type = 'error' THEN NULL
       WHEN event_id % 97 = 0 AND (event_id // 97) % 4 = 1 THEN 'bad'
       ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS o_orderdate,
  CASE WHEN event_type = 'error' THEN NULL
       WHEN event_id % 97 = 0 AND (event_id // 97) % 4 = 2 THEN 'bad'
       WHEN value > 50 THEN 't' ELSE 'f' END AS o_urgent,
  CASE WHEN event_type = 'error' THEN NULL
       WHEN event_id % 97 = 0 AND (event_id // 97) % 4 = 3 THEN 'bad'
       ELSE CAST(user_id AS VARCHAR) END AS o_quantity
FROM events"""

TEXT_TYPES = [("o_orderkey", "BIGINT"), ("o_orderstatus", "VARCHAR"),
              ("o_totalprice", "DECIMAL(12,2)"), ("o_orderdate", "TIMESTAMP"),
              ("o_urgent", "BOOLEAN"), ("o_quantity", "INTEGER")]

ROUTED = f"""SELECT CASE WHEN event_type IN ('view', 'click') THEN 'public.page_views'
            WHEN event_type = 'purchase' THEN 'public.payments'
            ELSE 'public.orders' END AS "table",
       {_EPOCH_A} AS __epoch, event_id AS __seq, {lsn_text(LSN_N)} AS __lsn,
       {LSN_N} AS __pos
FROM events"""
