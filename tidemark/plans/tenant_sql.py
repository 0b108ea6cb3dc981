"""SQL twins of ``tidemark.plans.tenants`` (DuckDB; globs via GLOB)."""

from __future__ import annotations

from tidemark.plans.tenants import (ALLOW, KINDS, SHARED_GRANT_COLUMNS)


def _lst(xs):
    return "[" + ", ".join(f"'{x}'" for x in xs) + "]"


def _in(xs):
    return ", ".join(f"'{x}'" for x in xs)


TENANT_TABLES = f"""SELECT lower(c_mktsegment) || '.' || kind || '_' || c_custkey AS "table",
       lower(c_mktsegment) AS schema_name, kind || '_' || c_custkey AS table_name, kind,
       c_custkey, c_nationkey, c_acctbal
FROM customer CROSS JOIN (SELECT unnest({_lst(KINDS)}) AS kind)"""

PEOPLE = """SELECT c_custkey, lower(c_mktsegment) AS seg,
       'r_' || replace(lower(r_name), ' ', '_') AS region_role,
       'n_' || replace(lower(n_name), ' ', '_') AS nation_role,
       'u_' || c_custkey AS user_role
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

TABLE_GRANTS = f"""SELECT region_role AS grantee, seg AS table_schema, 'orders_' || c_custkey AS table_name,
       'SELECT' AS privilege_type FROM ({PEOPLE})
UNION ALL SELECT nation_role, seg, 'orders_' || c_custkey, 'INSERT' FROM ({PEOPLE})
UNION ALL SELECT user_role, 'pg_catalog', 'pg_stat_' || c_custkey, 'SELECT' FROM ({PEOPLE})
UNION ALL SELECT DISTINCT 'r_' || replace(lower(r_name), ' ', '_'), 'public', 'orders', 'SELECT'
  FROM nation JOIN region ON n_regionkey = r_regionkey"""

COLUMN_GRANTS = f"""SELECT nation_role AS grantee, seg AS table_schema, 'invoices_' || c_custkey AS table_name,
       unnest(['o_orderkey', 'o_totalprice']) AS column_name, 'SELECT' AS privilege_type FROM ({PEOPLE})
UNION ALL SELECT region_role, seg, 'orders_' || c_custkey, 'o_orderkey', 'SELECT' FROM ({PEOPLE})
UNION ALL SELECT nation_role, seg, 'invoices_' || c_custkey, 'o_orderstatus', 'UPDATE' FROM ({PEOPLE})
UNION ALL SELECT 'n_' || replace(lower(n_name), ' ', '_'), 'public', 'orders',
       unnest({_lst(SHARED_GRANT_COLUMNS)}), 'SELECT' FROM nation"""

PROFILES = f"""tg AS (SELECT DISTINCT grantee AS role, table_schema || '.' || table_name AS "table"
  FROM ({TABLE_GRANTS}) WHERE privilege_type = 'SELECT'
  AND table_schema NOT IN ('pg_catalog', 'information_schema') AND grantee IN ({_in(ALLOW)})),
cg AS (SELECT grantee AS role, table_schema || '.' || table_name AS "table", column_name
  FROM ({COLUMN_GRANTS}) WHERE privilege_type = 'SELECT'
  AND table_schema NOT IN ('pg_catalog', 'information_schema') AND grantee IN ({_in(ALLOW)})),
profiles AS (
  SELECT role, "table", TRUE AS all_columns, CAST(NULL AS VARCHAR) AS columns FROM tg
  UNION ALL
  SELECT role, "table", FALSE, string_agg(DISTINCT column_name, ',' ORDER BY column_name)
  FROM cg WHERE NOT EXISTS (SELECT 1 FROM tg WHERE tg.role = cg.role AND tg."table" = cg."table")
  GROUP BY role, "table")"""

ROLES = """SELECT c_custkey + 100000 AS oid, 'u_' || c_custkey AS rolname FROM customer
UNION ALL SELECT n_nationkey + 1000, 'n_' || replace(lower(n_name), ' ', '_') FROM nation
UNION ALL SELECT r_regionkey + 100, 'r_' || replace(lower(r_name), ' ', '_') FROM region
UNION ALL SELECT 10, 'everyone'"""

AUTH_MEMBERS = """SELECT c_nationkey + 1000 AS roleid, c_custkey + 100000 AS member FROM customer
UNION ALL SELECT n_regionkey + 100, n_nationkey + 1000 FROM nation
UNION ALL SELECT 10, r_regionkey + 100 FROM region
UNION ALL SELECT 1000, 10"""

MEMBERSHIPS = f"""SELECT r.rolname AS role, m.rolname AS member
FROM ({AUTH_MEMBERS}) am JOIN ({ROLES}) r ON am.roleid = r.oid JOIN ({ROLES}) m ON am.member = m.oid"""

CLOSURE = f"""WITH RECURSIVE e AS (SELECT DISTINCT * FROM ({MEMBERSHIPS})),
c(role, member, depth) USING KEY (role, member) AS (
  SELECT role, member, 1 FROM e
  UNION
  SELECT e.role, n.member, min(n.depth) + 1 FROM c n JOIN e ON e.member = n.role
  WHERE NOT EXISTS (SELECT 1 FROM recurring.c o WHERE o.role = e.role AND o.member = n.member)
  GROUP BY e.role, n.member)
SELECT role, member, depth FROM c"""


def glob_any(col: str, patterns: list[str]) -> str:
    if not patterns:
        return "FALSE"
    return "(" + " OR ".join(f"{col} GLOB '{p}'" for p in patterns) + ")"


def policy_sql(cfg: dict) -> str:
    """Resolution of the tenant catalog: table, tags (sorted, joined), included, reason."""
    t = '"table"'
    excl = cfg["exclude"]
    exact = f"{t} IN ({_in(excl)})" if excl else "FALSE"
    globs = [p for p in excl if "*" in p or "?" in p]
    explicit = f"({exact} OR {glob_any(t, globs)})"
    tag_items = ", ".join(f"CASE WHEN {glob_any(t, pats)} THEN '{tag}' END"
                          for tag, pats in sorted(cfg["tags"].items()))
    tags = f"list_filter([{tag_items}], lambda x: x IS NOT NULL)" if tag_items else "[]"
    excluding = sorted(k for k, v in cfg["policy"].items() if v == "exclude" and k != "untagged")
    whens = "\n".join(f"    WHEN list_contains(tags, '{k}') THEN 'policy:{k}'" for k in excluding)
    untagged = "TRUE" if cfg["policy"].get("untagged") == "exclude" else "FALSE"
    return f"""WITH t AS ({TENANT_TABLES}),
g AS (SELECT {t}, {explicit} AS explicit, {tags} AS tags FROM t),
r AS (SELECT *, CASE WHEN explicit THEN 'explicit exclude'
{whens}
    WHEN len(tags) = 0 AND {untagged} THEN 'policy:untagged'
    ELSE '' END AS reason FROM g)"""
