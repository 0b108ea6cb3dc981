"""Policy, role, catalog and snapshot queries over the tenant catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import acl as A
from tidemark.operators import policy as P
from tidemark.operators import reads as R
from tidemark.plans import tenant_sql as S
from tidemark.plans import tenants as T
from tidemark.plans.registry import query
from tidemark.sources import catalog as C
from tidemark.sources.snapshot import snapshot_scan


def _resolved(spark, d, cfg):
    t = T.tenant_tables(spark, d).select("table")
    return P.resolve_policy(t, cfg["exclude"], cfg["tags"], cfg["policy"])


def _policy_out(df):
    return df.select("table", F.concat_ws(",", "tags").alias("tags"), "included", "reason")


_POLICY_OUT = """SELECT "table", CASE WHEN explicit THEN '' ELSE array_to_string(tags, ',') END AS tags,
       reason = '' AS included, reason FROM r"""


@query("table_policy", S.policy_sql(T.POLICY_A) + "\n" + _POLICY_OUT)
def table_policy(spark, d):
    return _policy_out(_resolved(spark, d, T.POLICY_A))


@query("policy_untagged", S.policy_sql(T.POLICY_B) + "\n" + _POLICY_OUT)
def policy_untagged(spark, d):
    return _policy_out(_resolved(spark, d, T.POLICY_B))


# One exclusion or tag pattern per customer, of five shapes.
_SHAPE = """CASE c_custkey % 5 WHEN 0 THEN '{seg}.*_' || c_custkey WHEN 1 THEN '*.orders_' || c_custkey
  WHEN 2 THEN lower(c_mktsegment) || '.inv*_' || c_custkey || '[0-5]' WHEN 3 THEN '*[st]_' || c_custkey || '?*'
  ELSE lower(c_mktsegment) || '.scratch_' || c_custkey END""".replace("'{seg}.", "lower(c_mktsegment) || '.")


@query("policy_patterns", f"""WITH t AS ({S.TENANT_TABLES}),
p AS (SELECT 'n_' || c_nationkey AS tag, {_SHAPE} AS pattern, c_custkey % 11 = 3 AS out FROM customer),
m AS (SELECT DISTINCT t."table", p.tag, p.out FROM t JOIN p ON t."table" GLOB p.pattern),
g AS (SELECT t."table", coalesce(bool_or(m.out), FALSE) AS explicit,
             coalesce(list_sort(list(DISTINCT m.tag) FILTER (NOT m.out)), []) AS tags
      FROM t LEFT JOIN m ON m."table" = t."table" GROUP BY ALL),
r AS (SELECT *, CASE WHEN explicit THEN 'explicit exclude' WHEN list_contains(tags, 'n_3') THEN 'policy:n_3'
  WHEN list_contains(tags, 'n_7') THEN 'policy:n_7' WHEN len(tags) = 0 THEN 'policy:untagged' ELSE '' END AS reason FROM g)
{_POLICY_OUT}""")
def policy_patterns(spark, d):
    """Tables meet one pattern per customer, as rows, on the text that a match must have."""
    patterns = spark.read.parquet(f"{d}/customer.parquet").select(
        F.concat(F.lit("n_"), "c_nationkey").alias("tag"), F.expr(_SHAPE).alias("pattern"),
        (F.col("c_custkey") % 11 == 3).alias("out"))
    t = T.tenant_tables(spark, d).select("table")
    return _policy_out(P.resolve_policy_rows(t, patterns.where("out"), patterns.where("NOT out"),
                                             {"n_3": "exclude", "n_7": "exclude", "untagged": "exclude"}))


@query("policy_totals", S.policy_sql(T.POLICY_A) + """
SELECT count(*) FILTER (WHERE reason = '') AS included,
       count(*) FILTER (WHERE reason <> '') AS excluded, count(*) AS total FROM r""")
def policy_totals(spark, d):
    return P.policy_totals(_resolved(spark, d, T.POLICY_A))


def _profiles(spark, d):
    return A.role_profiles(T.table_grants(spark, d), T.column_grants(spark, d), T.ALLOW)


@query("role_profiles", f"WITH {S.PROFILES}\nSELECT * FROM profiles")
def role_profiles(spark, d):
    return _profiles(spark, d).withColumn("columns", F.concat_ws(",", "columns")) \
        .withColumn("columns", F.when(F.col("all_columns"), None).otherwise(F.col("columns")))


@query("role_view", """SELECT o_orderkey, o_totalprice, o_orderdate FROM orders""")
def role_view(spark, d):
    orders = spark.read.parquet(f"{d}/orders.parquet")
    return A.role_view(orders, _profiles(spark, d), "n_nation_2", T.SHARED_TABLE)


@query("role_aliases", f"""WITH {S.PROFILES}
SELECT role, "table", CASE role {" ".join(f"WHEN '{k}' THEN role || ' (alias: {v})'" for k, v in sorted(T.ALIASES.items()))}
       ELSE role END AS display FROM profiles""")
def role_aliases(spark, d):
    return A.with_aliases(_profiles(spark, d), T.ALIASES).select("role", "table", "display")


@query("role_memberships", S.MEMBERSHIPS)
def role_memberships(spark, d):
    return A.memberships(T.pg_auth_members(spark, d), T.pg_roles(spark, d))


@query("role_closure", S.CLOSURE)
def role_closure(spark, d):
    edges = A.memberships(T.pg_auth_members(spark, d), T.pg_roles(spark, d))
    return A.membership_closure(edges)


_EFFECTIVE_ALLOW = [*T.ALLOW, "everyone", "n_nation_0", "u_3", "u_17", "nobody"]
_EXTRA_TABLE = f"""SELECT 'PUBLIC' AS grantee, seg AS table_schema, 'orders_' || c_custkey AS table_name, 'SELECT' AS privilege_type
FROM ({S.PEOPLE}) WHERE c_custkey % 10 = 0 UNION ALL SELECT 'everyone', 'public', 'events', 'SELECT'"""
_EXTRA_COLUMN = f"""SELECT 'PUBLIC' AS grantee, seg AS table_schema, 'invoices_' || c_custkey AS table_name, 'o_custkey' AS column_name,
       'SELECT' AS privilege_type FROM ({S.PEOPLE}) WHERE c_custkey % 7 = 0
UNION ALL SELECT 'everyone', seg, 'invoices_' || c_custkey, 'o_orderdate', 'SELECT' FROM ({S.PEOPLE}) WHERE c_custkey % 5 = 0"""


@query("effective_profiles", f"""WITH RECURSIVE e AS (SELECT DISTINCT * FROM ({S.MEMBERSHIPS})),
above(member, role) AS (
  SELECT a, a FROM (SELECT unnest([{", ".join(f"'{r}'" for r in _EFFECTIVE_ALLOW)}]) AS a)
  UNION SELECT above.member, e.role FROM above JOIN e ON e.member = above.role),
who AS (SELECT * FROM above UNION SELECT member, 'PUBLIC' FROM above),
tg AS (SELECT DISTINCT member AS role, table_schema || '.' || table_name AS "table"
  FROM ({S.TABLE_GRANTS} UNION ALL {_EXTRA_TABLE}) g JOIN who ON who.role = g.grantee
  WHERE privilege_type = 'SELECT' AND table_schema <> 'pg_catalog'),
cg AS (SELECT DISTINCT member AS role, table_schema || '.' || table_name AS "table", column_name
  FROM ({S.COLUMN_GRANTS} UNION ALL {_EXTRA_COLUMN}) g JOIN who ON who.role = g.grantee
  WHERE privilege_type = 'SELECT' AND table_schema <> 'pg_catalog')
SELECT role, "table", TRUE AS all_columns, CAST(NULL AS VARCHAR) AS columns FROM tg
UNION ALL SELECT role, "table", FALSE, string_agg(column_name, ',' ORDER BY column_name) FROM cg
WHERE NOT EXISTS (SELECT 1 FROM tg WHERE tg.role = cg.role AND tg."table" = cg."table") GROUP BY role, "table\"""")
def effective_profiles(spark, d):
    """Grants through the role graph, whose top is a member of one nation (a cycle), and PUBLIC."""
    p, cols = T.people(spark, d), ["grantee", "table_schema", "table_name"]
    orders, invoices = (F.concat(F.lit(f"{k}_"), F.col("c_custkey").cast("string")) for k in ("orders", "invoices"))
    tg = (T.table_grants(spark, d)
          .unionByName(p.where("c_custkey % 10 = 0").select(F.lit("PUBLIC"), "seg", orders, F.lit("SELECT")).toDF(*cols, "privilege_type"))
          .unionByName(spark.createDataFrame([("everyone", "public", "events", "SELECT")], ", ".join(f"{c} string" for c in (*cols, "privilege_type")))))
    names = [*cols, "column_name", "privilege_type"]
    cg = (T.column_grants(spark, d)
          .unionByName(p.where("c_custkey % 7 = 0").select(F.lit("PUBLIC"), "seg", invoices, F.lit("o_custkey"), F.lit("SELECT")).toDF(*names))
          .unionByName(p.where("c_custkey % 5 = 0").select(F.lit("everyone"), "seg", invoices, F.lit("o_orderdate"), F.lit("SELECT")).toDF(*names)))
    edges = A.memberships(T.pg_auth_members(spark, d), T.pg_roles(spark, d))
    out = A.effective_profiles(tg, cg, edges, _EFFECTIVE_ALLOW)
    return out.withColumn("columns", F.when(~F.col("all_columns"), F.concat_ws(",", "columns")))


def _shapes(spark):
    rows = [(k, i + 1, n, t, nl) for k, (cols, _) in T.KIND_SHAPE.items()
            for i, (n, t, nl) in enumerate(cols)]
    return spark.createDataFrame(rows, "kind string, ordinal int, column_name string, "
                                       "pg_type string, nullable boolean")


def _columns(spark, d):
    # the shapes frame is a fixed literal (24 rows): broadcasting it is bounded
    return T.tenant_tables(spark, d).select("table", "kind") \
        .join(F.broadcast(_shapes(spark)), "kind").drop("kind")


_SHAPES_SQL = "(VALUES " + ", ".join(
    f"('{k}', {i + 1}, '{n}', '{t}', {str(nl).upper()})"
    for k, (cols, _) in T.KIND_SHAPE.items() for i, (n, t, nl) in enumerate(cols)
) + ") AS s(kind, ordinal, column_name, pg_type, nullable)"


@query("catalog_columns", f"""WITH t AS ({S.TENANT_TABLES}),
c AS (SELECT t."table", s.ordinal, s.column_name, s.pg_type, s.nullable
      FROM t JOIN {_SHAPES_SQL} ON s.kind = t.kind),
k AS (SELECT *, trim(regexp_replace(lower(pg_type), '\\(.*\\)', '')) AS b,
             nullif(regexp_extract(pg_type, '\\((\\d+)', 1), '') AS p,
             nullif(regexp_extract(pg_type, '\\(\\d+\\s*,\\s*(\\d+)\\)', 1), '') AS s FROM c),
y AS (SELECT *, CASE
  WHEN b IN ('smallint','int2','integer','int','int4','serial','smallserial') THEN 'INT32'
  WHEN b IN ('bigint','int8','bigserial') THEN 'INT64'
  WHEN b IN ('real','float4') THEN 'FLOAT'
  WHEN b IN ('double precision','float8') THEN 'DOUBLE'
  WHEN b IN ('numeric','decimal') THEN 'DECIMAL'
  WHEN b IN ('boolean','bool') THEN 'BOOLEAN'
  WHEN b IN ('json','jsonb') THEN 'JSON'
  WHEN b = 'uuid' THEN 'UUID'
  WHEN b IN ('timestamp','timestamp without time zone','timestamptz','timestamp with time zone') THEN 'TIMESTAMP_MICROS'
  WHEN b = 'date' THEN 'DATE'
  WHEN b IN ('time','time without time zone','timetz','time with time zone') THEN 'TIME_MICROS'
  WHEN b = 'bytea' THEN 'BYTE_ARRAY'
  ELSE 'UTF8' END AS category FROM k)
SELECT "table", ordinal, column_name, pg_type, nullable, category,
  CASE WHEN category = 'DECIMAL' THEN CAST(p AS INTEGER) END AS precision,
  CASE WHEN category = 'DECIMAL' THEN CAST(s AS INTEGER) END AS scale,
  CASE category WHEN 'INT32' THEN 'int' WHEN 'INT64' THEN 'bigint' WHEN 'FLOAT' THEN 'float'
    WHEN 'DOUBLE' THEN 'double' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'TIMESTAMP_MICROS' THEN 'timestamp'
    WHEN 'DATE' THEN 'date' WHEN 'BYTE_ARRAY' THEN 'binary'
    WHEN 'DECIMAL' THEN 'decimal(' || coalesce(CAST(p AS INTEGER), 38) || ',' || coalesce(CAST(s AS INTEGER), 0) || ')'
    ELSE 'string' END AS catalog_type
FROM y""")
def catalog_columns(spark, d):
    return C.typed_columns(_columns(spark, d))


CATALOG_ROOT = "warehouse/cdc"
LISTED_SCHEMAS = ["building", "machinery"]


@query("catalog_tables", f"""WITH t AS ({S.TENANT_TABLES})
SELECT "table" FROM t
WHERE kind <> 'scratch' AND schema_name IN ({", ".join(f"'{x}'" for x in LISTED_SCHEMAS)})""")
def catalog_tables(spark, d):
    """Base tables of the listed schemas (caches are views), ordered."""
    t = T.tenant_tables(spark, d).select(
        "schema_name", "table_name",
        F.when(F.col("kind") == "scratch", "VIEW").otherwise("BASE TABLE").alias("table_type"))
    return C.list_tables(t, LISTED_SCHEMAS)


@query("catalog_names", f"""WITH t AS ({S.TENANT_TABLES})
SELECT "table", schema_name, table_name,
       CASE WHEN schema_name IN ('', 'public') THEN table_name ELSE schema_name || '_' || table_name END AS catalog_name,
       '{CATALOG_ROOT}/' || "table" || '/base/__base_epoch=' || c_nationkey AS location
FROM t""")
def catalog_names(spark, d):
    return C.names(T.tenant_tables(spark, d), CATALOG_ROOT,
                   base_epoch=F.col("c_nationkey").cast("long"))


_PK_SQL = "(VALUES " + ", ".join(
    f"('{k}', {j}, {a})" for k, (_, pk) in T.KIND_SHAPE.items() for j, a in enumerate(pk)
) + ") AS x(kind, pos, attnum)"


@query("primary_keys", f"""WITH t AS ({S.TENANT_TABLES}),
c AS (SELECT t."table", s.ordinal, s.column_name FROM t JOIN {_SHAPES_SQL} ON s.kind = t.kind),
i AS (SELECT t."table", x.pos, x.attnum FROM t JOIN {_PK_SQL} ON x.kind = t.kind)
SELECT i."table", string_agg(c.column_name, ',' ORDER BY i.pos) AS primary_key
FROM i JOIN c ON c."table" = i."table" AND c.ordinal = i.attnum
GROUP BY i."table\"""")
def primary_keys(spark, d):
    idx_rows = [(k, pk) for k, (_, pk) in T.KIND_SHAPE.items()]
    idx = spark.createDataFrame(idx_rows, "kind string, indkey array<int>")
    indexes = T.tenant_tables(spark, d).select("table", "kind") \
        .join(F.broadcast(idx), "kind").select("table", "indkey")
    pk = C.primary_keys(indexes, _columns(spark, d))
    return pk.select("table", F.concat_ws(",", "primary_key").alias("primary_key"))


@query("consumer_resync_plan", f"""WITH t AS ({S.TENANT_TABLES}),
m AS (SELECT "table", c_custkey, CAST(c_nationkey AS BIGINT) AS base_epoch,
             CAST(c_nationkey + c_custkey % 5 AS BIGINT) AS latest_delta_epoch FROM t),
c AS (SELECT "table", 'warehouse' AS consumer, CAST(c_custkey % 9 AS BIGINT) AS consumer_epoch FROM m
      UNION ALL SELECT "table", 'audit', CAST(c_custkey % 3 AS BIGINT) FROM m
      UNION ALL SELECT "table", 'new', NULL FROM m
      UNION ALL SELECT "table" || '_gone', 'stray', 1 FROM m)
SELECT c.consumer, c."table", c.consumer_epoch, m.base_epoch, m.latest_delta_epoch,
       CASE WHEN m."table" IS NULL THEN 'unknown'
            WHEN c.consumer_epoch IS NULL OR c.consumer_epoch < m.base_epoch THEN 'full'
            WHEN c.consumer_epoch < m.latest_delta_epoch THEN 'incremental'
            ELSE 'current' END AS action
FROM c LEFT JOIN m ON m."table" = c."table\"""")
def consumer_resync_plan(spark, d):
    t = T.tenant_tables(spark, d)
    m = t.select("table", F.col("c_nationkey").cast("bigint").alias("base_epoch"),
                 (F.col("c_nationkey") + F.col("c_custkey") % 5).cast("bigint")
                 .alias("latest_delta_epoch"))
    c = t.select("table", F.inline(F.array(
        F.struct(F.lit("warehouse").alias("consumer"),
                 (F.col("c_custkey") % 9).cast("bigint").alias("consumer_epoch")),
        F.struct(F.lit("audit").alias("consumer"),
                 (F.col("c_custkey") % 3).cast("bigint").alias("consumer_epoch")),
        F.struct(F.lit("new").alias("consumer"),
                 F.lit(None).cast("bigint").alias("consumer_epoch")))))
    c = c.unionByName(t.select(F.concat("table", F.lit("_gone")).alias("table"),
                               F.lit("stray").alias("consumer"),
                               F.lit(1).cast("bigint").alias("consumer_epoch")))
    plan = R.resync_plan(m, c)
    return plan.select("consumer", "table", "consumer_epoch", "base_epoch",
                       "latest_delta_epoch", "action")


# The customer table's manifest columns.
CUSTOMER_COLUMNS = [
    {"name": "c_custkey", "pg_type": "bigint", "nullable": False},
    {"name": "c_name", "pg_type": "character varying(25)", "nullable": True},
    {"name": "c_nationkey", "pg_type": "integer", "nullable": True},
    {"name": "c_acctbal", "pg_type": "numeric(12,2)", "nullable": True},
    {"name": "c_mktsegment", "pg_type": "character(10)", "nullable": True},
]


@query("snapshot_scan", """SELECT c_custkey, c_name, CAST(c_nationkey AS INTEGER) AS c_nationkey,
       CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal, c_mktsegment FROM customer""")
def snapshot_scan_q(spark, d):
    return snapshot_scan(spark, CUSTOMER_COLUMNS, path=f"{d}/customer.parquet")
