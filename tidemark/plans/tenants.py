"""Governance fixtures derived from customer / nation / region.

The source catalog is schema-per-segment, table-per-customer: every
customer owns one table of each kind, so the catalog, the grants and the
role graph all grow with the customer table.  Roles: ``r_<region>``,
``n_<nation>``, ``u_<custkey>`` and ``everyone``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixtures.
KINDS = ["orders", "invoices", "visits", "scratch"]
ORDERS_COLUMNS = [("o_orderkey", "bigint", False), ("o_custkey", "bigint", True),
                  ("o_orderstatus", "text", True), ("o_totalprice", "numeric(12,2)", True),
                  ("o_orderdate", "timestamp without time zone", True),
                  ("o_orderpriority", "character varying(15)", True)]
EVENTS_COLUMNS = [("event_id", "bigint", False), ("ts", "timestamp with time zone", True),
                  ("user_id", "bigint", True), ("event_type", "text", True),
                  ("value", "double precision", True), ("props", "jsonb", True)]
# kind -> (columns, primary-key attribute numbers in index order)
KIND_SHAPE = {"orders": (ORDERS_COLUMNS, [1]), "invoices": (ORDERS_COLUMNS, [1, 2]),
              "visits": (EVENTS_COLUMNS, [3, 1]), "scratch": (EVENTS_COLUMNS, [])}

POLICY_A = {
    "exclude": ["household.orders_7", "*.scratch_1*"],
    "tags": {"pii": ["building.invoices_*", "machinery.*"],
             "ephemeral": ["*.visits_*", "*.scratch_*"],
             "finance": ["*.invoices_?", "automobile.[io]*"]},
    "policy": {"pii": "exclude", "ephemeral": "exclude"},
}
POLICY_B = {
    "exclude": ["furniture.orders_1[0-9]"],
    "tags": {"approved": ["furniture.*", "*.orders_1?"]},
    "policy": {"untagged": "exclude"},
}
ALLOW = ["r_asia", "r_europe", "n_nation_2", "n_nation_3", "n_nation_8", "n_nation_13"]
ALIASES = {"r_asia": "apac_readers", "n_nation_3": "de_team"}
SHARED_TABLE = "public.orders"
SHARED_GRANT_COLUMNS = ["o_orderkey", "o_totalprice", "o_orderdate"]


def _t(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def _role(prefix: str, name) -> F.Column:
    return F.concat(F.lit(prefix), F.regexp_replace(F.lower(name), " ", "_"))


def tenant_tables(spark: SparkSession, d: str) -> DataFrame:
    """(table, schema_name, table_name, kind, c_custkey, c_nationkey)."""
    # a small file is one task, and each of its rows becomes dozens: spread them first
    c = _t(spark, d, "customer").repartition("c_custkey")
    x = c.select("c_custkey", "c_nationkey", "c_acctbal",
                 F.lower("c_mktsegment").alias("schema_name"),
                 F.explode(F.array(*[F.lit(k) for k in KINDS])).alias("kind"))
    x = x.withColumn("table_name", F.concat_ws("_", "kind", F.col("c_custkey").cast("string")))
    return x.withColumn("table", F.concat_ws(".", "schema_name", "table_name"))


def people(spark: SparkSession, d: str) -> DataFrame:
    """customer joined with its nation and region role names."""
    c = _t(spark, d, "customer")
    n = _t(spark, d, "nation")
    r = _t(spark, d, "region")
    return (c.join(n, c.c_nationkey == n.n_nationkey)
             .join(r, F.col("n_regionkey") == r.r_regionkey)
             .select("c_custkey", F.lower("c_mktsegment").alias("seg"),
                     _role("r_", F.col("r_name")).alias("region_role"),
                     _role("n_", F.col("n_name")).alias("nation_role"),
                     F.concat(F.lit("u_"), F.col("c_custkey").cast("string")).alias("user_role")))


def table_grants(spark: SparkSession, d: str) -> DataFrame:
    p = people(spark, d)
    n = _t(spark, d, "nation").join(_t(spark, d, "region"),
                                    F.col("n_regionkey") == F.col("r_regionkey"))
    orders_t = F.concat(F.lit("orders_"), F.col("c_custkey").cast("string"))
    cols = ["grantee", "table_schema", "table_name", "privilege_type"]
    a = p.select(F.col("region_role").alias("grantee"), F.col("seg").alias("table_schema"),
                 orders_t.alias("table_name"), F.lit("SELECT").alias("privilege_type"))
    b = p.select(F.col("nation_role").alias("grantee"), F.col("seg"), orders_t,
                 F.lit("INSERT")).toDF(*cols)
    c = p.select(F.col("user_role"), F.lit("pg_catalog"),
                 F.concat(F.lit("pg_stat_"), F.col("c_custkey").cast("string")),
                 F.lit("SELECT")).toDF(*cols)
    s = n.select(_role("r_", F.col("r_name")), F.lit("public"), F.lit("orders"),
                 F.lit("SELECT")).distinct().toDF(*cols)
    return a.unionByName(b).unionByName(c).unionByName(s)


def column_grants(spark: SparkSession, d: str) -> DataFrame:
    p = people(spark, d)
    n = _t(spark, d, "nation")
    cols = ["grantee", "table_schema", "table_name", "column_name", "privilege_type"]
    inv = F.concat(F.lit("invoices_"), F.col("c_custkey").cast("string"))
    orders_t = F.concat(F.lit("orders_"), F.col("c_custkey").cast("string"))
    a = p.select("nation_role", "seg", inv,
                 F.explode(F.array(F.lit("o_orderkey"), F.lit("o_totalprice"))),
                 F.lit("SELECT")).toDF(*cols)
    b = p.select("region_role", "seg", orders_t, F.lit("o_orderkey"),
                 F.lit("SELECT")).toDF(*cols)
    c = p.select("nation_role", "seg", inv, F.lit("o_orderstatus"),
                 F.lit("UPDATE")).toDF(*cols)
    s = n.select(_role("n_", F.col("n_name")), F.lit("public"), F.lit("orders"),
                 F.explode(F.array(*[F.lit(x) for x in SHARED_GRANT_COLUMNS])),
                 F.lit("SELECT")).toDF(*cols)
    return a.unionByName(b).unionByName(c).unionByName(s)


def pg_roles(spark: SparkSession, d: str) -> DataFrame:
    c, n, r = _t(spark, d, "customer"), _t(spark, d, "nation"), _t(spark, d, "region")
    return (c.select((F.col("c_custkey") + 100000).alias("oid"),
                     F.concat(F.lit("u_"), F.col("c_custkey").cast("string")).alias("rolname"))
            .unionByName(n.select((F.col("n_nationkey") + 1000).cast("bigint").alias("oid"),
                                  _role("n_", F.col("n_name")).alias("rolname")))
            .unionByName(r.select((F.col("r_regionkey") + 100).cast("bigint").alias("oid"),
                                  _role("r_", F.col("r_name")).alias("rolname")))
            .unionByName(spark.createDataFrame([(10, "everyone")], "oid bigint, rolname string")))


def pg_auth_members(spark: SparkSession, d: str) -> DataFrame:
    """(roleid, member) id edges: user -> nation -> region -> everyone,
    plus everyone -> nation 0, which closes a cycle."""
    c, n, r = _t(spark, d, "customer"), _t(spark, d, "nation"), _t(spark, d, "region")
    e = [c.select((F.col("c_nationkey") + 1000).cast("bigint").alias("roleid"),
                  (F.col("c_custkey") + 100000).alias("member")),
         n.select((F.col("n_regionkey") + 100).cast("bigint").alias("roleid"),
                  (F.col("n_nationkey") + 1000).cast("bigint").alias("member")),
         r.select(F.lit(10).cast("bigint").alias("roleid"),
                  (F.col("r_regionkey") + 100).cast("bigint").alias("member")),
         # fixed value: "everyone" is also a member of nation 0's role (a cycle)
         spark.createDataFrame([(1000, 10)], "roleid bigint, member bigint")]
    out = e[0]
    for x in e[1:]:
        out = out.unionByName(x)
    return out
