"""Grants -> role profiles; role projection; role membership.

A profile says, per role and qualified table, whether the role may read all
columns (a table-level SELECT grant) or only a set of columns (column
grants, used only where no table grant exists).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.names import qualify
from tidemark.session import checkpoint

# Schemas whose grants are never exported.
SYSTEM_SCHEMAS = ("pg_catalog", "information_schema")


def _select_grants(df: DataFrame, allow: list[str]) -> DataFrame:
    return df.filter((F.col("privilege_type") == "SELECT")
                     & ~F.col("table_schema").isin(*SYSTEM_SCHEMAS)
                     & F.col("grantee").isin(*allow))


def role_profiles(table_grants: DataFrame, column_grants: DataFrame,
                  allow: list[str]) -> DataFrame:
    """(role, table, all_columns, columns array) for roles in ``allow``.

    Table grants: distinct (role, table).  Column grants: anti-joined on
    (role, table) against table grants, then one aggregate per (role, table).
    Both sides shuffle on (role, table) once; hot roles are pre-aggregated
    map-side by the distinct / collect_set.
    """
    if not allow:
        return table_grants.sparkSession.createDataFrame(
            [], "role string, table string, all_columns boolean, columns array<string>")
    tg = (_select_grants(table_grants, allow)
          .select(F.col("grantee").alias("role"),
                  qualify(F.col("table_schema"), F.col("table_name")).alias("table"))
          .distinct())
    cg = (_select_grants(column_grants, allow)
          .select(F.col("grantee").alias("role"),
                  qualify(F.col("table_schema"), F.col("table_name")).alias("table"),
                  F.col("column_name")))
    cols = (cg.join(tg, ["role", "table"], "left_anti")
              .groupBy("role", "table")
              .agg(F.array_sort(F.collect_set("column_name")).alias("columns"))
              .withColumn("all_columns", F.lit(False)))
    full = tg.select("role", "table", F.lit(True).alias("all_columns"),
                     F.lit(None).cast("array<string>").alias("columns"))
    return full.unionByName(cols)


def granted_columns(profiles: DataFrame, role: str, table: str,
                    all_columns: list[str]) -> list[str]:
    """Columns a role may read on a table (empty list: no access).

    Reads the single (role, table) profile row: the driver receives at most
    one row holding the column list, never table data.
    """
    row = (profiles.filter((F.col("role") == role) & (F.col("table") == table))
                   .select("all_columns", "columns").limit(1).collect())
    if not row:
        return []
    if row[0]["all_columns"]:
        return list(all_columns)
    allowed = set(row[0]["columns"] or [])
    return [c for c in all_columns if c in allowed]


def role_view(df: DataFrame, profiles: DataFrame, role: str, table: str) -> DataFrame:
    """Project ``df`` to the columns ``role`` may read (P10)."""
    cols = granted_columns(profiles, role, table, df.columns)
    if not cols:
        raise PermissionError(f"role {role!r} has no access to {table!r}")
    return df.select(*cols)


def memberships(auth_members: DataFrame, roles: DataFrame) -> DataFrame:
    """(role, member) names from id edges ``(roleid, member)`` and ``(oid, rolname)``."""
    r = roles.select(F.col("oid").alias("roleid"), F.col("rolname").alias("role"))
    m = roles.select(F.col("oid").alias("member"), F.col("rolname").alias("member_name"))
    return (auth_members.join(r, "roleid").join(m, "member")
            .select("role", F.col("member_name").alias("member")))


def membership_closure(edges: DataFrame) -> DataFrame:
    """Transitive (role, member, depth): ``member`` inherits ``role``.

    Breadth-first expansion, one equi-join per level, until a level adds no
    pair; ``depth`` is the shortest path length.  Each level keeps only pairs
    not reached before, so cycles terminate.  The edges and each level's new
    pairs are checkpointed once, so nothing is recomputed and the lineage
    stays flat.
    """
    e = checkpoint(edges.select("role", "member").distinct())
    reached = frontier = e.withColumn("depth", F.lit(1))
    level = 1
    while True:
        level += 1
        step = (frontier.select(F.col("role").alias("mid"), "member")
                .join(e.select("role", F.col("member").alias("mid")), "mid")
                .select("role", "member").distinct())
        new = step.join(reached.select("role", "member"), ["role", "member"], "left_anti")
        # computed once per level, written to the shared folder: the test for
        # an empty level, the union and the next frontier all read the files
        new = checkpoint(new.withColumn("depth", F.lit(level)))
        if new.isEmpty():
            return reached
        reached = reached.unionByName(new)
        frontier = new


#: The grantee whose grants every role has.
PUBLIC = "PUBLIC"


def _cycles(edges: DataFrame) -> DataFrame:
    """``(role, head)``: roles that are members of each other, directly or not, get one
    head; a role outside such cycles is its own.

    Roles without a member or without a role above them can't be in a cycle and go first,
    round by round.  Among the rest the least name that reaches a role and the least
    that it reaches are handed along the edges; where they are equal, that is the head of
    the role's cycle, and the remaining ones start anew.
    """
    names = edges.select(F.col("role").alias("x")).unionByName(edges.select(F.col("member").alias("x"))).distinct()
    found, e = None, checkpoint(edges.where("role <> member").distinct())
    while True:
        inner = (e.join(e.select(F.col("member").alias("role")).distinct(), "role", "left_semi")
                  .join(e.select(F.col("role").alias("member")).distinct(), "member", "left_semi"))
        inner = checkpoint(inner.select("role", "member"))
        if inner.count() < e.count():
            e = inner
            continue
        if e.isEmpty():
            break
        up = _least(e.select(F.col("role").alias("a"), F.col("member").alias("b")))
        down = _least(e.select(F.col("member").alias("a"), F.col("role").alias("b")))
        both = checkpoint(up.join(down.withColumnRenamed("least", "other"), "x"))
        done = both.where("least = other").select("x", F.col("least").alias("head"))
        found = done if found is None else found.unionByName(done)
        # an edge between two sets of labels is in no cycle
        label = both.select("x", F.struct("least", "other").alias("l"), (F.col("least") == F.col("other")).alias("done"))
        e = checkpoint(e.join(label.select(F.col("x").alias("role"), F.col("l").alias("l1"), "done"), "role")
                        .join(label.select(F.col("x").alias("member"), F.col("l").alias("l2")), "member")
                        .where("l1 = l2 AND NOT done").select("role", "member"))
    if found is None:
        return names.select(F.col("x").alias("role"), F.col("x").alias("head"))
    return checkpoint(names.join(found, "x", "left").select(F.col("x").alias("role"), F.coalesce("head", "x").alias("head")))


def _least(pairs: DataFrame) -> DataFrame:
    """``(x, least)``: the least name among ``x`` and what leads to it over ``(a, b)``."""
    label = (pairs.select(F.col("a").alias("x")).unionByName(pairs.select(F.col("b").alias("x"))).distinct()
                  .withColumn("least", F.col("x")))
    label = checkpoint(label)
    while True:
        offered = pairs.join(label, pairs["a"] == label["x"]).select(F.col("b").alias("x"), "least")
        new = label.select("x", F.col("least").alias("old")).join(
            offered.groupBy("x").agg(F.min("least").alias("new")), "x", "left")
        new = checkpoint(new.select("x", F.least("old", "new").alias("least"),
                                    (F.col("new") < F.col("old")).alias("moved")))
        label = new.drop("moved")
        if new.where("moved").isEmpty():
            return label


def effective_profiles(table_grants: DataFrame, column_grants: DataFrame, edges: DataFrame,
                       allow: list[str]) -> DataFrame:
    """What the roles in ``allow`` may read by their own grants, by those of the roles they
    are members of (``edges``: ``role, member``), and by those to PUBLIC:
    ``role, table, all_columns, columns``.

    Grant sets flow down the role graph until none grows; pairs of roles are never made.
    Roles that are members of each other are one node.  Only what a round has added
    flows on, and only through roles above an allowed one.  A grant on a whole
    table absorbs those on its columns.
    """
    edges = edges.select("role", "member").distinct()
    heads = _cycles(edges)
    spark = edges.sparkSession

    def head_of(df: DataFrame, col: str) -> DataFrame:
        return (df.join(heads.select(F.col("role").alias(col), "head"), col, "left")
                  .withColumn(col, F.coalesce("head", col)).drop("head"))
    asked = spark.createDataFrame([(r, r) for r in sorted(set(allow))] or [("", "")], "role string, node string")
    asked = checkpoint(head_of(asked, "node"))
    e = checkpoint(head_of(head_of(edges, "role"), "member").where("role <> member").distinct())
    needed = new = checkpoint(asked.select(F.col("node").alias("member")).distinct())
    while not new.isEmpty():  # the roles above the allowed ones
        above = e.join(new, "member", "left_semi").select(F.col("role").alias("member")).distinct()
        new = checkpoint(above.join(needed, "member", "left_anti"))
        needed = needed.unionByName(new)
    e = checkpoint(e.join(needed, "member", "left_semi"))
    held = checkpoint(_summed(head_of(_direct(table_grants, column_grants), "role").join(
        needed.withColumnRenamed("member", "role"), "role", "left_semi")))
    added = held
    while not added.isEmpty():
        flow = added.join(e, "role").select(F.col("member").alias("role"), "table", "all_columns", "columns")
        sums = _summed(held.unionByName(flow))
        old = held.select("role", "table", F.col("all_columns").alias("had_all"), F.size("columns").alias("had"))
        marked = checkpoint(sums.join(old, ["role", "table"], "left").withColumn(
            "grown", F.col("had").isNull() | (F.col("all_columns") != F.col("had_all")) | (F.size("columns") > F.col("had"))))
        held = marked.select("role", "table", "all_columns", "columns")
        added = marked.where("grown").select("role", "table", "all_columns", "columns")
    own = asked.where(F.col("role") != "").join(held.withColumnRenamed("role", "node"), "node").drop("node")
    public = _summed(_direct(table_grants, column_grants).where(F.col("role") == PUBLIC)).drop("role")
    # the allowed roles are a configured list
    everyone = public.select(F.explode(F.array(*[F.lit(r) for r in sorted(set(allow))]) if allow
                                       else F.array().cast("array<string>")).alias("role"), "*")
    out = _summed(own.select("role", "table", "all_columns", "columns").unionByName(everyone))
    return out.select("role", "table", "all_columns", F.when(~F.col("all_columns"), F.col("columns")).alias("columns"))


def _direct(table_grants: DataFrame, column_grants: DataFrame) -> DataFrame:
    """Readable tables and columns of each grantee, a row per grant."""
    def readable(df: DataFrame) -> DataFrame:
        return df.where((F.col("privilege_type") == "SELECT") & ~F.col("table_schema").isin(*SYSTEM_SCHEMAS))
    table = qualify(F.col("table_schema"), F.col("table_name")).alias("table")
    whole = readable(table_grants).select(F.col("grantee").alias("role"), table, F.lit(True).alias("all_columns"),
                                          F.array().cast("array<string>").alias("columns"))
    return whole.unionByName(readable(column_grants).select(
        F.col("grantee").alias("role"), table, F.lit(False).alias("all_columns"), F.array("column_name").alias("columns")))


def _summed(grants: DataFrame) -> DataFrame:
    """One row per role and table; the columns of a whole table are not listed."""
    each = grants.select("role", "table", "all_columns", F.explode_outer("columns").alias("c"))
    out = each.groupBy("role", "table").agg(F.max("all_columns").alias("all_columns"),
                                            F.array_sort(F.collect_set("c")).alias("columns"))
    return out.withColumn("columns", F.when(F.col("all_columns"), F.array().cast("array<string>")).otherwise(F.col("columns")))


def with_aliases(profiles: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """Adds ``display`` = ``role (alias: x)`` when an alias exists."""
    spark = profiles.sparkSession
    a = spark.createDataFrame(sorted(aliases.items()) or [("", "")], "role string, alias string")
    return (profiles.join(F.broadcast(a), "role", "left")
            .withColumn("display", F.when(F.col("alias").isNull(), F.col("role"))
                        .otherwise(F.format_string("%s (alias: %s)", F.col("role"), F.col("alias")))))
