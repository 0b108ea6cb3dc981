"""Table inclusion: explicit exclusion, tags by glob, tag policies.

Precedence per table: explicit exclusion (exact name, or a glob having
``*`` / ``?``) -> an excluding tag policy -> the ``untagged`` policy ->
included.  Tags are sorted, and the reason names the alphabetically first
excluding tag, so the result is deterministic.

A configuration that is small and lives on the driver becomes literal
regular expressions inside one projection over the table frame, so the
resolution is a map-only stage (no join, no shuffle) at any table count.

Patterns that are many are rows of a frame (``match_patterns``).  They meet the tables in
an equi-join on literal text that a match must have: the beginning and the end, or
text from inside, whichever the fewest patterns share; only what meets is matched.
No side of these joins passes through the driver.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.glob import MARKS, glob_keys, glob_to_regex, is_glob
from tidemark.session import checkpoint


def _any_match(col: Column, patterns: list[str]) -> Column:
    if not patterns:
        return F.lit(False)
    return reduce(lambda a, b: a | b,
                  [col.rlike(glob_to_regex(p)) for p in patterns])


def explicit_exclusion(col: Column, exclude: list[str]) -> Column:
    exact = col.isin(*exclude) if exclude else F.lit(False)
    return exact | _any_match(col, [p for p in exclude if is_glob(p)])


def tag_array(col: Column, tags: dict[str, list[str]]) -> Column:
    """Sorted array of every tag with at least one matching pattern."""
    if not tags:
        return F.array().cast("array<string>")
    hits = [F.when(_any_match(col, pats), F.lit(tag)) for tag, pats in sorted(tags.items())]
    return F.array_compact(F.array(*hits))


def resolve_policy(tables: DataFrame, exclude: list[str] | None = None,
                   tags: dict[str, list[str]] | None = None,
                   policy: dict[str, str] | None = None,
                   table_col: str = "table") -> DataFrame:
    """Adds ``tags`` (array), ``included`` (bool) and ``reason`` (text)."""
    exclude, tags, policy = exclude or [], tags or {}, policy or {}
    t = F.col(table_col)
    return _decide(tables.withColumn("__tags", tag_array(t, tags)), explicit_exclusion(t, exclude), policy, tables.columns)


def _merge_join(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """An equi-join by sorting both sides, never by a broadcast, whatever their estimated sizes:
    estimates leave out that rows were exploded, and a broadcast gathers a side on the driver."""
    return left.join(right.hint("merge"), on, how)


#: Parts that the patterns of one key are counted in.
_PARTS = 256


def _pattern_keys(patterns: DataFrame) -> DataFrame:
    """Each different pattern with its regular expression and the literal text to join on: of
    all that it could be found by, the one that the fewest patterns share."""
    def keys(pattern: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(glob_keys(p), glob_to_regex(p)) for p in pattern], columns=["keys", "regex"])
    keyed = F.pandas_udf(keys, "keys array<struct<kind:string,head:string,tail:string>>, regex string")
    found = patterns.select("pattern").where("pattern IS NOT NULL").distinct().withColumn("__k", keyed("pattern")) \
        .select("pattern", "__k.regex", F.inline("__k.keys"))
    # many patterns may share a key: its rows are counted and joined in parts, so no task gets them all
    found = found.withColumn("part", F.pmod(F.xxhash64("pattern"), F.lit(_PARTS)))
    shared = found.groupBy("kind", "head", "tail", "part").agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("n", F.sum("n").over(Window.partitionBy("kind", "head", "tail")))
    # of several the kind with the fewest keys to a table, and the shortest, so that few lengths occur
    order = F.struct("n", F.col("kind") != "mark", F.length("head") + F.length("tail"), "kind", "head", "tail")
    best = F.min(F.struct(order.alias("order"), "kind", "head", "tail")).alias("__b")
    return _merge_join(found, shared, ["kind", "head", "tail", "part"]).groupBy("pattern", "regex").agg(best) \
        .select("pattern", "regex", "__b.kind", "__b.head", "__b.tail")


def _key(kind: str, head: Column, tail: Column) -> Column:
    return F.xxhash64(F.lit(kind), head, tail)


def match_patterns(tables: DataFrame, patterns: DataFrame, table_col: str = "table") -> DataFrame:
    """Each table with each row of ``patterns`` (``pattern`` and other columns) that matches it.

    A pattern is known by literal text (``_pattern_keys``): its beginning and end, or some of
    the text between.  The join's keys are hashes of those of a table for each length that
    occurs (a name has at most as many as characters), and what meets is matched.  A pattern
    without literal text meets every table, as its matches do.
    """
    chosen = checkpoint(_pattern_keys(patterns))
    # lengths only: bounded by the longest name
    sizes = chosen.select("kind", F.length("head").alias("h"), F.length("tail").alias("t")).distinct().collect()
    name, none, no_text = F.col(table_col), F.array().cast("array<bigint>"), F.lit("")
    keys = [F.when(F.length(name) >= r["h"] + r["t"],
                   F.array(_key("ends", F.left(name, F.lit(r["h"])), F.right(name, F.lit(r["t"]))))).otherwise(none)
            for r in sizes if r["kind"] == "ends"]
    keys += [F.array(_key(k, text, no_text)) for k, text in (("whole", name), ("any", no_text))
             if any(r["kind"] == k for r in sizes)]
    places = F.when(F.length(name) > 0, F.sequence(F.lit(1), F.length(name))).otherwise(F.array().cast("array<int>"))
    marks = F.filter(places, lambda i: F.substring(name, i, F.lit(1)).isin(*MARKS))
    for kind, at in (("inside", places), ("mark", marks)):
        lengths = sorted({r["h"] for r in sizes if r["kind"] == kind})
        if lengths:
            keys.append(F.flatten(F.transform(at, lambda i: F.array(
                *[_key(kind, F.substring(name, i, F.lit(n)), no_text) for n in lengths]))))  # noqa: B023
    # a name's key comes once, so a pattern, which has one key, meets it once
    sides = tables.select(*tables.columns, F.explode(F.array_distinct(F.concat(none, *keys))).alias("__key"))
    mine = [c for c in patterns.columns if c != "pattern"]
    keyed = _merge_join(patterns, chosen.select("pattern", "regex", F.xxhash64("kind", "head", "tail").alias("__key")), "pattern")
    return (_merge_join(sides, keyed, "__key").where(F.rlike(F.col(table_col), F.col("regex")))
            .select(*tables.columns, "pattern", *mine))


def resolve_policy_rows(tables: DataFrame, exclude: DataFrame, tags: DataFrame, policy: dict[str, str] | None = None,
                        table_col: str = "table") -> DataFrame:
    """``resolve_policy`` with the patterns as frames: ``exclude`` (``pattern``) and ``tags``
    (``tag, pattern``), of any number.  An exclusion without ``*`` or ``?`` is a name."""
    names = tables.select(table_col).distinct()
    as_glob = F.col("pattern").contains("*") | F.col("pattern").contains("?")
    rules = exclude.where(as_glob).select("pattern", F.lit(None).cast("string").alias("tag"), F.lit(True).alias("__ex")) \
        .unionByName(tags.select("pattern", "tag", F.lit(False).alias("__ex")))
    met = (match_patterns(names, rules, table_col).groupBy(table_col)
           .agg(F.max("__ex").alias("__out"), F.array_sort(F.collect_set(F.when(~F.col("__ex"), F.col("tag")))).alias("__tags")))
    exact = exclude.select(F.col("pattern").alias(table_col)).where(F.col(table_col).isNotNull()).distinct() \
        .withColumn("__exact", F.lit(True))
    j = _merge_join(_merge_join(tables, exact, table_col, "left"), met, table_col, "left")
    j = j.withColumn("__tags", F.coalesce("__tags", F.array().cast("array<string>")))
    return _decide(j, F.coalesce("__exact", "__out", F.lit(False)), policy or {}, tables.columns)


def _decide(tagged: DataFrame, explicit: Column, policy: dict[str, str], columns: list[str]) -> DataFrame:
    """The decision of each table from its tags (``__tags``)."""
    excluding = sorted(k for k, v in policy.items() if v == "exclude" and k != "untagged")
    ex_tag = F.try_element_at(F.filter(F.col("__tags"), lambda x: x.isin(*excluding))
                              if excluding else F.array().cast("array<string>"), F.lit(1))
    untagged_out = policy.get("untagged") == "exclude"
    no_tags = F.size(F.col("__tags")) == 0
    reason = (F.when(explicit, F.lit("explicit exclude"))
               .when(ex_tag.isNotNull(), F.concat(F.lit("policy:"), ex_tag))
               .when(no_tags & F.lit(untagged_out), F.lit("policy:untagged"))
               .otherwise(F.lit("")))
    return tagged.select(
        *columns,
        F.when(explicit, F.array().cast("array<string>")).otherwise(F.col("__tags")).alias("tags"),
        (reason == "").alias("included"),
        reason.alias("reason"))


def policy_totals(resolved: DataFrame) -> DataFrame:
    """Included / excluded / total counts (one row)."""
    return resolved.agg(F.count_if(F.col("included")).alias("included"),
                        F.count_if(~F.col("included")).alias("excluded"),
                        F.count(F.lit(1)).alias("total"))

