"""Exact deduplication, in DataFrame operations only.

A text's group key is the 128-bit MD5 of its normalised text.  Groups are made
by ``groupBy(hash, text)``, so Spark compares the bytes inside each hash group
and texts that merely collide fall apart; a group of any number of copies is
summed up on the map side and sends one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stage, text_of

#: Each run of these characters counts as one space.
SPACES = r"[ \t-\r]+"


def normalised(text_col: str) -> Column:
    return F.regexp_replace(text_of(text_col), SPACES, " ")


def content_hash(text: Column) -> Column:
    """128 bits of MD5."""
    return F.unhex(F.md5(text.cast("binary")))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                hash_of=content_hash) -> DataFrame:
    """Group texts that are equal after normalising white space.

    Returns one row per input row: ``doc_id, keep_id, group_size, kept,
    text_sha256``.  The smallest id of a group stays.  Null text counts as
    empty, so null, empty and missing texts are one group (white space alone is
    another: one space).  A null id never wins over a number; a group of null
    ids only has a null ``keep_id`` and keeps all its rows.  Rows repeating one
    id and text are the same document: each counts and is kept or dropped alike.
    An empty table gives an empty result; other columns are ignored.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       normalised(text_col).alias("__text"))
    base = base.withColumn("__h", hash_of(F.col("__text")))
    slim = stage(base.select("doc_id", "__h", F.sha2(F.col("__text").cast("binary"), 256)
                             .alias("text_sha256")), "exact-slim")
    groups = base.groupBy("__h", "__text").agg(F.min("doc_id").alias("keep_id"),
                                               F.count(F.lit(1)).alias("group_size"))
    groups_by_hash = stage(groups.drop("__text"), "exact-groups")
    # Rows alone in their group need no partner.
    several = groups_by_hash.where("group_size > 1")
    # Hashes with more than one text (never seen for MD5): their rows need the text to tell them apart.
    mixed = groups_by_hash.groupBy("__h").count().where("count > 1").select("__h")
    by_hash = slim
    parts = []
    if not mixed.isEmpty():
        texts = base.join(mixed, "__h", "left_semi")
        parts = [texts.join(groups.join(mixed, "__h", "left_semi"), ["__h", "__text"])
                 .select("doc_id", F.sha2("__text", 256).alias("text_sha256"), "keep_id", "group_size")]
        by_hash = slim.join(mixed, "__h", "left_anti")
    parts.append(by_hash.join(several, "__h", "left")
                 .select("doc_id", "text_sha256",
                         F.when(F.col("group_size").isNull(), F.col("doc_id"))
                         .otherwise(F.col("keep_id")).alias("keep_id"),
                         F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size")))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return out.select("doc_id", "keep_id", "group_size",
                      F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
