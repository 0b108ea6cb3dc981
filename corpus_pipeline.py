"""From raw documents to piece ids, in stages that each keep what the next one reads.

``STAGES`` lists (name, function); a function takes ``(spark, docs, sf_dir)``
and returns a DataFrame.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, exact_dedup, language, minhash, pieces
from tidemark.llm.common import read, stage
from tidemark.llm.queries import PIECE_MODEL
from tidemark.llm.registry import query

#: Least similarity to the predicted language's profile.
LEAST_SCORE = 0.2


def _without(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` less those that ``found`` doesn't keep.  Rows that repeat an id are one
    document; rows without id have no group and stay."""
    return docs.join(found.where("NOT kept").select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a recognisable language."""
    return language.keep_identified(docs, language.profiles(docs), LEAST_SCORE)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document of each group of equal texts."""
    return _without(docs, exact_dedup.exact_dedup(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    return _without(docs, minhash.near_duplicates(docs))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return decontaminate.drop_leaks(docs, read(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of what is left, with the digest of the text they decode to."""
    out = pieces.encode_pieces(docs, PIECE_MODEL)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids",
                      F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("language", identify_language), ("exact", drop_copies), ("near", drop_near_copies),
          ("leaks", drop_leaks), ("pieces", encode)]

#: The language profiles, edit distances and shortest paths are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return stage(STAGES[-1][1](spark, docs, sf_dir), f"pipeline-{STAGES[-1][0]}")


query("pipeline", ORACLE_SQL)(run)
