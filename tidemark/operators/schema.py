"""Additive schema evolution: align files, find unknown columns, evolve.

The event stream carries row images as ``map<string,string>``, so the
stream schema never changes; new columns show up as new map keys and are
typed per batch with the current manifest schema.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.constants import ALL_META


def align(df: DataFrame, schema: T.StructType, keep_extra: bool = False) -> DataFrame:
    """Project to ``schema`` (order and types); missing columns are NULL."""
    cols = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields]
    if keep_extra:
        names = set(schema.fieldNames())
        cols += [F.col(c) for c in df.columns if c not in names]
    return df.select(*cols)


def union_files(frames: list[DataFrame]) -> DataFrame:
    """Union of frames whose columns differ (missing -> NULL)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def unknown_columns(events: DataFrame, known: list[str], row_col: str = "row",
                    table_col: str = "table") -> DataFrame:
    """(table, column) for map keys outside the known columns and metadata.

    ``explode(map_keys)`` then distinct: partial aggregation keeps the
    shuffle to one row per (task, table, key).
    """
    skip = list(known) + list(ALL_META)
    return (events.select(F.col(table_col).alias("table"),
                          F.explode(F.map_keys(F.col(row_col))).alias("column"))
                  .filter(~F.col("column").isin(*skip))
                  .distinct())


def unknown_rejects(events: DataFrame, known: list[str], row_col: str = "row") -> DataFrame:
    """(seq, table, column_name, raw) for every value under a map key outside the
    known columns and metadata."""
    skip = F.array(*[F.lit(c) for c in [*known, *ALL_META]])
    extra = F.map_filter(F.col(row_col), lambda k, _: ~F.array_contains(skip, k))
    # few events have any: the others are passed over before their keys are looked at one by one
    some = F.size(F.array_except(F.map_keys(F.col(row_col)), skip)) > 0
    return events.where(some).select("seq", "table", F.explode(extra).alias("column_name", "raw"))


def new_columns(unknown: DataFrame, source_columns: DataFrame) -> DataFrame:
    """Unknown columns the source confirms, in source order.

    ``source_columns``: (table, column, pg_type, nullable, ordinal).
    """
    return (source_columns.join(unknown, ["table", "column"], "left_semi")
                          .orderBy("table", "ordinal"))


def evolve(columns: list[dict], added: list[dict], version: int) -> tuple[list[dict], int]:
    """Append confirmed columns (source order); bump the version if any."""
    have = {c["name"] for c in columns}
    extra = [c for c in added if c["name"] not in have]
    if not extra:
        return columns, version
    return columns + extra, version + 1
