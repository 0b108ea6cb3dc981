"""Name and path helpers: qualified names, epoch file names, versions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def qualify(schema: Column, table: Column) -> Column:
    """``schema.table``."""
    return F.concat_ws(".", schema, table)


def schema_of(qualified: Column) -> Column:
    """Part before the first dot (NULL when there is no dot)."""
    return F.when(F.instr(qualified, ".") > 0, F.substring_index(qualified, ".", 1))


def table_of(qualified: Column) -> Column:
    """Part after the first dot (the rest may contain dots)."""
    return F.when(F.instr(qualified, ".") > 0,
                  F.substr(qualified, F.instr(qualified, ".") + 1))


def flat_name(schema: Column, table: Column) -> Column:
    """Catalog name: ``public`` or empty schema -> table, else schema_table."""
    return F.when(F.coalesce(schema, F.lit("")).isin("", "public"), table) \
            .otherwise(F.concat_ws("_", schema, table))


def epoch_name(prefix: str, epoch: Column) -> Column:
    """``base_000042`` / ``epoch=000042``; compare epochs as numbers, not text."""
    return F.format_string(prefix + "%06d", epoch)


def truncate_version(v: Column) -> Column:
    """Server version text up to the first ``(`` (if not at the start), trimmed."""
    return F.when(F.instr(v, "(") > 1, F.trim(F.substring_index(v, "(", 1))).otherwise(v)


def location(root: Column, qualified: Column, base_epoch: Column) -> Column:
    """Storage location of a table's base of an epoch; its parent holds every base."""
    return F.concat_ws("/", root, qualified, F.lit("base"),
                       F.format_string("__base_epoch=%d", base_epoch))
