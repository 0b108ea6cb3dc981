"""Health summaries: status, epoch / table / compaction ledgers, counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.constants import DELETED_AT, EPOCH, LSN, SEQ
from tidemark.functions.lsn import long_to_lsn, lsn_to_long


def status(tables: DataFrame, roles: int | None = None, detail: bool = False,
           last_compacted: str | None = None) -> DataFrame:
    """One row: active / excluded tables, latest epoch over active tables.

    ``detail`` adds tables needing compaction (latest > base) and active
    tables without a schema, in the same single aggregate; ``roles`` and
    ``last_compacted`` are what the manifest's header holds.
    """
    active = F.col("status") == "active"
    aggs = [F.count_if(active).alias("active_tables"),
            F.count_if(~active).alias("excluded_tables"),
            F.coalesce(F.max(F.when(active, F.col("latest_delta_epoch"))), F.lit(0))
             .cast("bigint").alias("latest_epoch"),
            F.coalesce(F.sum(F.when(active, F.col("row_count"))), F.lit(0))
             .cast("bigint").alias("active_rows")]
    if detail:
        aggs += [F.count_if(active & (F.col("latest_delta_epoch")
                                      > F.coalesce("base_epoch", F.lit(0))))
                 .alias("needs_compaction"),
                 F.count_if(active & F.col("columns").isNull()).alias("missing_schema")]
    out = tables.agg(*aggs)
    if roles is not None:
        out = out.withColumn("role_profiles", F.lit(roles).cast("bigint"))
    if last_compacted is not None:
        out = out.withColumn("last_compacted", F.lit(str(last_compacted)))
    return out


def events_per_epoch_table(events: DataFrame, table_col: str = "table") -> DataFrame:
    return events.groupBy(EPOCH, table_col).agg(F.count(F.lit(1)).alias("events"))


def next_epoch(tables: DataFrame) -> DataFrame:
    """Global next epoch = max latest epoch over all tables + 1."""
    return tables.agg((F.coalesce(F.max("latest_delta_epoch"), F.lit(0)) + 1)
                      .cast("bigint").alias("next_epoch"))


def epoch_ledger(deltas: DataFrame, published: int | None = None) -> DataFrame:
    """Per epoch: start / end position (numeric order), rows, status.

    An epoch past ``published``, the newest one the manifest names, is
    ``open``: its files may still change.  Without it all are committed.
    """
    state = F.lit("committed")
    if published is not None:
        state = F.when(F.col(EPOCH) <= published, state).otherwise("open")
    n = lsn_to_long(F.col(LSN))
    return (deltas.groupBy(EPOCH)
            .agg(F.min(n).alias("start_pos"), F.max(n).alias("end_pos"),
                 F.count(F.lit(1)).alias("rows"))
            .select(EPOCH, long_to_lsn(F.col("start_pos")).alias("start_lsn"),
                    long_to_lsn(F.col("end_pos")).alias("end_lsn"),
                    (F.col("end_pos") - F.col("start_pos")).alias("span_bytes"),
                    "rows", state.alias("status")))


def latest_epoch(ledger: DataFrame) -> DataFrame:
    return ledger.agg(F.max_by(F.struct(EPOCH, "end_lsn"), F.col(EPOCH)).alias("l")) \
                 .select("l.*")


def table_ledger(events: DataFrame, table_col: str = "table", order=(EPOCH, SEQ),
                 tables: DataFrame | None = None, snapshot_lsn: str | None = None) -> DataFrame:
    """Per table: last epoch, last position, change rows (upsert = arg-max).

    ``tables``, the manifest's entries, adds each one's schema version and the
    position that its snapshot has every change up to (the lowest of its ranges';
    ``snapshot_lsn`` where the entries hold none); a table without changes is there with 0 rows.
    """
    o = F.struct(*order)
    seen = events.groupBy(table_col).agg(
        F.max_by(F.col(EPOCH), o).alias("last_epoch"),
        F.max_by(F.col(LSN), o).alias("last_lsn"),
        F.count(F.lit(1)).alias("rows"))
    if tables is None:
        return seen
    own = F.lit(None).cast("string")
    if "snapshot" in tables.columns:
        lows = F.filter("snapshot.low", lambda x: x.isNotNull())
        own = F.array_min(F.transform(lows, lambda x: F.struct(lsn_to_long(x).alias("n"), x.alias("lsn"))))["lsn"]
    known = tables.select(F.col("table").alias(table_col), "schema_version",
                          F.coalesce(own, F.lit(snapshot_lsn)).alias("snapshot_lsn"))
    return known.join(seen, table_col, "left").fillna(0, ["rows"])


def compaction_ledger(base: DataFrame, table_col: str = "table",
                      epoch_col: str = "__base_epoch") -> DataFrame:
    """Per table: newest base epoch, its rows and tombstones.

    Counts per (table, base epoch) first (partial aggregation), then an
    arg-max per table over those few rows: no join back to the base.
    """
    per = base.groupBy(table_col, epoch_col).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(DELETED_AT).isNotNull()).alias("tombstones"))
    best = F.max_by(F.struct("rows", "tombstones"), F.col(epoch_col))
    return per.groupBy(table_col).agg(F.max(epoch_col).alias("base_epoch"),
                                      best.alias("b")) \
              .select(table_col, "base_epoch", "b.rows", "b.tombstones")
