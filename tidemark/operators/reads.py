"""Consumer reads over base + deltas: as-of, changes since, history, latest."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.constants import EPOCH, OP, SEQ, UNCHANGED
from tidemark.operators import merge as M


def state_as_of(base: DataFrame, base_epoch: int, deltas: DataFrame,
                pk: list[str], epoch: int, stamp, order=(EPOCH, SEQ),
                strategy: str = "auto") -> DataFrame:
    """Table state at ``epoch``: the base at ``base_epoch`` <= epoch plus the
    deltas in (base_epoch, epoch].  The epoch filter prunes delta partitions."""
    if base_epoch > epoch:
        raise ValueError(f"base epoch {base_epoch} is newer than {epoch}")
    d = deltas.filter((F.col(EPOCH) > base_epoch) & (F.col(EPOCH) <= epoch))
    return M.merge(base, d, pk, stamp, order=order, strategy=strategy)


def changes_since(deltas: DataFrame, epoch: int) -> DataFrame:
    """Raw change rows after a consumer's epoch watermark."""
    return deltas.filter(F.col(EPOCH) > epoch)


def net_changes_since(deltas: DataFrame, pk: list[str], epoch: int,
                      order=(EPOCH, SEQ), data_cols: list[str] | None = None,
                      partial: bool = False) -> DataFrame:
    """One row per changed key after ``epoch``: last op and the last live image.

    ``__op`` is ``D`` when the key ended deleted; the image columns then hold
    the last I/U image seen after the watermark (NULL when there was none).
    ``partial``: each column holds its last sent value, and ``__unchanged``
    lists those that no live change after the watermark sent.
    """
    d = changes_since(deltas, epoch)
    if data_cols is None:
        data_cols = M.data_columns(d, pk, exclude=order)
    partial = partial and UNCHANGED in d.columns
    z = M.fold(d, pk, data_cols, order, partial)
    unsent = []
    if partial:
        unsent = [F.filter(F.array(*[F.when((F.col(M.N_IU) > 0) & (F.col(f"__has_{c}") == 0), F.lit(c))
                                     for c in data_cols]), lambda c: c.isNotNull()).alias(UNCHANGED)]
    return z.select(*pk, F.col(M.LAST_OP).alias(OP),
                    *[F.col(f"{M.IMG}.{c}").alias(c) for c in data_cols],
                    F.col(M.N_EVENTS).alias("events"), *unsent)


def latest(deltas: DataFrame, pk: list[str], order=(EPOCH, SEQ)) -> DataFrame:
    """Latest change row per key, whole row kept.

    An arg-max aggregate, not a window: partial aggregation keeps one row per
    key and task before the shuffle, so a key holding a third of all changes
    never lands whole in one task.
    """
    rest = [c for c in deltas.columns if c not in pk]
    best = F.max_by(F.struct(*[F.col(c) for c in rest]), M.order_struct(order))
    return deltas.groupBy(*pk).agg(best.alias("__r")).select(*pk, "__r.*") \
                 .select(*deltas.columns)


def history(deltas: DataFrame, pk: list[str], order=(EPOCH, SEQ),
            slice_width: int = 1 << 20) -> DataFrame:
    """Version history per key: each change with its validity interval.

    ``version`` numbers a key's changes from 1 in change order,
    ``valid_from`` is the change's epoch and ``valid_to`` the next change's
    epoch (NULL while current).

    Skew-safe: a key's changes are cut into slices by the leading order
    column (the epoch) and, when the next order column is an integer (the
    sequence), by ``slice_width``-wide ranges of it.  Both cuts are monotone
    in the change order, so ranking each (key, slice) on its own and
    stitching slices in order is exact.  A small per-(key, slice) summary,
    ordered by slice, gives each slice's version offset and the first epoch
    of the next slice; it is joined back.  A hot key is spread over its
    epochs and sequence ranges; slices come from the data, not partition ids.
    """
    lead_col, rest = order[0], list(order[1:])
    types = dict(deltas.dtypes)
    slices = [F.col(lead_col).alias("__s0")]
    if rest and types.get(rest[0]) in ("bigint", "int", "smallint", "tinyint"):
        slices.append(F.floor(F.col(rest[0]) / F.lit(slice_width)).alias("__s1"))
    names = [f"__s{i}" for i in range(len(slices))]
    x0 = deltas.select("*", *slices)
    w = Window.partitionBy(*pk, *names).orderBy(*[F.col(c) for c in rest] or [F.lit(1)])
    x = (x0.withColumn("__local", F.row_number().over(w))
           .withColumn("__next", F.lead(F.col(EPOCH)).over(w)))
    stats = x.groupBy(*pk, *names).agg(
        F.count(F.lit(1)).alias("__cnt"),
        F.min_by(F.col(EPOCH), M.order_struct(order)).alias("__first"))
    ws = Window.partitionBy(*pk).orderBy(*names)
    stats = (stats.withColumn("__offset", F.coalesce(F.sum("__cnt").over(
                 ws.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
                  .withColumn("__next_first", F.lead("__first").over(ws))
                  .select(*[F.col(k).alias("__j_" + k) for k in pk + names],
                          "__offset", "__next_first"))
    cond = F.lit(True)
    for k in pk + names:
        cond = cond & F.col(k).eqNullSafe(F.col("__j_" + k))
    j = x.join(stats, cond, "left")
    return j.select(*deltas.columns,
                    (F.col("__offset") + F.col("__local")).cast("bigint").alias("version"),
                    F.col(EPOCH).alias("valid_from"),
                    F.coalesce(F.col("__next"), F.col("__next_first")).alias("valid_to"))


def resync_plan(tables: DataFrame, consumers: DataFrame) -> DataFrame:
    """Per (consumer, table): ``full`` re-pull when the consumer never pulled
    (NULL) or its epoch is below the compacted base (its deltas are gone),
    ``incremental`` when behind the latest delta, else ``current``; ``unknown``
    for a table that the manifest doesn't have."""
    j = consumers.join(tables.withColumn("__known", F.lit(True)), "table", "left")
    action = (F.when(F.col("__known").isNull(), "unknown")
               .when(F.col("consumer_epoch").isNull()
                     | (F.col("consumer_epoch") < F.col("base_epoch")), "full")
               .when(F.col("consumer_epoch") < F.col("latest_delta_epoch"), "incremental")
               .otherwise("current"))
    return j.withColumn("action", action).drop("__known")
