"""Snapshot to stream without a gap: which changes a snapshot holds already.

A large table is read in key ranges, one after the other, while it changes.  The
log position is taken before and after each range is read.  A change of a
key at or before its range's low position is in the rows already: it is skipped,
as an older value must not overwrite a newer one.  One between the low and the
high position may or may not be: it is applied, and its image replaces the row.
Later ones are ordinary changes.  So the stream may start anywhere at or before
the lowest low position, and no range waits for another.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.constants import DELETED_AT
from tidemark.functions.lsn import lsn_to_long
from tidemark.functions.types import spark_type
from tidemark.sources import fs, manifest, storage
from tidemark.sources.snapshot import snapshot_scan


def key_text(value) -> str | None:
    """A bound as the text that ``from_key`` keeps."""
    if value is None or isinstance(value, str):
        return value
    return value.isoformat(sep=" ") if isinstance(value, datetime) else str(value) if not isinstance(value, date) else value.isoformat()


def snapshot_in_ranges(spark: SparkSession, root: str, table: str, columns: list[dict], primary_key: list[str],
                       bounds: list, position: Callable[[], str],
                       read: Callable[[object, object], DataFrame] | None = None,
                       path: str | None = None, jdbc: dict | None = None) -> tuple[int, list[dict]]:
    """Read ``table`` in ranges of its first key column into the base at epoch 0.

    ``bounds`` are the ascending values at which the second and each later range
    begin; ``position()`` is the source's current log position (LSN text).
    ``read(lo, hi)`` gives a range's rows (``lo <= key < hi``, ``None``: open); without it the
    range is a filter on ``path`` or ``jdbc``, pushed into the scan.  Returns the rows
    and the ranges for the manifest's ``snapshot``.

    A range that is written leaves a mark with its positions; after a failure only
    the others are read.
    """
    first = primary_key[0]
    typed = next(c for c in columns if c["name"] == first)
    starts = [None, *bounds]

    def scan(lo, hi):
        df = snapshot_scan(spark, columns, path=path, jdbc=jdbc)
        as_key = lambda v: F.lit(v).cast(spark_type(typed["pg_type"]))
        return df.where((F.col(first) >= as_key(lo) if lo is not None else F.lit(True))
                        & (F.col(first) < as_key(hi) if hi is not None else F.lit(True)))

    rows, chunks = 0, []
    for i, (lo, hi) in enumerate(zip(starts, [*bounds, None], strict=True)):
        mark = f"{storage.table_root(root, table)}/_snapshot/range-{i}.json"
        if fs.exists(spark, mark):
            done = json.loads(fs.read_text(spark, mark))
        else:
            low = position()
            df = (read or scan)(lo, hi).withColumn(DELETED_AT, F.lit(None).cast("timestamp_ntz"))
            n = storage.write_base_chunk(df, root, table, 0, i)
            done = {"from_key": key_text(lo), "low": low, "high": position(), "rows": n}
            fs.write_new(spark, mark, json.dumps(done))
        rows += done.pop("rows")
        chunks.append(done)
    return rows, chunks


def start_position(tables: DataFrame) -> DataFrame:
    """``start_lsn`` (one row): the lowest low position of any active table's snapshot, at or
    before which a stream has to start."""
    lows = tables.where("status = 'active'").select(F.explode("snapshot.low").alias("lsn"))
    return lows.agg(F.min_by("lsn", lsn_to_long(F.col("lsn"))).alias("start_lsn"))
