"""Change events -> epoch-partitioned deltas with Structured Streaming.

One micro-batch is one epoch.  The epoch is allocated through the manifest
per (stream, batch id): a replayed batch keeps its id and so its epoch, a
new batch of any stream gets one past the newest epoch, so several streams
can write into one root without ever reusing an epoch.  The checkpoint holds
the source position (resume), and each table's epoch partition is written
with dynamic overwrite, so a replay replaces exactly what it wrote.  The
manifest is published after the data (consumers never see an epoch whose
files are missing), and a failed batch fails the query instead of being
dropped; Spark re-runs it on restart.

A batch is read once: it is dealt by table into ``<root>/_staging/<epoch>``,
and each table's deltas are then made from that table's own files.  So the work
follows the events, however many tables a batch holds, nothing is kept in
executors' memory, and a lost executor costs no second read of the source.

Sources deliver at least once.  An event that has landed in an earlier batch is
counted in the ledger and not written again, and one that comes twice within a
batch is written once (``sources.positions``); so an old event that arrives again
never wins over a newer one.

Row images travel as ``map<string,string>``, so the stream schema never
changes; columns added at the source appear as new map keys, are confirmed
against the source catalog and appended to the table schema per batch.  Values
of columns that the source catalog doesn't confirm become rejects.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.constants import EPOCH, SEQ
from tidemark.operators.events import (EVENT_SCHEMA, after_snapshot, decode_events, decode_rejects,
                                       split_key_changes, with_order)
from tidemark.operators.schema import evolve, new_columns, unknown_columns, unknown_rejects
from tidemark.sources import fs, manifest, positions, storage
from tidemark.functions.lsn import lsn_to_long
from tidemark.functions.types import category, coerce, spark_type

#: Tasks that one table's events of a batch are spread over at most.
SPREAD = 64


def change_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                  max_files: int | None = None, schema: str = EVENT_SCHEMA) -> DataFrame:
    """Streaming frame of change events from files landing under ``path``.

    ``max_files`` caps the files per micro-batch (the row cap of a flush);
    a Kafka source would use ``maxOffsetsPerTrigger`` the same way.
    """
    r = spark.readStream.schema(schema).format(fmt)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def parse_events(value) -> "F.Column":
    """JSON event text -> event struct (``EVENT_SCHEMA``).

    Row values of any JSON type arrive as text (numbers, booleans, nested
    JSON kept verbatim), ready for typed decoding.
    """
    return F.from_json(value, EVENT_SCHEMA)


def events_from_json(df: DataFrame, value_col: str = "value") -> DataFrame:
    return df.select(parse_events(F.col(value_col).cast("string")).alias("__e")).select("__e.*")


def kafka_change_stream(spark: SparkSession, servers: str, topic: str,
                        max_offsets: int | None = None,
                        starting: str = "earliest") -> DataFrame:
    """Change events from a Kafka topic of JSON events.

    Needs the ``spark-sql-kafka`` package on the classpath (not bundled
    here).  ``max_offsets`` caps events per micro-batch (the flush size).
    """
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting))
    if max_offsets:
        r = r.option("maxOffsetsPerTrigger", max_offsets)
    return events_from_json(r.load())


class EpochWriter:
    """The ``foreachBatch`` function of ``stream_to_epochs``.

    ``catalog``: table -> manifest column list; ``source_columns``: the source's
    current columns (for additive evolution), as a fixed table -> column list or
    as the path of a Parquet table (table, column, pg_type, nullable, ordinal),
    which is read anew for each batch.  Without an entry no column is confirmed.
    ``published(spark, tables)`` is called after each epoch with the tables it has
    changes of (to publish their views again, for example).
    """

    def __init__(self, root: str, catalog: dict[str, list[dict]], first_epoch: int = 1,
                 source_columns: dict[str, list[dict]] | str | None = None,
                 on_error: str = "null", parallelism: int = 4,
                 keep_rejects: bool = True, stream: str | None = None, published=None):
        self.root = root
        self.catalog = {t: list(c) for t, c in catalog.items()}
        self.versions = {t: 1 for t in catalog}
        self.first_epoch = first_epoch
        self.source_columns = source_columns or {}
        self.on_error = on_error
        self.parallelism = parallelism
        self.keep_rejects = keep_rejects
        self.stream = stream
        self.published = published
        self.primary_keys: dict[str, list[str]] = {}
        self.by_manifest = False

    @classmethod
    def from_manifest(cls, spark: SparkSession, root: str, checkpoint: str | None = None,
                      **kw) -> "EpochWriter":
        """A writer that takes each batch's schemas from the manifest: of the active tables
        that the batch has events of, whatever the catalog's size.  With ``checkpoint``
        each batch's epoch is allocated through the manifest (see
        ``manifest.allocate_epoch``)."""
        if checkpoint is not None:
            kw.setdefault("stream", checkpoint)
        w = cls(root, {}, **kw)
        w.by_manifest = True
        return w

    def _take_entries(self, entries: list) -> None:
        """The schemas of a batch's tables as the manifest has them now."""
        self.catalog = {r["table"]: [c.asDict() for c in (r["columns"] or [])] for r in entries if r["status"] == "active"}
        self.primary_keys = {r["table"]: list(r["primary_key"] or []) for r in entries}
        self.versions = {r["table"]: int(r["schema_version"] or 1) for r in entries}

    def _evolve(self, batch: DataFrame, table: str) -> bool:
        known = [c["name"] for c in self.catalog[table]]
        if isinstance(self.source_columns, str):
            src = batch.sparkSession.read.parquet(self.source_columns).where(F.col("table") == table)
            confirmed = new_columns(unknown_columns(batch, known), src) \
                .select(F.col("column").alias("name"), "pg_type", "nullable").collect()
            added = [c.asDict() for c in confirmed]
        else:
            src = self.source_columns.get(table)
            if not src:
                return False
            unk = {r["column"] for r in unknown_columns(batch, known).select("column").collect()}
            added = [c for c in src if c["name"] in unk]
        cols, v = evolve(self.catalog[table], added, self.versions[table])
        changed = v != self.versions[table]
        self.catalog[table], self.versions[table] = cols, v
        return changed

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # stable under replay, never reused: allocated per (stream, batch)
        # through the manifest, or first_epoch + batch_id for a lone stream
        epoch = manifest.allocate_epoch(spark, self.root, self.stream, batch_id) \
            if self.stream else self.first_epoch + batch_id
        staging = f"{self.root.rstrip('/')}/_staging/{epoch}"
        try:
            written = self._write(with_order(batch), epoch, staging)
            if written:
                self._publish(spark, written, epoch)
                if self.published:
                    self.published(spark, [w[0] for w in written])
            else:
                manifest.finish_epoch(spark, self.root, self.stream, epoch)
        finally:
            fs.delete(spark, staging)

    def _write(self, events: DataFrame, epoch: int, staging: str) -> list[tuple]:
        """Write the deltas of every table in ``events``; what to publish of each."""
        spark = events.sparkSession
        # a table's folder is named by a digest: a name may be longer than a file's may be
        dealt = (events.withColumn("__t", F.md5("table")).withColumn(positions.EVENT_ID, positions.event_id())
                       .withColumn("__spread", F.pmod(F.xxhash64("seq", "lsn"), F.lit(SPREAD)))
                       .repartition("__t", "__spread")
                       # the same event twice; without a place in the order each is a reject of its own
                       .withColumn("__nth", F.when(F.col("seq").isNull(), F.monotonically_increasing_id()))
                       .withColumn("__copy", F.row_number().over(
                           Window.partitionBy("__t", "__spread", "seq", positions.EVENT_ID, "__nth").orderBy("lsn")))
                       .where("__copy = 1").drop("__spread", "__nth", "__copy"))
        dealt.write.mode("overwrite").partitionBy("__t").parquet(staging)
        schema = dealt.drop("__t").schema
        staged = spark.read.schema(dealt.schema).parquet(staging)
        counted = staged.groupBy("__t", "table").agg(
            F.count(F.lit(1)).alias("n"), F.min("seq").alias("lo"), F.max("seq").alias("hi")).collect()
        entries = manifest.read_tables(spark, self.root).where(F.md5("table").isin([r["__t"] for r in counted])) \
            .select("table", "status", "columns", "primary_key", "schema_version", "position", "snapshot").collect()
        if self.by_manifest:
            self._take_entries(entries)
        # tables that are not active, or have no schema to decode by, are skipped
        found = {r["table"]: r for r in counted if self.catalog.get(r["table"])}
        todo, known = sorted(found), {r["table"]: r for r in entries}
        if not todo:
            return []
        batch = F.col("__t").isin([r["__t"] for r in found.values()])
        # one write job per table, its rejects beside it; up to ``parallelism`` tables at once
        with ThreadPoolExecutor(max_workers=max(1, self.parallelism)) as pool, \
                ThreadPoolExecutor(max_workers=max(1, self.parallelism)) as beside:
            remembered = beside.submit(positions.write_positions, staged.where(batch), self.root, epoch)
            done = list(pool.map(lambda t: self._write_table(
                spark.read.schema(schema).parquet(f"{staging}/__t={found[t]['__t']}"), t, epoch,
                found[t], known.get(t), beside), todo))
            remembered.result()
        positions.write_ledger(spark, self.root, epoch, [ledger for _, ledger in done])
        return [written for written, _ in done]

    def _write_table(self, rows: DataFrame, t: str, epoch: int, of, known, beside: ThreadPoolExecutor):
        """Write one table's deltas and rejects; what to publish of it, and its row of the ledger."""
        spark, tag = rows.sparkSession, f"{of['__t']}_{epoch}"
        if known and known["position"] is not None and of["lo"] is not None and of["lo"] <= known["position"]:
            rows = rows.join(positions.landed_before(spark, self.root, t, epoch, of["lo"], min(of["hi"], known["position"])),
                             ["seq", positions.EVENT_ID], "left_anti")
        evolved = self._evolve(rows, t)
        columns, keys, at = self.catalog[t], self.primary_keys.get(t, []), F.lit(epoch).cast("bigint")
        unconfirmed = unknown_rejects(rows, [c["name"] for c in columns])
        new, kept = Observation(f"new_{tag}"), Observation(f"kept_{tag}")
        changes = rows.observe(new, F.count(F.lit(1)).alias("n"))
        if keys:
            rows, changes = split_key_changes(rows, keys), split_key_changes(changes, keys)
        due = F.lit(True)
        if keys and known and known["snapshot"]:
            first = next(c for c in columns if c["name"] == keys[0])
            due = after_snapshot(known["snapshot"], coerce(F.element_at("row", keys[0]), first["pg_type"]),
                                 spark_type(first["pg_type"]), F.coalesce(lsn_to_long(F.col("lsn")), "seq"))
        partial = F.count_if(F.size("unchanged") > 0) if "unchanged" in rows.columns else F.lit(0)
        changes = changes.withColumn("__due", due).observe(
            kept, F.count_if(~F.col("__due")).alias("in_snapshot"), partial.alias("partial")).where("__due").drop("__due")
        # a change without its whole key, or its place in the order, can't be
        # merged: it is a reject, never a delta
        typed = decode_events(changes, columns, self.on_error, primary_key=keys).withColumn(EPOCH, at) \
            .dropna(subset=[*keys, SEQ])
        rejected = None
        if self.keep_rejects:
            rows = rows.where(due)
            bad = decode_rejects(rows, columns, keys, order=True).unionByName(unconfirmed)
            rejected = beside.submit(storage.write_rejects, bad.withColumn(EPOCH, at), self.root, t)
        storage.write_delta(typed, self.root, t, single_epoch=True)
        if rejected:
            rejected.result()
        n, in_snapshot = new.get["n"], kept.get["in_snapshot"] or 0
        ledger = (t, of["n"], n - in_snapshot, of["n"] - n, in_snapshot, of["lo"], of["hi"])
        return (t, epoch, self.versions[t], evolved, True if kept.get["partial"] else None, of["hi"]), ledger

    def _publish(self, spark: SparkSession, written, epoch: int) -> None:
        rows = [(t, e, v, [{"name": c["name"], "pg_type": c["pg_type"],
                            "parquet_type": category(c["pg_type"]),
                            "nullable": c.get("nullable", True),
                            "precision": c.get("precision"), "scale": c.get("scale")}
                           for c in self.catalog[t]], partial, hi)
                for t, e, v, _, partial, hi in written]
        change = spark.createDataFrame(
            rows, "table string, latest_delta_epoch bigint, schema_version bigint, "
                  "columns array<struct<name:string,pg_type:string,parquet_type:string,"
                  "nullable:boolean,precision:int,scale:int>>, partial_images boolean, position bigint")
        manifest.update_tables(spark, self.root, change, finished=(self.stream, epoch))


def stream_to_epochs(events: DataFrame, writer: EpochWriter, checkpoint: str,
                     trigger: dict | None = None) -> StreamingQuery:
    """Start the query; default trigger drains what is available and stops."""
    trigger = trigger or {"availableNow": True}
    return (events.writeStream.foreachBatch(writer)
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger).start())
