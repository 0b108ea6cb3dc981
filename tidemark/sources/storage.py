"""Table layout: epoch-partitioned deltas and versioned bases.

    <root>/<schema.table>/deltas/__epoch=<n>/part-*.parquet
    <root>/<schema.table>/base/__base_epoch=<n>/part-*.parquet

Every compaction writes a *new* ``__base_epoch`` directory (never the one
being read).  Reads always pass an explicit schema, so partition values are
``bigint`` and files written before a column was added read it as NULL.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.constants import BASE_EPOCH, DELETED_AT, EPOCH, LSN, MOVED_FROM, OP, SEQ, TS, UNCHANGED
from tidemark.sources import fs


def table_root(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def delta_schema(data: T.StructType, with_source_meta: bool = True,
                 partial: bool = False, pk: list[str] | tuple[str, ...] = ()) -> T.StructType:
    """Schema of a table's deltas; ``partial``: with the columns not sent and, given
    the key columns, the old key of rows that moved."""
    fields = [T.StructField(OP, T.StringType(), False)]
    if with_source_meta:
        fields += [T.StructField(SEQ, T.LongType(), True),
                   T.StructField(LSN, T.StringType(), True),
                   T.StructField(TS, T.TimestampNTZType(), True)]
    if partial:
        fields.append(T.StructField(UNCHANGED, T.ArrayType(T.StringType()), True))
        if pk:
            fields.append(T.StructField(MOVED_FROM, T.StructType([f for f in data.fields if f.name in pk]), True))
    fields += [T.StructField(f.name, f.dataType, True) for f in data.fields]
    fields += [T.StructField(EPOCH, T.LongType(), False)]
    return T.StructType(fields)


def base_schema(data: T.StructType) -> T.StructType:
    return T.StructType(list(data.fields) + [T.StructField(DELETED_AT, T.TimestampNTZType(), True)])


def write_delta(df: DataFrame, root: str, table: str, single_epoch: bool = False) -> None:
    """Append-only per epoch: replaying an epoch replaces exactly its partition.

    With a sequence column, rows are range-partitioned on (epoch, seq): each
    task writes one contiguous run, so files per epoch stay few, and a hot
    epoch is split over several tasks by its sequence instead of landing in
    one.  Without it, rows are only sorted by epoch inside their task.
    ``single_epoch`` (a micro-batch is one epoch): every task already writes
    one file into the one partition, so no repartition (and no sampling job).
    """
    if not single_epoch:
        df = df.repartitionByRange(EPOCH, SEQ) if SEQ in df.columns \
            else df.sortWithinPartitions(EPOCH)
    (df.write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(EPOCH).parquet(f"{table_root(root, table)}/deltas"))


def write_rejects(df: DataFrame, root: str, table: str) -> None:
    """Values that failed to parse, kept per epoch beside the deltas
    (``_rejects/__epoch=N``; replay replaces the epoch's partition)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(EPOCH).parquet(f"{table_root(root, table)}/_rejects"))


def read_rejects(spark: SparkSession, root: str, table: str) -> DataFrame:
    path = f"{table_root(root, table)}/_rejects"
    schema = "seq bigint, table string, column_name string, raw string, __epoch bigint"
    if not fs.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def delta_epochs(spark: SparkSession, root: str, table: str) -> list[int]:
    """Epochs present on storage (directory names only, sorted numerically)."""
    out = []
    for name in fs.list_dirs(spark, f"{table_root(root, table)}/deltas"):
        if name.startswith(EPOCH + "="):
            out.append(int(name.split("=", 1)[1]))
    return sorted(out)


def read_deltas(spark: SparkSession, root: str, table: str, schema: T.StructType,
                after: int | None = None, upto: int | None = None) -> DataFrame:
    """Delta rows with epochs in (after, upto]; the filter prunes partitions."""
    path = f"{table_root(root, table)}/deltas"
    if not fs.exists(spark, path):
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).option("basePath", path).parquet(path)
    if after is not None:
        df = df.filter(F.col(EPOCH) > F.lit(after))
    if upto is not None:
        df = df.filter(F.col(EPOCH) <= F.lit(upto))
    return df


STORE_DB = "tidemark_store"


def bucket_table_name(root: str, table: str, epoch: int) -> str:
    """Catalog name that carries the bucket spec of one bucketed base
    (unique per storage root, table and epoch)."""
    flat = re.sub(r"[^0-9A-Za-z_]", "_", table)
    tag = hashlib.sha1(root.rstrip("/").encode()).hexdigest()[:10]
    return f"`{STORE_DB}`.`{flat}__{tag}__base_{epoch}`"


def write_base(df: DataFrame, root: str, table: str, epoch: int,
               buckets: int | None = None, pk: list[str] | None = None) -> int:
    """Write a new base at ``epoch``; returns its row count (observed during
    the write, no second pass).

    With ``buckets`` the base is bucketed and sorted by the key
    (``bucketBy``): later merges read it already hash-partitioned by the key,
    so the base is never shuffled.  Input that is already partitioned by the
    key into ``buckets`` partitions (a merge's output) is written without an
    exchange.
    """
    path = f"{table_root(root, table)}/base/{BASE_EPOCH}={epoch}"
    obs = Observation(f"base_{re.sub(r'[^0-9A-Za-z_]', '_', table)}_{epoch}")
    # Overwrite: a directory at this epoch can only be the leftover of a
    # failed attempt (the manifest names a base only after its write
    # succeeded, and callers never write the base they read), so a retry
    # replaces it instead of failing forever.
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    if buckets:
        if not pk:
            raise ValueError("a bucketed base needs its primary key")
        df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS `{STORE_DB}`")
        w.bucketBy(buckets, *pk).sortBy(*pk).option("path", path) \
         .saveAsTable(bucket_table_name(root, table, epoch))
    else:
        w.parquet(path)
    return int(obs.get["rows"])


def write_base_chunk(df: DataFrame, root: str, table: str, epoch: int, chunk: int) -> int:
    """Write one key range of a base into a folder of its own; its row count.  A retry
    replaces just that range."""
    obs = Observation(f"chunk_{re.sub(r'[^0-9A-Za-z_]', '_', table)}_{epoch}_{chunk}")
    (df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
       .parquet(f"{table_root(root, table)}/base/{BASE_EPOCH}={epoch}/__chunk={chunk}"))
    return int(obs.get["rows"])


def base_epochs(spark: SparkSession, root: str, table: str) -> list[int]:
    out = []
    for name in fs.list_dirs(spark, f"{table_root(root, table)}/base"):
        if name.startswith(BASE_EPOCH + "="):
            out.append(int(name.split("=", 1)[1]))
    return sorted(out)


def read_base(spark: SparkSession, root: str, table: str, schema: T.StructType,
              upto: int | None = None, buckets: int | None = None,
              pk: list[str] | None = None,
              published: list[int] | None = None) -> tuple[DataFrame, int | None]:
    """Newest base at or before ``upto``; (empty frame, None) when none.

    ``published`` are the bases the manifest names.  Other directories may be
    half written, so readers beside a running compaction pass it.

    A bucketed base is read through its catalog table (re-registered over
    the files when the catalog lost it), so the scan reports its bucketing.
    """
    eps = [e for e in base_epochs(spark, root, table) if (upto is None or e <= upto)
           and (published is None or e in published)]
    if not eps:
        return spark.createDataFrame([], schema), None
    e = eps[-1]
    path = f"{table_root(root, table)}/base/{BASE_EPOCH}={e}"
    if not buckets:
        # a snapshot taken in key ranges has a folder for each
        return spark.read.schema(schema).parquet(path).select(*schema.names), e
    name = bucket_table_name(root, table, e)
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    keys = ", ".join(f"`{k}`" for k in pk)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{STORE_DB}`")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet "
              f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS "
              f"LOCATION '{path}'")
    t = spark.table(name)
    # columns added to the schema after this base was written read as NULL
    return t.select(*[(F.col(f.name) if f.name in t.columns else F.lit(None))
                      .cast(f.dataType).alias(f.name) for f in schema.fields]), e


BUCKET = "__bucket"


def suggest_buckets(base_bytes: int, target_bytes: int = 512 << 20,
                    minimum: int = 8) -> int:
    """Bucket count for a base of ``base_bytes`` on storage: about one
    ``target_bytes`` file per bucket, rounded up to a power of two (so a
    later doubling splits every bucket in two).  At 100 TB and 512 MiB that
    is 262,144 buckets: each task of a compaction handles one bucket."""
    n = max(minimum, -(-base_bytes // target_bytes))
    return 1 << (n - 1).bit_length()


def bucket_of(pk: list[str], n: int) -> "F.Column":
    """Key-hash bucket of a row, 0 .. n-1.

    Exactly Spark's hash partitioning of the key into n partitions
    (``pmod(murmur3(key), n)``): a join shuffled on the key into n
    partitions leaves bucket b's rows in partition b.
    """
    return F.pmod(F.hash(*[F.col(k) for k in pk]), F.lit(n)).cast("int")


def write_base_buckets(df: DataFrame, root: str, table: str, epoch: int, n: int,
                       pk: list[str], clustered: bool = False) -> tuple[int, list[int]]:
    """Write the buckets present in ``df`` under ``base/__base_epoch=<epoch>/
    __bucket=<b>``; returns (rows, buckets written).

    ``clustered``: ``df`` is already hash-partitioned on the key into n
    partitions (a compaction join run with n shuffle partitions), so each
    task holds whole buckets and writes them as is.  Otherwise rows are
    repartitioned that way first: one file per bucket, not one per task.
    """
    path = f"{table_root(root, table)}/base/{BASE_EPOCH}={epoch}"
    obs = Observation(f"buckets_{re.sub(r'[^0-9A-Za-z_]', '_', table)}_{epoch}")
    if not clustered:
        df = df.repartition(n, *[F.col(k) for k in pk])
    out = df.withColumn(BUCKET, bucket_of(pk, n))
    # static overwrite: the whole epoch directory is replaced, so buckets
    # left by a failed attempt cannot survive next to this attempt's output
    (out.observe(obs, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite").option("partitionOverwriteMode", "static")
        .partitionBy(BUCKET).parquet(path))
    spark = df.sparkSession
    written = sorted(int(x.split("=", 1)[1]) for x in fs.list_dirs(spark, path)
                     if x.startswith(BUCKET + "="))
    return int(obs.get["rows"]), written


def read_base_buckets(spark: SparkSession, root: str, table: str, schema: T.StructType,
                      bucket_epochs: list[int | None],
                      only: list[int] | None = None) -> DataFrame:
    """Base rows of the chosen buckets, each from its own current epoch.

    Directory paths are computed from the manifest's vector (no listing);
    empty buckets (NULL epoch) are skipped.
    """
    want = range(len(bucket_epochs)) if only is None else only
    paths = [f"{table_root(root, table)}/base/{BASE_EPOCH}={bucket_epochs[b]}/{BUCKET}={b}"
             for b in want if bucket_epochs[b] is not None]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def drop_deltas(spark: SparkSession, root: str, table: str, upto: int) -> list[int]:
    """Remove consumed delta partitions (epoch <= upto).  Call only after the
    manifest naming the new base is published."""
    gone = []
    for e in delta_epochs(spark, root, table):
        if e <= upto and fs.delete(spark, f"{table_root(root, table)}/deltas/{EPOCH}={e}"):
            gone.append(e)
    return gone
