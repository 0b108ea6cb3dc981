"""Snapshot scans: a full, typed read of one source table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.types import spark_type


def snapshot_scan(spark: SparkSession, columns: list[dict], path: str | None = None,
                  jdbc: dict | None = None) -> DataFrame:
    """Read a snapshot from Parquet (``path``) or JDBC (``jdbc`` options) and
    type it by the manifest columns.

    Only the manifest columns are read (pruned at the scan).  For JDBC pass
    ``partitionColumn``/``lowerBound``/``upperBound``/``numPartitions`` so the
    read is split over executors; each partition opens its own session.
    """
    if jdbc is not None:
        df = spark.read.format("jdbc").options(**jdbc).load()
    elif path is not None:
        df = spark.read.parquet(path)
    else:
        raise ValueError("need a path or jdbc options")
    return df.select(*[F.col(c["name"]).cast(spark_type(c["pg_type"])).alias(c["name"])
                       for c in columns])
