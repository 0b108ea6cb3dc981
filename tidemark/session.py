"""Session construction and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "tidemark", master: str | None = None,
              shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the library assumes: AQE on, UTC clock.

    On a cluster pass ``master=None`` and let spark-submit decide; size
    ``shuffle_partitions`` to the data (AQE coalesces small ones at runtime).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.session.timeZone", "UTC")
          # checkpoint files go once nothing refers to them any more
          .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
          .config("spark.ui.enabled", "false"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Where the session names none, a local run (tests) gets a folder of its
    own.  A cluster does not: each node would see another folder, so that is
    an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all nodes share")
        d = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def checkpoint(df: DataFrame) -> DataFrame:
    """``df.checkpoint()`` into the shared folder (reliable: survives the loss
    of executors; never a local checkpoint).  Registers the folder with the
    context first when only the session conf names it."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared folder (never reused)."""
    return f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex[:12]}"
