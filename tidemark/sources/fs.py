"""Small-file and directory helpers through the Hadoop FileSystem API.

Used only for metadata (manifest headers, partition directory names,
dropping consumed delta partitions), so any Hadoop path scheme works.
"""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-directories of ``path`` (empty when it is missing)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in ``path`` (empty when it is missing)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isFile()]


def rename(spark: SparkSession, source: str, target: str) -> bool:
    """Rename to a name that is not taken; False if it is, or the source is gone."""
    fs, p = _fs(spark, source)
    return bool(fs.rename(p, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)))


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """Write a file of a new name: whole under another name first, then renamed,
    so readers see all of it or nothing."""
    tmp = f"{path}.{uuid.uuid4().hex}.tmp"
    fs, p = _fs(spark, tmp)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if exists(spark, path) or not rename(spark, tmp, path):
        fs.delete(p, False)
        raise FileExistsError(path)


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True)) if fs.exists(p) else False


def create_exclusive(spark: SparkSession, path: str, text: str = "") -> bool:
    """Create ``path`` only if absent (``create(overwrite=False)``); False if
    another writer holds it.  Atomic on HDFS and local file systems; on
    object stores use a committer / conditional-write capable scheme."""
    fs, p = _fs(spark, path)
    try:
        out = fs.create(p, False)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return True


def age_seconds(spark: SparkSession, path: str) -> float | None:
    """Seconds since ``path`` was last modified (None when missing)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    return time.time() - fs.getFileStatus(p).getModificationTime() / 1000.0


def touch(spark: SparkSession, path: str) -> None:
    """Set the modification time to now."""
    fs, p = _fs(spark, path)
    fs.setTimes(p, int(time.time() * 1000), -1)
