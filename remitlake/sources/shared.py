"""Intermediate results that must outlive an executor.

They go to the folder the cluster names in ``spark.checkpoint.dir``, which every executor can reach; where none is
named, to a folder below the session's warehouse. Each session writes to a folder of its own there, and the file
system removes that folder when the session's JVM ends.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_WAREHOUSE = "spark.sql.warehouse.dir"
_RUN = uuid.uuid4().hex

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
#: A file that is open takes memory for each of its columns.
OPEN_FILES = 8
_SPLIT = "spark.sql.files.maxPartitionBytes"
#: Stored rows are a twentieth of what they take in a sort, so a task reads fewer bytes of them than of other files.
SPLIT_BYTES = 16 << 20


def shared_folder(spark: SparkSession) -> str:
    named = spark.conf.get(_SETTING, None)
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get(_WAREHOUSE, None)
    if warehouse:
        return f"{warehouse.rstrip('/')}/_intermediate"
    raise RuntimeError(f"set {_SETTING} to a folder that all executors share")


@contextmanager
def _held(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """The session's settings inside; they are as they were afterwards."""
    usual = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in usual.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """What jobs started inside have shuffled is removed from the disks when each ends, and not at some later garbage collection.

    For steps that write: nothing reads their shuffles again. Jobs that run at the same time are started inside one such block.
    """
    with _held(spark, {_CLEANUP: "true"}):
        yield


@contextmanager
def few_folders_at_once(spark: SparkSession) -> Iterator[None]:
    """Tasks of writes started inside keep files in up to OPEN_FILES folders open, and sort rows by folder only where there are more."""
    with _held(spark, {_WRITERS: str(OPEN_FILES)}):
        yield


@contextmanager
def small_splits(spark: SparkSession) -> Iterator[None]:
    """Tasks of jobs started inside read at most SPLIT_BYTES, so that what they sort or group before a shuffle fits their memory."""
    usual = spark.conf.get(_SPLIT)
    small = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(usual) <= SPLIT_BYTES
    with _held(spark, {} if small else {_SPLIT: str(SPLIT_BYTES)}):
        yield


def _hadoop(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def run_folder(spark: SparkSession) -> str:
    """This session's own folder, made when first asked for and removed at the end of the JVM."""
    folder = f"{shared_folder(spark)}/remitlake-{spark.sparkContext.applicationId}-{_RUN}"
    files, where = _hadoop(spark, folder)
    if not files.exists(where):
        files.mkdirs(where)
        files.deleteOnExit(where)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{run_folder(spark)}/{uuid.uuid4().hex}/{name}"


def folder(spark: SparkSession, path: str) -> str:
    """The path, with an empty folder there if nothing was written to it."""
    files, where = _hadoop(spark, path)
    files.mkdirs(where)
    return path


def discard(spark: SparkSession, path: str) -> None:
    """Remove what was written to a path of ``fresh_path``, once nothing reads it any more."""
    files, where = _hadoop(spark, path)
    files.delete(where.getParent(), True)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder, once nothing reads it any more."""
    files, where = _hadoop(spark, path)
    files.delete(where, True)


def stored(df: DataFrame, name: str = "rows") -> DataFrame:
    """The same rows, computed once, written as Parquet to the shared folder and read from there."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def dropped(*frames: DataFrame) -> None:
    """Remove frames of ``stored`` that nothing reads any more: what was made from them must be stored itself."""
    for df in frames:
        discard(df.sparkSession, df.stored_at)
