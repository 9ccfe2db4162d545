"""Shared helpers of the operators: the run folder, written tables, files on shared storage."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession

from jobsheet.session import checkpoint_dir

_RUNS: dict[str, list[str]] = {}
_COLLECTING: list[list[str]] = []


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared checkpoint folder; no two calls get the same one."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _RUNS.setdefault(spark.sparkContext.applicationId, []).append(path)
    for paths in _COLLECTING:
        paths.append(path)
    return path


@contextlib.contextmanager
def collecting(paths: list[str]):
    """Notes in ``paths`` the folders that are made inside, so that their maker can delete them once it is done with them."""
    _COLLECTING.append(paths)
    try:
        yield
    finally:
        _COLLECTING.remove(paths)


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a table in the shared folder and read it back.  This cuts the
    lineage: a lost executor costs the running tasks, not the finished steps."""
    path = run_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_runs(spark: SparkSession) -> int:
    """Delete the folders this application made; call it when its results are no longer read."""
    paths = _RUNS.pop(spark.sparkContext.applicationId, [])
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return len(paths)


def delete_folder(spark: SparkSession, uri: str) -> None:
    """Delete a folder of this application whose table is no longer read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def make_folder(spark: SparkSession, uri: str) -> str:
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    return fs.makeQualified(path).toString()


def open_fs(uri: str):
    """``(filesystem, path)`` for a folder on shared storage, usable inside a task."""
    from pyarrow import fs

    if uri.startswith("file:/"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def small_batches(spark: SparkSession, rows: int = 2000, megabytes: int = 16) -> None:
    """Bound what one Arrow batch of long texts takes in a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{megabytes}m")


@contextlib.contextmanager
def bounded_batches(spark: SparkSession, rows: int = 2000, megabytes: int = 16):
    """As ``small_batches`` for the jobs that run inside; the session's settings return afterwards."""
    names = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")
    before = [spark.conf.get(n) for n in names]
    small_batches(spark, rows, megabytes)
    try:
        yield
    finally:
        for n, v in zip(names, before, strict=True):
            spark.conf.set(n, v)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def texts(column):
    """The texts of an Arrow column as Python strings, None where null."""
    return column.to_pylist()
