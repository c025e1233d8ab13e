"""A folder for files that only live as long as the session."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyarrow import fs
from pyspark.sql import SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir, or in local mode without it below a temporary folder; it goes with the driver's JVM."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="formloom-")
    path = f"{base.rstrip('/')}/formloom-{name}-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def drop_files(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder of many files, as sinks.write_files writes them: several at a time, as a disk may take over a millisecond to free one."""
    store, root = fs.FileSystem.from_uri(path)
    files = [f.path for f in store.get_file_info(fs.FileSelector(root, allow_not_found=True)) if f.is_file]
    with ThreadPoolExecutor(16) as pool:
        list(pool.map(store.delete_file, files))
    drop(spark, path)


def drop(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it, a query's shuffle files go when the query ends, not when the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)
