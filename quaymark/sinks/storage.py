"""Small driver-side helpers over the Hadoop file system (control files only)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    jpath, fs = _path(spark, path)
    return fs.exists(jpath)


def child_names(spark: SparkSession, path: str) -> list[str]:
    jpath, fs = _path(spark, path)
    if not fs.exists(jpath):
        return []
    return [status.getPath().getName() for status in fs.listStatus(jpath)]


def delete(spark: SparkSession, path: str) -> None:
    jpath, fs = _path(spark, path)
    fs.delete(jpath, True)


def size(spark: SparkSession, path: str) -> int:
    """Bytes below a path or glob, from file-system metadata."""
    jpath, fs = _path(spark, path)
    return sum(fs.getContentSummary(s.getPath()).getLength() for s in fs.globStatus(jpath) or [])
