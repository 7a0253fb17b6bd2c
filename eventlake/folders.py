"""Looking at and removing folders on whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    return own, own.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is there (any other failure to look is an error, not an absence)."""
    own, fs = _at(spark, path)
    return bool(fs.exists(own))


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly under ``path``, in order; none if it is not there."""
    own, fs = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(own)) if fs.exists(own) else []


def remove(spark: SparkSession, path: str) -> bool:
    own, fs = _at(spark, path)
    return bool(fs.delete(own, True))
