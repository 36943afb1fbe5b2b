"""Files of any Hadoop file system: what DataFrame readers and writers do not offer."""

from __future__ import annotations

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """The file system of ``path`` and the path in its own form."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def delete(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern."""
    fs, p = file_system(spark, pattern)
    return [s.getPath().toString() for s in fs.globStatus(p) or []]


def delete_matching(spark: SparkSession, pattern: str) -> None:
    for path in matching(spark, pattern):
        delete(spark, path)
