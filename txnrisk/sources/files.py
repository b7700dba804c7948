"""Folders and marker files of whatever file system Spark writes to, from the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    context = spark.sparkContext
    hadoop_path = context._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(context._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    system, at = _file_system(spark, path)
    return system.exists(at)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    system, at = _file_system(spark, path)
    if not system.exists(at):
        return []
    return [status.getPath().getName() for status in system.listStatus(at)]


def touch(spark: SparkSession, path: str) -> None:
    """Make an empty file."""
    system, at = _file_system(spark, path)
    system.create(at, True).close()


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder with all it holds, if it is there."""
    system, at = _file_system(spark, path)
    system.delete(at, True)
