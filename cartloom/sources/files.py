"""The few file-system calls DataFrames have no word for, on any Hadoop file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _locate(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _locate(spark, path)
    return system.exists(place)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file."""
    system, place = _locate(spark, path)
    return system.getFileStatus(place).getLen()


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder, in order; none if it does not exist."""
    system, place = _locate(spark, path)
    return sorted(f.getPath().getName() for f in system.listStatus(place)) if system.exists(place) else []


def create(spark: SparkSession, path: str) -> None:
    """Make an empty file, in one step; it is an error if it is there."""
    system, place = _locate(spark, path)
    system.create(place, False).close()


def remove(spark: SparkSession, path: str) -> None:
    system, place = _locate(spark, path)
    system.delete(place, True)
