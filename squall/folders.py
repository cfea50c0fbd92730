"""Folder listings and marks on the file system of a path (metadata only)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def folder(spark: SparkSession, path: str):
    """(file system, Hadoop path)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def names(spark: SparkSession, path: str) -> list[str]:
    """Sorted names in a folder; none if it is not there."""
    fs, p = folder(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, p = folder(spark, path)
    fs.delete(p, True)


def mark(spark: SparkSession, path: str) -> bool:
    """Create an empty file in one step; false if it stands already."""
    fs, p = folder(spark, path)
    fs.mkdirs(p.getParent())
    return fs.createNewFile(p)


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, p = folder(spark, source)
    _, q = folder(spark, target)
    fs.mkdirs(q.getParent())
    if not fs.rename(p, q):
        raise RuntimeError(f"could not move {source} to {target}")
