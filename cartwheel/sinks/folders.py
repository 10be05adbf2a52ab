"""Folders of a table, through Hadoop's FileSystem, so on any storage the cluster mounts.

Listings are of folder names (batches, days), never of data files."""

from __future__ import annotations

from pyspark.sql import SparkSession

_WRITTEN = "_SUCCESS"       # fixed value: the mark Spark leaves behind a finished write


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def finished(spark: SparkSession, root: str, prefix: str) -> list[str]:
    """What follows ``prefix`` in the names of the finished folders below ``root``, sorted."""
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(n[len(prefix):] for n in names if n.startswith(prefix) and exists(spark, f"{root}/{n}/{_WRITTEN}"))


def publish(spark: SparkSession, staged: str, target: str) -> None:
    """The second step of a write: the finished folder takes its place at once."""
    fs, p = _fs(spark, target)
    fs.delete(p, True)          # what an attempt before left
    fs.mkdirs(p.getParent())
    if not fs.rename(_fs(spark, staged)[1], p):
        raise OSError(f"cannot move {staged} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)
