"""The few file-system steps that DataFrames have no word for, through Spark's own file systems.

Paths may be on any store that Spark reads. Renames publish whole folders; they
are atomic on HDFS-like stores.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders, sorted; none if there is no such folder."""
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def files(spark: SparkSession, path: str) -> list[str]:
    """Names of the Parquet files right under a folder, sorted; none if there is no such folder."""
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isFile() and s.getPath().getName().endswith(".parquet"))


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename one file."""
    fs, to = _at(spark, target)
    if not fs.rename(_at(spark, source)[1], to):
        raise OSError(f"cannot move {source} to {target}")


def make(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.mkdirs(p)


def publish(spark: SparkSession, staged: str, target: str) -> bool:
    """Move a staged folder to its place unless something stands there; whether it moved."""
    fs, to = _at(spark, target)
    if fs.exists(to):
        return False
    fs.mkdirs(to.getParent())
    if not fs.rename(_at(spark, staged)[1], to):
        if fs.exists(to):
            return False
        raise OSError(f"cannot move {staged} to {target}")
    return True


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)
