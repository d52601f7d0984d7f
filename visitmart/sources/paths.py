"""Path checks through the file system Spark itself uses, so they work for any storage."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: How stored Parquet is packed: hashes and JSON take about half the disk of the default codec's.
PACKED = {"compression": "zstd"}


def _open(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _open(spark, path)
    return bool(system.exists(where))


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none if it does not exist."""
    system, where = _open(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(where)) if system.exists(where) else []


def has_files(spark: SparkSession, path: str, suffix: str = ".parquet") -> bool:
    """Whether any data file lies under ``path``. Stops at the first."""
    system, where = _open(spark, path)
    if not system.exists(where):
        return False
    found = system.listFiles(where, True)
    while found.hasNext():
        name = found.next().getPath().getName()
        if name.endswith(suffix) and not name.startswith(("_", ".")):
            return True
    return False


def remove(spark: SparkSession, path: str) -> None:
    system, where = _open(spark, path)
    system.delete(where, True)
