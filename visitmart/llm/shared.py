"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from visitmart.session import shared_dir


def folder(spark: SparkSession, name: str) -> str:
    """A new folder name under ``spark.checkpoint.dir``."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet and read again; a lost executor loses nothing of it."""
    spark = df.sparkSession
    path = folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing reads any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def importable(spark: SparkSession) -> SparkSession:
    """Set a session up for Python workers on texts.

    Workers can import this package from the driver's source folder, where it is not installed; and Arrow batches
    hold 1,000 rows at most, unless the user has set a number: the default of 10,000 suits numbers, not long texts.
    """
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(":"):
        environment["PYTHONPATH"] = f"{root}:{known}" if known else root
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == "10000":
        spark.conf.set(rows, "1000")
    return spark
