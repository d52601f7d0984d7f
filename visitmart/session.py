"""Session settings the library expects, and the shared folder for cut points."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from visitmart.sources.paths import PACKED


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "visitmart") -> SparkSession:
    """A session for tests and benchmarks. On a cluster use the session the cluster gives."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def tune(spark: SparkSession) -> SparkSession:
    """Let Spark leave whole-stage code that HotSpot would not compile.

    HotSpot interprets methods over 8000 bytes of bytecode. The wide projections here
    pass that; split into one method per group of columns they run twice as fast.
    A limit the user has set stays.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(name) == "65535":
        spark.conf.set(name, "8000")
    return spark


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Let shuffle files go with the query that made them; otherwise they stay until the driver collects garbage.

    For steps that write what they work out, and run none of their frames twice.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def widen(df: DataFrame, key: str) -> DataFrame:
    """Spread a scan of fewer splits than cores by ``key``; a scan of many splits stays as it is.

    Only small inputs are touched, where one file would keep all row work in one task.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own: on a cluster a
    machine-local folder would be lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="visitmart-")
    context.setCheckpointDir(folder)
    return folder


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder, so several readers see one evaluation of it."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as packed Parquet to the shared folder, and its shuffle files dropped.

    For wide frames: a checkpoint keeps rows as they are in memory, which takes many times the disk. The rows are kept, their
    order and partitions are not.
    """
    spark = df.sparkSession
    folder = f"{shared_dir(spark).rstrip('/')}/stored-{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        df.write.options(**PACKED).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
