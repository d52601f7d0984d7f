"""Writers, and the raw envelope that Bronze rows carry."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitmart import schema as S
from visitmart.operators.shape import pick, validate_key
from visitmart.operators.silver import split_silver
from visitmart.session import shuffles_dropped
from visitmart.sources.buckets import BucketStore, bucket_number
from visitmart.sources.paths import PACKED, children, exists, remove

# Fixed value: the names a table may have.
IDENTIFIER = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def to_raw_envelope(df: DataFrame, stream: str, emitted_at: str) -> DataFrame:
    """The row's own id, time of sync, stream and JSON copy, followed by the original columns."""
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
    return df.select(
        F.uuid().alias("_airbyte_ab_id"),
        F.lit(emitted_at).alias("_airbyte_emitted_at"),
        F.lit(stream).alias("_airbyte_stream"),
        row.alias("_airbyte_data"),
        "*",
    )


@contextmanager
def spooled(df: DataFrame, folder: str) -> Iterator[DataFrame]:
    """``df`` as Parquet in a folder of its own while it is read several times. The folder goes afterwards.

    A wide frame takes a small part of the disk that it takes in the cache, and its shuffle files are not held by it.
    """
    df.write.options(**PACKED).mode("overwrite").parquet(folder)
    try:
        yield df.sparkSession.read.schema(df.schema).parquet(folder)
    finally:
        remove(df.sparkSession, folder)


def with_load_partitions(df: DataFrame, now: str) -> DataFrame:
    """``now`` is an ISO time in UTC; its date and hour name the partition."""
    return df.withColumns({"load_date": F.lit(now[:10]), "load_hour": F.lit(now[11:13])})


def write_bronze(df: DataFrame, root: str, now: str, max_rows: int = 5000) -> None:
    """Append raw rows below ``load_date=/load_hour=``, at most ``max_rows`` per file."""
    (
        with_load_partitions(df, now)
        .write.options(**PACKED)
        .partitionBy("load_date", "load_hour")
        .option("maxRecordsPerFile", max_rows)
        .mode("append")
        .parquet(root)
    )


def write_silver(tables: dict[str, DataFrame], root: str, process_date: str, batch: int | None = None) -> None:
    """Each table below ``process_date=``. A numbered batch has a folder of its own and may be written again."""
    for name, table in tables.items():
        folder = f"{root}/{name}/process_date={process_date}"
        if batch is None:
            table.write.options(**PACKED).mode("append").parquet(folder)
        else:
            table.write.options(**PACKED).mode("overwrite").parquet(f"{folder}/batch={batch:06d}")


def write_wide_silver(
    wide: DataFrame,
    root: str,
    process_date: str,
    batch: int | None = None,
    rows_per_file: int = 250_000,
    carried: list[str] | None = None,
    buckets: int | None = None,
) -> None:
    """Split wide rows into the four tables and write them, working the rows out once for all four.

    A small batch is written to few files: the plans of a stream's batch keep all
    shuffle partitions, however few rows they hold. With ``buckets`` a table's rows lie below ``bucket=<k>of<buckets>``
    by their hash, the date and batch below that, so the rows of a hash are found without reading the others.
    """
    if buckets:
        label = F.format_string(f"%05dof{buckets:05d}", bucket_number(["record_hash"], buckets))
        stored = [c for columns in S.SILVER_TABLES.values() for c in columns] + [*(carried or []), "bucket"]
        # The hint splits a large bucket over several tasks, and deals small ones together.
        kept = pick(wide.withColumn("bucket", label), stored).hint("rebalance", "bucket")
        with spooled(kept, f"{root}_spool/batch={batch or 0:06d}") as rows:
            for name, table in split_silver(rows, carried=[*(carried or []), "bucket"]).items():
                parts = table.withColumns({"process_date": F.lit(process_date), "batch": F.lit(f"{batch or 0:06d}")})
                (
                    parts.write.options(**PACKED)
                    .partitionBy("bucket", "process_date", "batch")
                    .option("partitionOverwriteMode", "dynamic")
                    .mode("append" if batch is None else "overwrite")
                    .parquet(f"{root}/{name}")
                )
        return
    kept = pick(wide, [c for columns in [*S.SILVER_TABLES.values(), carried or []] for c in columns])
    with shuffles_dropped(wide.sparkSession), spooled(kept, f"{root}_spool/{uuid.uuid4().hex}") as rows:
        wanted = max(1, -(-rows.count() // rows_per_file))
        fewer = rows.coalesce(wanted) if wanted < rows.rdd.getNumPartitions() else rows
        write_silver(split_silver(fewer, carried=carried), root, process_date, batch)


def _complete_versions(spark: SparkSession, path: str) -> list[int]:
    names = [name for name in children(spark, path) if name.startswith("version=")]
    return sorted(int(name[8:]) for name in names if exists(spark, f"{path}/{name}/_SUCCESS"))


def read_mart(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest complete version of a mart, or the mart of that name in a bucketed store; None if there is neither."""
    root, _, name = path.rstrip("/").rpartition("/")
    stored = BucketStore(spark, root).read(name)
    if stored is not None:
        return stored
    versions = _complete_versions(spark, path)
    return spark.read.parquet(f"{path}/version={versions[-1]:06d}") if versions else None


def write_mart(df: DataFrame, path: str, keep: int = 2) -> int:
    """Replace a mart as a whole: a new version beside the old ones, which readers take once it is complete.

    The version being read is never overwritten. The last ``keep`` versions stay, for readers still on them.
    """
    spark = df.sparkSession
    versions = _complete_versions(spark, path)
    number = versions[-1] + 1 if versions else 1
    df.write.mode("overwrite").parquet(f"{path}/version={number:06d}")
    for old in [*versions, number][:-keep]:
        remove(spark, f"{path}/version={old:06d}")
    return number


CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header line; blanks around values are kept."""
    df.write.options(**CSV_OPTIONS).mode(mode).csv(path)


def write_report(df: DataFrame, path: str) -> None:
    """A one-row report as JSON, missing values written out."""
    df.coalesce(1).write.option("ignoreNullFields", False).mode("overwrite").json(path)


def check_identifier(name: str) -> str:
    if not IDENTIFIER.match(name):
        raise ValueError(f"unsafe SQL identifier: {name}")
    return name


def publish_table(
    df: DataFrame,
    url: str,
    schema: str,
    table: str,
    key: list[str],
    properties: dict[str, str] | None = None,
    connections: int = 8,
) -> None:
    """Replace a database table by ``df`` after its key is checked; 1000 rows per insert.

    Every identifier is checked before anything is sent. Missing values go out as NULL.
    """
    for name in (schema, table, *key):
        check_identifier(name)
    validate_key(df, key, table)
    (
        df.write.mode("overwrite")
        .option("batchsize", 1000)
        .option("numPartitions", connections)
        .jdbc(url, f"{schema}.{table}", properties=properties or {})
    )


# The published marts and their keys.
MART_KEYS = {
    "doctor_patient_risk_mart": ["record_hash"],
    "admin_hospital_kpi_mart": ["as_of_date", "hospitalid"],
    "admin_department_kpi_mart": ["as_of_date", "hospitalid", "unittype"],
}


def publish_marts(
    marts: dict[str, DataFrame], url: str, schema: str = "analytics", properties: dict[str, str] | None = None
) -> None:
    """Publish the three marts under their usual names and keys."""
    for name, key in MART_KEYS.items():
        publish_table(marts[name], url, schema, name, key, properties)
