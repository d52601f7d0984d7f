"""Operators on rows and columns that know nothing about visits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def pick(df: DataFrame, columns: list[str]) -> DataFrame:
    """The listed columns that exist, in list order, each once."""
    present = set(df.columns)
    return df.select([name for name in dict.fromkeys(columns) if name in present])


def ensure_columns(df: DataFrame, schema: StructType) -> DataFrame:
    """Add each column of ``schema`` that ``df`` lacks, as missing values of its type."""
    present = set(df.columns)
    absent = {
        field.name: F.lit(None).cast(field.dataType) for field in schema if field.name not in present
    }
    return df.withColumns(absent) if absent else df


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Stack frames by column name; columns a frame lacks become null."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def dedup_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the greatest by ``order``, which must be a total order within a key.

    The rank filter lets Spark keep one row per key before the shuffle as well,
    so a key holding a large part of the rows sends one row per task.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.col(name).desc_nulls_last() for name in order])
    return df.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def upsert_keys(existing: DataFrame, incoming: DataFrame) -> list[str]:
    """The hash where every row has one; else the visit keys; else nothing (whole rows count)."""
    columns = set(existing.columns) | set(incoming.columns)
    if "record_hash" in columns:
        sides = [side for side in (existing, incoming) if "record_hash" in side.columns]
        complete = len(sides) == 2 and all(side.where("record_hash IS NULL").isEmpty() for side in sides)
        if complete:
            return ["record_hash"]
    visit = ["patientunitstayid", "patienthealthsystemstayid", "processed_at_utc"]
    return [name for name in visit if name in columns]


def upsert(
    existing: DataFrame, incoming: DataFrame, order: list[str], keys: list[str] | None = None
) -> DataFrame:
    """Rows of ``existing`` replaced by those of ``incoming`` with the same key, plus the new ones.

    With the hash as key, ``existing`` is unique on it (it is an earlier result of
    this operator), so an anti join is enough and the large side needs no
    window. The other key choices deduplicate both sides together.
    """
    keys = upsert_keys(existing, incoming) if keys is None else keys
    if not keys:
        return existing.unionByName(incoming, allowMissingColumns=True).dropDuplicates()
    if keys == ["record_hash"]:
        latest = dedup_last(incoming, keys, order)
        kept = existing.join(latest.select("record_hash"), "record_hash", "left_anti")
        columns = list(dict.fromkeys(existing.columns + incoming.columns))
        return kept.unionByName(latest, allowMissingColumns=True).select(columns)
    both = existing.withColumn("_side", F.lit(0)).unionByName(
        incoming.withColumn("_side", F.lit(1)), allowMissingColumns=True
    )
    return dedup_last(both, keys, ["_side", *order]).drop("_side")


def key_violations(df: DataFrame, key: list[str]) -> DataFrame:
    """One row: how many rows have a null in the key, and how many share their key with another."""
    any_null = reduce(lambda left, right: left | right, [F.col(name).isNull() for name in key])
    groups = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum(F.when(any_null, F.col("_n"))), F.lit(0)).alias("null_key_rows"),
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("duplicate_key_rows"),
    )


def validate_key(df: DataFrame, key: list[str], table: str = "table") -> DataFrame:
    """``df`` itself, or an error naming the columns or the number of rows that break the key."""
    missing = [name for name in key if name not in df.columns]
    if missing:
        raise ValueError(f"{table}: key columns {missing} are missing")
    found = key_violations(df, key).first()
    if found["null_key_rows"]:
        raise ValueError(f"{table}: {found['null_key_rows']} rows have a null in key {key}")
    if found["duplicate_key_rows"]:
        raise ValueError(f"{table}: {found['duplicate_key_rows']} rows share a value of key {key}")
    return df


def pending_files(files: DataFrame, processed: DataFrame) -> DataFrame:
    """File paths not processed yet, sorted."""
    return files.join(processed.select("path"), "path", "left_anti").orderBy("path")


def rows_after(df: DataFrame, order: str, last) -> DataFrame:
    """Rows whose order column is beyond the last one already processed; all rows if none was."""
    return df if last is None else df.where(F.col(order) > F.lit(last))


def table_from_path(path: Column, root: str, tables: list[str]) -> Column:
    """The table a file belongs to: the first folder under ``root``; null if it is not one of ``tables``."""
    prefix = root.rstrip("/") + "/"
    relative = F.when(F.locate(prefix, path) > 0, F.substring_index(path, prefix, -1))
    first = F.substring_index(relative, "/", 1)
    return F.when(first.isin(tables) & relative.contains("/"), first)


def numeric_like(df: DataFrame, columns: list[str], threshold: float = 0.95) -> DataFrame:
    """Per column: the share of rows that parse as a number, and whether it exceeds ``threshold``."""
    from visitmart.functions.numbers import to_float

    shares = df.agg(
        *[F.avg(F.when(to_float(df, name).isNotNull(), 1.0).otherwise(0.0)).alias(name) for name in columns]
    )
    return spread(shares, columns, "feature", "parsed_share").withColumn(
        "is_numeric", F.coalesce(F.col("parsed_share") > F.lit(threshold), F.lit(False))
    )


def spread(one_row: DataFrame, columns: list[str], name: str, value: str) -> DataFrame:
    """Turn the columns of a one-row frame into rows ``(name, value)``."""
    pairs = [F.struct(F.lit(column).alias(name), F.col(f"`{column}`").alias(value)) for column in columns]
    return one_row.select(F.inline(F.array(*pairs)))
