"""Quantile sketches that are stored for each period and merged for any choice of periods.

A sketch of a group of n rows has at most ``points`` entries ``(value, n)``. The rows are ordered and cut where the rank
of a value's first row passes a multiple of n / points; an entry has the greatest value of its cut and the rows in it.
Only the rows of a cut's smaller values, fewer than n / points, are told as greater than they are. So the rows
counted up to any x by entries are at most n / points fewer than there are, and never more. Merging adds
entries, hence the shares add up as well: the rank error of any merge is below its rows / points, however many sketches
there are. Nothing is drawn at random, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from visitmart.operators.ordered import running_totals


def rank_sketch(df: DataFrame, value: str, by: list[str], points: int = 200) -> DataFrame:
    """``(by, value, n)``: the entries of each group's sketch. Null values take no part; an empty table has no entries."""
    if points < 1:
        raise ValueError("a sketch has at least one point")
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("double").alias("value"))
    totals = running_totals(counts.agg(F.count(F.lit(1)).alias("n")), "value", ["n"], by)
    cut = F.expr(f"((n_upto - n) * {points}L) div n_total").alias("_cut")
    return totals.groupBy(*by, cut).agg(F.max("value").alias("value"), F.sum("n").alias("n")).drop("_cut")


def merged(sketches: DataFrame, by: list[str]) -> DataFrame:
    """One sketch for each group of ``by``, a part of the columns that the sketches were made by."""
    return sketches.groupBy(*by, "value").agg(F.sum("n").alias("n"))


def sketch_quantiles(
    sketches: DataFrame, quantiles: dict[str, float], by: list[str], points: int = 200
) -> DataFrame:
    """For each group the rows, the bound of the rank error, and a value for each quantile.

    With t the rank of a quantile (the share of the rows, rounded up, at least 1), at least t rows are up to the
    value given, and fewer than t + rank_error lie below it.
    """
    totals = running_totals(merged(sketches, by), "value", ["n"], by)
    rows = F.max("n_total")
    found = {
        name: F.min(F.when(F.col("n_upto") >= F.greatest(F.lit(1), F.ceil(F.lit(share) * F.col("n_total"))), F.col("value")))
        for name, share in quantiles.items()
    }
    return totals.groupBy(*by).agg(
        rows.alias("n"), (rows / F.lit(float(points))).alias("rank_error"), *[c.alias(name) for name, c in found.items()]
    )


def write_sketches(sketches: DataFrame, path: str, period: str) -> None:
    """Replace the stored sketches of the periods in ``sketches``; those of other periods are neither read nor written."""
    out = sketches.repartition(period).write.partitionBy(period)
    out.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def read_sketches(spark: SparkSession, path: str, period: str, periods: list[str] | None = None) -> DataFrame:
    """Stored sketches of all periods, or of those given: only their folders are read. Periods are texts."""
    found = spark.read.parquet(path).schema
    texts = StructType([StructField(f.name, StringType() if f.name == period else f.dataType) for f in found])
    stored = spark.read.schema(texts).parquet(path)
    return stored if periods is None else stored.where(F.col(period).isin(periods))
