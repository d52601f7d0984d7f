"""Exact answers that need a global order: running totals, quantiles, box statistics, histograms.

An unpartitioned window would order all rows in one task. Here the rows are
first reduced to one per distinct value, the values are split at quantile
bounds, each piece is summed on its own, and the pieces' totals are carried over.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitmart.session import materialise

PIECES = 256  # at least
VALUES_PER_PIECE = 100_000


def _with_piece(df: DataFrame, value: str, pieces: int) -> DataFrame:
    """Number the value range so that every piece holds about the same number of rows."""
    marks = [position / pieces for position in range(1, pieces)]
    bounds = sorted(set(df.approxQuantile(value, marks, 0.25 / pieces))) if marks else []
    if not bounds:
        return df.withColumn("_piece", F.lit(0))
    splits = [float("-inf"), *bounds, float("inf")]
    numbered = Bucketizer(splits=splits, inputCol=value, outputCol="_piece").transform(df)
    return numbered.withColumn("_piece", F.col("_piece").cast("int"))


def running_totals(
    distinct: DataFrame,
    value: str,
    sums: list[str],
    by: list[str] | None = None,
    descending: bool = False,
    pieces: int | None = None,
) -> DataFrame:
    """Add, for each column ``c`` of ``sums``, ``c_upto`` (running total) and ``c_total`` (its end).

    ``distinct`` has one row per (by, value), and ``by`` few values. It is written
    once to the shared folder: the bounds, the totals and the sums read it. The number of pieces
    follows from the number of distinct values, unless it is given.
    """
    by = by or []
    kept = materialise(distinct)
    if pieces is None:
        pieces = max(PIECES, -(-kept.count() // VALUES_PER_PIECE))
    numbered = _with_piece(kept, value, pieces)

    def ordered(name: str) -> Column:
        return F.col(name).desc() if descending else F.col(name).asc()

    per_piece = numbered.groupBy(*by, "_piece").agg(*[F.sum(name).alias(name) for name in sums])
    # At most pieces x groups rows from here to the join.
    earlier = Window.partitionBy(*by).orderBy(ordered("_piece")).rowsBetween(Window.unboundedPreceding, -1)
    overall = Window.partitionBy(*by)
    offsets = per_piece.select(
        *[F.col(name).alias(f"_{name}") for name in by],
        F.col("_piece").alias("_at"),
        *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"_{name}_before") for name in sums],
        *[F.sum(name).over(overall).alias(f"{name}_total") for name in sums],
    )
    within = (
        Window.partitionBy(*by, "_piece")
        .orderBy(ordered(value))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = numbered.withColumns({f"{name}_upto": F.sum(name).over(within) for name in sums})
    matched = local["_piece"] == offsets["_at"]
    for name in by:
        matched = matched & local[name].eqNullSafe(offsets[f"_{name}"])
    joined = local.join(offsets, matched)
    joined = joined.withColumns({f"{name}_upto": F.col(f"{name}_upto") + F.col(f"_{name}_before") for name in sums})
    return joined.select(
        *distinct.columns, *[F.col(f"{name}_{end}") for name in sums for end in ("upto", "total")]
    )


def exact_quantiles(
    df: DataFrame, value: str, quantiles: dict[str, float], by: list[str] | None = None
) -> DataFrame:
    """Exact quantiles with linear interpolation, plus least, greatest and number of values, per group."""
    by = by or []
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    totals = running_totals(counts, value, ["n"], by)
    before = F.col("n_upto") - F.col("n")
    out: list[Column] = [
        F.max("n_total").alias("n"),
        F.min(value).alias("least"),
        F.max(value).alias("greatest"),
    ]
    for name, share in quantiles.items():
        position = F.lit(share) * (F.col("n_total") - 1)
        low, high = F.floor(position), F.ceil(position)
        at_low = F.max(F.when((before <= low) & (low < F.col("n_upto")), F.col(value)))
        at_high = F.max(F.when((before <= high) & (high < F.col("n_upto")), F.col(value)))
        weight = F.max(position - low)
        out.append((at_low * (F.lit(1.0) - weight) + at_high * weight).alias(name))
    return totals.groupBy(*by).agg(*out)


def median(df: DataFrame, value: str) -> DataFrame:
    """The exact median as a one-row, one-column frame."""
    return exact_quantiles(df, value, {"median": 0.5}).select("median")


QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def box_stats(df: DataFrame, columns: list[str], by: str) -> DataFrame:
    """Five-number summary of each column per class."""
    melted = df.select(by, *[F.col(name).cast("double").alias(name) for name in columns]).unpivot(
        [by], columns, "measure", "value"
    )
    return exact_quantiles(melted, "value", QUARTILES, [by, "measure"])


def histogram(df: DataFrame, column: str, bins: int = 30, by: list[str] | None = None) -> DataFrame:
    """Counts in ``bins`` equal bins between the least and greatest value; the last bin is closed."""
    by = by or []
    present = df.where(F.col(column).isNotNull())
    ends = present.agg(
        F.struct(F.min(column).cast("double").alias("low"), F.max(column).cast("double").alias("high")).alias("ends")
    ).scalar()
    placed = present.select(*by, F.col(column).cast("double").alias("_x"), ends.alias("_ends"))
    width = (F.col("_ends.high") - F.col("_ends.low")) / F.lit(float(bins))
    spot = F.coalesce(F.floor((F.col("_x") - F.col("_ends.low")) / F.nullif(width, F.lit(0.0))), F.lit(0))
    placed = placed.select(
        *by,
        F.least(spot.cast("int"), F.lit(bins - 1)).alias("bin"),
        F.col("_ends.low").alias("_low"),
        width.alias("_width"),
    )
    out = placed.groupBy(*by, "bin").agg(
        F.count(F.lit(1)).alias("count"), F.first("_low").alias("_low"), F.first("_width").alias("_width")
    )
    return out.withColumn("bin_start", F.col("_low") + F.col("bin") * F.col("_width")).drop("_low", "_width")
