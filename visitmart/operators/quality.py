"""Completeness, duplicates and the quality report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitmart import schema as S
from visitmart.functions.numbers import percent
from visitmart.operators.shape import spread


def _flag_total(df: DataFrame, name: str):
    if name not in df.columns:
        return F.lit(0).cast("long")
    return F.coalesce(F.sum(F.col(name).cast("long")), F.lit(0))


COUNTED = ["total_rows", "expired_count", "readmitted_count", "readmitted_under_30_days_count"]
ID = "patientunitstayid"


def counts(df: DataFrame, required: list[str] = S.QUALITY_COLUMNS, by: tuple[str, ...] = ()) -> DataFrame:
    """Rows, outcomes and nulls per required column (a missing column is all null) of each group, or of all rows."""
    rows = F.count(F.lit(1))
    nulls = [
        (F.count_if(F.col(name).isNull()) if name in df.columns else rows).alias(f"null_{name}") for name in required
    ]
    flags = ("is_expired", "readmitted", S.TARGET)
    counted = [rows, *[_flag_total(df, flag) for flag in flags]]
    named = [c.alias(n) for n, c in zip(COUNTED, counted)]
    return df.groupBy(*by).agg(*named, *nulls)


def counts_by_id(df: DataFrame, required: list[str] = S.QUALITY_COLUMNS) -> DataFrame:
    """The counts of each id, a missing id included.

    Counting distinct ids groups by id first, so the ids are never gathered in one place. Rows without an id column
    are one group.
    """
    return counts(df, required, tuple(c for c in (ID,) if c in df.columns))


def report_of(sums: DataFrame, required: list[str] = S.QUALITY_COLUMNS) -> DataFrame:
    """The report from one row of summed counts and ``duplicate_patientunitstayid``."""
    pairs = [part for name in required for part in (F.lit(name), F.col(f"null_{name}"))]
    rates = {
        f"{stem}_rate_pct": F.coalesce(percent(f"{stem}_count", "total_rows"), F.lit(0.0))
        for stem in ("readmitted", "readmitted_under_30_days")
    }
    out = sums.withColumns({"required_column_null_counts": F.create_map(*pairs), **rates})
    return out.drop(*[f"null_{name}" for name in required])


def quality_report(df: DataFrame, required: list[str] = S.QUALITY_COLUMNS) -> DataFrame:
    """One row: size, nulls per required column (a missing column is all null), repeats and outcomes."""
    grouped = counts_by_id(df, required)
    repeats = F.sum(F.col("total_rows") - 1) if ID in df.columns else F.sum("total_rows")
    total = [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in COUNTED]
    nulls = [F.coalesce(F.sum(f"null_{name}"), F.lit(0)).alias(f"null_{name}") for name in required]
    sums = grouped.agg(*total, F.coalesce(repeats, F.lit(0)).alias("duplicate_patientunitstayid"), *nulls)
    return report_of(sums, required)


def missing_pct(df: DataFrame, n: int = 30) -> DataFrame:
    """Share of missing values per column, worst first."""
    names = df.columns
    shares = df.agg(*[(F.avg(F.col(f"`{c}`").isNull().cast("int")) * F.lit(100.0)).alias(c) for c in names])
    out = spread(shares, names, "feature", "missing_pct")
    return out.orderBy(F.col("missing_pct").desc(), "feature").limit(n)


def completeness_by_month(df: DataFrame, features: list[str] = S.KEY_FEATURES) -> DataFrame:
    """Mean share of present values over the key features, per month."""
    present = [name for name in features if name in df.columns]
    shares = [F.avg(F.col(name).isNotNull().cast("int")) for name in present]
    mean = sum(shares[1:], shares[0]) / F.lit(float(len(present)))
    return df.groupBy("admit_month").agg((mean * F.lit(100.0)).alias("completeness_pct"))


def duplicate_count(df: DataFrame, key: tuple[str, ...] = ("patientunitstayid", "admit_day")) -> DataFrame:
    """Rows beyond the first of their key, and their share. Missing key values equal each other."""
    names = [name for name in key if name in df.columns]
    groups = df.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    out = groups.agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
    )
    share = F.coalesce(percent("duplicate_rows", "total_rows", None), F.lit(0.0))
    return out.withColumn("duplicate_pct", share)


def duplicates_by_month(df: DataFrame, key: tuple[str, ...] = ("patientunitstayid", "admit_day")) -> DataFrame:
    """Rows that share their key with another row, per month; months without any stay at 0.

    The month follows from the admission day, so grouping by both keeps key groups whole.
    """
    names = [name for name in key if name in df.columns]
    groups = df.groupBy(*names, "admit_month").agg(F.count(F.lit(1)).alias("_n"))
    if "admit_day" not in names:
        whole = df.groupBy(*names).agg(F.count(F.lit(1)).alias("_all"))
        matched = groups[names[0]].eqNullSafe(whole[names[0]])
        groups = groups.join(whole, matched).select("admit_month", "_n", "_all")
    else:
        groups = groups.withColumn("_all", F.col("_n"))
    repeated = F.sum(F.when(F.col("_all") > 1, F.col("_n")).otherwise(0))
    return groups.groupBy("admit_month").agg(repeated.alias("duplicate_rows"))
