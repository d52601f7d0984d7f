"""The model-ready dataset and its two summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitmart import schema as S
from visitmart.functions.bands import LACE_BANDS, Bands, band_table, cut
from visitmart.functions.numbers import percent, to_float
from visitmart.operators.shape import pick

_WHOLE = set(S.INT_COLUMNS)


def fill_defaults(df: DataFrame) -> DataFrame:
    """Numbers: missing becomes 0. Texts: missing or empty becomes the column's default."""
    filled = {}
    for name in S.MODEL_NUMERIC:
        if name in df.columns:
            number = F.coalesce(to_float(df, name), F.lit(0.0))
            whole = name in _WHOLE and df.schema[name].dataType.typeName() in ("long", "integer")
            filled[name] = F.coalesce(F.col(name), F.lit(0)).cast("long") if whole else number
    for name, default in S.MODEL_TEXT_DEFAULTS.items():
        if name in df.columns:
            text = F.nullif(F.col(name).cast("string"), F.lit(""))
            filled[name] = F.coalesce(text, F.lit(default))
    return df.withColumns(filled)


def model_dataset(silver: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """The 44 model columns that exist, with defaults filled in; ``extra`` columns ride along."""
    return fill_defaults(pick(silver, S.MODEL_COLUMNS + list(extra)))


def reason_summary(model: DataFrame) -> DataFrame:
    """Admissions and readmissions per condition, most early readmissions first."""
    out = model.groupBy("Condition").agg(
        F.count("patientunitstayid").alias("total_admissions"),
        F.sum("readmitted").cast("long").alias("total_readmissions"),
        F.sum(S.TARGET).cast("long").alias("readmissions_under_30_days"),
        F.avg("days_until_readmission").alias("avg_days_to_readmission"),
        F.avg("LACE_Score").alias("avg_lace_score"),
        F.avg("los").alias("avg_los"),
    )
    out = out.withColumns(
        {
            "readmission_rate_pct": percent("total_readmissions", "total_admissions"),
            "readmission_30d_rate_pct": percent("readmissions_under_30_days", "total_admissions"),
        }
    )
    return sort_desc(out, "readmissions_under_30_days", "Condition")


def sort_desc(df: DataFrame, column: str, tie: str) -> DataFrame:
    return df.orderBy(F.col(column).desc(), F.col(tie).asc())


def head(df: DataFrame, n: int, *order) -> DataFrame:
    return df.orderBy(*order).limit(n)


def with_all_bands(aggregated: DataFrame, bands: Bands, name: str) -> DataFrame:
    """Every band once, in band order, whether or not any row fell into it."""
    dimension = band_table(aggregated.sparkSession, bands, name)
    return dimension.join(aggregated, name, "left")


def driver_summary(model: DataFrame) -> DataFrame:
    """Patients and early readmissions per LACE band. Scores outside every band are left out."""
    banded = model.withColumn("lace_band", cut("LACE_Score", LACE_BANDS)).where("lace_band IS NOT NULL")
    totals = banded.groupBy("lace_band").agg(
        F.count("patientunitstayid").alias("patients"),
        F.sum(S.TARGET).cast("long").alias("readmission_30d_count"),
        F.avg("los").alias("avg_los"),
        F.avg("chronic_conditions").alias("avg_chronic_conditions"),
    )
    out = with_all_bands(totals, LACE_BANDS, "lace_band").withColumns(
        {
            "patients": F.coalesce("patients", F.lit(0)),
            "readmission_30d_count": F.coalesce("readmission_30d_count", F.lit(0)),
        }
    )
    rate = percent("readmission_30d_count", "patients")
    return out.withColumn("readmission_30d_rate_pct", rate).orderBy("band_order").drop("band_order")
