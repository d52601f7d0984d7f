"""Gold marts: the visit-level risk mart and the two KPI marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from visitmart import schema as S
from visitmart.functions.bands import HIGH_RISK, RISK_BANDS, cut
from visitmart.functions.numbers import packed_hash_sql, percent, unpacked_hash_sql
from visitmart.functions.risk import risk_score
from visitmart.functions.text import utc_date
from visitmart.operators.shape import dedup_last, pick

PARTS = ["diagnosis_care", "utilization_outcomes", "clinical_features"]


def assemble(
    tables: dict[str, DataFrame], order: list[str] | None = None, only: DataFrame | None = None
) -> DataFrame | None:
    """The core table with the new columns of each part, matched on ``record_hash``.

    With ``order`` every table is first reduced to its last row per hash; the
    join then reuses that partitioning, one shuffle per table in all, in which hashes are packed. The columns of ``order`` should
    be total within a hash and stand in all tables, so that all keep the same source row.
    ``only`` has the hashes to take, where not all are wanted; it goes with ``order``.
    """
    kinds = {t.schema["record_hash"].dataType for t in tables.values() if "record_hash" in t.columns}
    packed = order is not None and kinds == {StringType()}
    if only is not None:
        wanted = only.select(F.expr(packed_hash_sql("record_hash")).alias("record_hash")) if packed else only

    def last(table: DataFrame) -> DataFrame:
        if packed:
            table = table.withColumn("record_hash", F.expr(packed_hash_sql("record_hash")))
        if only is not None:
            table = table.join(wanted, "record_hash", "left_semi")
        return dedup_last(table, ["record_hash"], [name for name in order if name in table.columns])

    core = tables.get("visits_core")
    if core is None:
        return None
    out = core if order is None else last(core)
    for name in PARTS:
        part = tables.get(name)
        if part is None or "record_hash" not in part.columns:
            continue
        if order is not None:
            part = last(part)
        known = set(out.columns)
        fresh = [column for column in part.columns if column not in known]
        out = out.join(part.select("record_hash", *fresh), "record_hash", "left")
    return out.withColumn("record_hash", F.expr(unpacked_hash_sql("record_hash"))) if packed else out


def doctor_mart(silver: DataFrame, as_of: str | None = None) -> DataFrame:
    """Visit-level mart. ``as_of`` is the date used when the rows carry no processing time."""
    scored = silver.withColumn("risk_score", risk_score(silver))
    known = "processed_at_utc" in silver.columns
    return pick(
        scored.withColumns(
            {
                "risk_band": cut("risk_score", RISK_BANDS),
                "is_high_risk": F.col("risk_score") >= F.lit(HIGH_RISK),
                "as_of_date": utc_date("processed_at_utc") if known else F.lit(as_of),
            }
        ),
        S.DOCTOR_MART_COLUMNS,
    )


def _total(name: str) -> Column:
    return F.coalesce(F.sum(F.col(name).cast("long")), F.lit(0))


KPI_COUNTS = {
    "expired_count": "is_expired",
    "high_risk_count": "is_high_risk",
    "readmissions_any": "readmitted",
    "readmissions_under_30_days": "readmitted_under_30_days",
}
_RATES = {
    "mortality_rate_pct": "expired_count",
    "high_risk_rate_pct": "high_risk_count",
    "readmission_any_rate_pct": "readmissions_any",
    "readmission_30d_rate_pct": "readmissions_under_30_days",
}


def with_rates(df: DataFrame) -> DataFrame:
    return df.withColumns({rate: percent(n, "total_visits") for rate, n in _RATES.items()})


def hospital_kpi(doctor: DataFrame) -> DataFrame:
    """KPIs per date and hospital.

    Patients are counted over one row per (date, hospital, patient), so a hospital
    with most of the visits is reduced by many tasks and not by one.
    """
    group = ["as_of_date", "hospitalid"]
    per_patient = doctor.groupBy(*group, "uniquepid").agg(
        F.count("patientunitstayid").alias("_visits"),
        F.sum("age_years").alias("_age_sum"),
        F.count("age_years").alias("_age_n"),
        F.sum("los").alias("_los_sum"),
        F.count("los").alias("_los_n"),
        *[_total(column).alias(name) for name, column in KPI_COUNTS.items()],
    )
    out = per_patient.groupBy(*group).agg(
        F.sum("_visits").alias("total_visits"),
        F.count("uniquepid").alias("unique_patients"),
        (F.sum("_age_sum").cast("double") / F.nullif(F.sum("_age_n"), F.lit(0))).alias("avg_age_years"),
        (F.sum("_los_sum") / F.nullif(F.sum("_los_n"), F.lit(0))).alias("avg_los_days"),
        *[F.sum(name).alias(name) for name in KPI_COUNTS],
    )
    return with_rates(out)


def department_kpi(doctor: DataFrame) -> DataFrame:
    """KPIs per date, hospital and unit type."""
    out = doctor.groupBy("as_of_date", "hospitalid", "unittype").agg(
        F.count("patientunitstayid").alias("total_visits"),
        F.avg("los").alias("avg_los_days"),
        *[_total(column).alias(name) for name, column in KPI_COUNTS.items()],
    )
    return with_rates(out)
