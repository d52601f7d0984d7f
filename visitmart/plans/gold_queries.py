"""Queries on the marts, the final dataset and their summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from visitmart.functions.bands import AGE_BANDS, LACE_BANDS, cut
from visitmart.operators import final, gold, shape
from visitmart.operators.silver import latest_silver, split_silver
from visitmart.plans import oracle as O
from visitmart.plans import visits as V
from visitmart.plans.registry import query, rounded

_NEW = "2024-02-02T00:00:00+00:00"


@query("doctor_mart", f"{O.DOCTOR} SELECT * FROM doctor")
def doctor_mart(spark, sf_dir):
    return V.doctor(spark, sf_dir)


@query("risk_score", f"{O.DOCTOR} SELECT record_hash, risk_score, risk_band, is_high_risk FROM doctor")
def risk_score(spark, sf_dir):
    return V.doctor(spark, sf_dir).select("record_hash", "risk_score", "risk_band", "is_high_risk")


@query("as_of_date", f"{O.DOCTOR} SELECT as_of_date, count(*) AS visits FROM doctor GROUP BY 1")
def as_of_date(spark, sf_dir):
    return V.doctor(spark, sf_dir).groupBy("as_of_date").agg(F.count(F.lit(1)).alias("visits"))


@query("assemble_silver", f"{O.SILVER} SELECT * EXCLUDE (_o1,_o2,_o3,_o4,hospitaladmittime24,hospitaldischargestatus,"
       "unitdischargestatus) FROM silver")
def assemble_silver(spark, sf_dir):
    return gold.assemble(split_silver(V.silver_rows(spark, sf_dir), V.ORDER, once=True))


def _kpi_sql(group: str, extra: str = "") -> str:
    counts = {
        "expired_count": "is_expired",
        "high_risk_count": "is_high_risk",
        "readmissions_any": "readmitted",
        "readmissions_under_30_days": "readmitted_under_30_days",
    }
    sums = ", ".join(f"coalesce(sum({c}::BIGINT),0)::BIGINT AS {n}" for n, c in counts.items())
    rates = ", ".join(
        f"{O.pct(n, 'total_visits')} AS {rate}"
        for rate, n in zip(
            ("mortality_rate_pct", "high_risk_rate_pct", "readmission_any_rate_pct", "readmission_30d_rate_pct"), counts
        )
    )
    return (
        f"{O.DOCTOR} SELECT *, {rates} FROM (SELECT {group}, count(patientunitstayid) AS total_visits, {extra} "
        f"{O.r('avg(los)')} AS avg_los_days, {sums} FROM doctor GROUP BY {group})"
    )


@query(
    "hospital_kpi",
    _kpi_sql(
        "as_of_date, hospitalid",
        f"count(DISTINCT uniquepid) AS unique_patients, {O.r('avg(age_years)')} AS avg_age_years,",
    ),
)
def hospital_kpi(spark, sf_dir):
    return rounded(gold.hospital_kpi(V.doctor(spark, sf_dir)))


@query("department_kpi", _kpi_sql("as_of_date, hospitalid, unittype"))
def department_kpi(spark, sf_dir):
    return rounded(gold.department_kpi(V.doctor(spark, sf_dir)))


_UPSERT = O.DOCTOR + f""", existing AS (SELECT d.* FROM doctor d JOIN silver s USING (record_hash)
    WHERE s._airbyte_emitted_at < '2024-01-05'),
  incoming AS (SELECT d.* REPLACE ('2024-02-02' AS as_of_date, '{_NEW}' AS processed_at_utc)
    FROM doctor d JOIN silver s USING (record_hash) WHERE s._airbyte_emitted_at >= '2024-01-03')
  SELECT * FROM incoming UNION ALL
  SELECT * FROM existing WHERE record_hash NOT IN (SELECT record_hash FROM incoming)"""


@query("upsert_mart", _UPSERT)
def upsert_mart(spark, sf_dir):
    raw = V.visits_raw(spark, sf_dir)
    old = latest_silver(raw.where("_airbyte_emitted_at < '2024-01-05'"), V.PROCESSED_AT, V.ORDER)
    new = latest_silver(raw.where("_airbyte_emitted_at >= '2024-01-03'"), _NEW, V.ORDER)
    return shape.upsert(gold.doctor_mart(old), gold.doctor_mart(new), ["processed_at_utc"])


@query(
    "upsert_by_visit",
    O.TO_HASH + """, both_sides AS (SELECT patientunitstayid, patienthealthsystemstayid, los, _o1, _o2, _o3, _o4,
      CASE WHEN wardid < 84 THEN 0 ELSE 1 END AS side FROM hashed)
    SELECT patientunitstayid, patienthealthsystemstayid, los FROM (SELECT *, row_number() OVER (
      PARTITION BY patientunitstayid, patienthealthsystemstayid ORDER BY side DESC, _o1 DESC NULLS LAST,
      _o2 DESC NULLS LAST, _o3 DESC NULLS LAST, _o4 DESC NULLS LAST) AS rn FROM both_sides) WHERE rn = 1""",
)
def upsert_by_visit(spark, sf_dir):
    from visitmart.operators.silver import clean

    keys = ["patientunitstayid", "patienthealthsystemstayid"]
    rows = clean(V.visits_raw(spark, sf_dir), V.PROCESSED_AT).select(*keys, "los", "wardid", *V.ORDER)
    merged = shape.upsert(rows.where("wardid < 84"), rows.where("wardid >= 84"), V.ORDER, keys=keys)
    return merged.select(*keys, "los")


@query(
    "union_frames",
    f"WITH {O.RAW} SELECT patientunitstayid, gender, NULL::VARCHAR AS age FROM raw "
    "UNION ALL SELECT patientunitstayid, NULL, age FROM raw",
)
def union_frames(spark, sf_dir):
    raw = V.visits_raw(spark, sf_dir)
    return shape.union_all([raw.select("patientunitstayid", "gender"), raw.select("patientunitstayid", "age")])


@query(
    "key_violations",
    O.SILVER_ROWS + """, g AS (SELECT hospitalid, unittype, patientunitstayid, count(*) AS n FROM silver GROUP BY ALL)
    SELECT coalesce(sum(n) FILTER (hospitalid IS NULL OR unittype IS NULL OR patientunitstayid IS NULL),0)::BIGINT
      AS null_key_rows, coalesce(sum(n) FILTER (n > 1),0)::BIGINT AS duplicate_key_rows FROM g""",
)
def key_violations(spark, sf_dir):
    return shape.key_violations(V.silver_rows(spark, sf_dir), ["hospitalid", "unittype", "patientunitstayid"])


@query("model_dataset", f"{O.MODEL} SELECT * FROM model")
def model_dataset(spark, sf_dir):
    return V.model(spark, sf_dir)


@query(
    "fill_defaults",
    O.TO_HASH + f""" SELECT record_hash, coalesce(los,0e0) AS los, coalesce(LACE_Score,0e0) AS LACE_Score,
      coalesce(chronic_conditions,0) AS chronic_conditions, coalesce(readmitted,0) AS readmitted,
      coalesce({O.num('age')},0e0) AS age, coalesce(nullif(unittype,''),'unknown') AS unittype,
      coalesce(nullif(gender,''),'unknown') AS gender, coalesce(nullif(Condition,''),'unspecified') AS Condition
    FROM hashed""",
)
def fill_defaults(spark, sf_dir):
    from visitmart.operators.silver import clean

    columns = "record_hash los LACE_Score chronic_conditions readmitted age unittype gender Condition".split()
    return final.fill_defaults(clean(V.visits_raw(spark, sf_dir), V.PROCESSED_AT).select(*columns))


REASON_SQL = f"""reason AS (SELECT *, {O.pct('total_readmissions', 'total_admissions')} AS readmission_rate_pct,
    {O.pct('readmissions_under_30_days', 'total_admissions')} AS readmission_30d_rate_pct
  FROM (SELECT Condition, count(patientunitstayid) AS total_admissions, sum(readmitted)::BIGINT AS total_readmissions,
    sum(readmitted_under_30_days)::BIGINT AS readmissions_under_30_days,
    {O.r('avg(days_until_readmission)')} AS avg_days_to_readmission, {O.r('avg(LACE_Score)')} AS avg_lace_score,
    {O.r('avg(los)')} AS avg_los FROM model GROUP BY Condition))"""

DRIVER_SQL = f"""driver AS (SELECT lace_band, coalesce(patients,0) AS patients,
    coalesce(readmission_30d_count,0) AS readmission_30d_count, avg_los, avg_chronic_conditions,
    {O.pct('coalesce(readmission_30d_count,0)', 'coalesce(patients,0)')} AS readmission_30d_rate_pct
  FROM (SELECT unnest(['0-5','6-10','11-15','16+']) AS lace_band) LEFT JOIN (
    SELECT lace_band, count(patientunitstayid) AS patients, sum(readmitted_under_30_days)::BIGINT AS readmission_30d_count,
      {O.r('avg(los)')} AS avg_los, {O.r('avg(chronic_conditions)')} AS avg_chronic_conditions
    FROM (SELECT *, CASE WHEN LACE_Score <= -1 THEN NULL WHEN LACE_Score <= 5 THEN '0-5' WHEN LACE_Score <= 10 THEN '6-10'
      WHEN LACE_Score <= 15 THEN '11-15' WHEN LACE_Score <= 25 THEN '16+' END AS lace_band FROM model)
    GROUP BY 1) USING (lace_band))"""


@query("reason_summary", f"{O.MODEL}, {REASON_SQL} SELECT * FROM reason")
def reason_summary(spark, sf_dir):
    return rounded(final.reason_summary(V.model(spark, sf_dir)))


@query("driver_summary", f"{O.MODEL}, {DRIVER_SQL} SELECT * FROM driver")
def driver_summary(spark, sf_dir):
    return rounded(final.driver_summary(V.model(spark, sf_dir)))


@query(
    "empty_bands",
    f"""{O.MODEL} SELECT lace_band, patients FROM (SELECT unnest(['0-5','6-10','11-15','16+']) AS lace_band) LEFT JOIN (
      SELECT '0-5' AS lace_band, count(*) AS patients FROM model WHERE LACE_Score > -1 AND LACE_Score <= 5) USING (lace_band)""",
)
def empty_bands(spark, sf_dir):
    low = V.model(spark, sf_dir).where("LACE_Score > -1 AND LACE_Score <= 5")
    counts = low.groupBy(cut("LACE_Score", LACE_BANDS).alias("lace_band")).agg(
        F.count(F.lit(1)).alias("patients")
    )
    return final.with_all_bands(counts, LACE_BANDS, "lace_band").drop("band_order")


@query("bands", f"""{O.COHORT} SELECT record_hash, age_band, CASE WHEN LACE_Score <= -1 THEN NULL
    WHEN LACE_Score <= 5 THEN '0-5' WHEN LACE_Score <= 10 THEN '6-10' WHEN LACE_Score <= 15 THEN '11-15'
    WHEN LACE_Score <= 25 THEN '16+' END AS lace_band FROM cohort""")
def bands(spark, sf_dir):
    return V.cohort(spark, sf_dir).select(
        "record_hash",
        cut("age", AGE_BANDS).alias("age_band"),
        cut("LACE_Score", LACE_BANDS).alias("lace_band"),
    )


@query("head_of_reasons", f"{O.MODEL}, {REASON_SQL} SELECT * FROM reason ORDER BY readmissions_under_30_days DESC, Condition LIMIT 20")
def head_of_reasons(spark, sf_dir):
    summary = final.reason_summary(V.model(spark, sf_dir))
    return rounded(final.head(summary, 20, F.col("readmissions_under_30_days").desc(), F.col("Condition").asc()))


@query("feature_columns", f"{O.MODEL} SELECT * EXCLUDE (patientunitstayid, uniquepid, readmitted, "
       "readmitted_under_30_days, days_until_readmission, processed_at_utc) FROM model")
def feature_columns(spark, sf_dir):
    from visitmart.operators.evaluation import feature_columns as features

    return features(V.model(spark, sf_dir))

