"""Queries on cleaning, completing and deduplicating visits."""

from __future__ import annotations

from pyspark.sql import functions as F

from visitmart import schema as S
from visitmart.functions.numbers import clip, unit_interval
from visitmart.operators import shape
from visitmart.operators.quality import quality_report
from visitmart.operators.silver import clean, split_silver
from visitmart.plans import oracle as O
from visitmart.plans import visits as V
from visitmart.plans.registry import query


def _clean(spark, sf_dir):
    return clean(V.visits_raw(spark, sf_dir), V.PROCESSED_AT)


def _columns(name: str, columns: str, cleaned: bool = False) -> None:
    """Register a query that selects ``columns`` of the cleaned or of the completed rows."""
    names = columns.split()
    base = O.TO_HASH if cleaned else O.SILVER_ROWS
    source = "hashed" if cleaned else "silver"

    @query(name, f"{base} SELECT {', '.join(names)} FROM {source}")
    def build(spark, sf_dir):
        rows = _clean(spark, sf_dir) if cleaned else V.silver_rows(spark, sf_dir)
        return rows.select(*names)


@query("visits_source", f"WITH {O.RAW} SELECT * EXCLUDE (_o1,_o2,_o3,_o4) FROM raw")
def visits_source(spark, sf_dir):
    return V.visits_raw(spark, sf_dir).drop(*V.ORDER)


_columns(
    "clean_integers",
    "patientunitstayid patienthealthsystemstayid hospitalid wardid hospitaldischargeoffset unitdischargeoffset "
    "unitvisitnumber chronic_conditions readmitted",
    cleaned=True,
)
_columns("clean_floats", "patientunitstayid admissionheight admissionweight los LACE_Score", cleaned=True)
_columns("clean_age", "patientunitstayid age age_years", cleaned=True)
_columns("clean_gender", "patientunitstayid gender gender_normalized", cleaned=True)
_columns(
    "clean_statuses",
    "patientunitstayid hospital_discharge_status_normalized unit_discharge_status_normalized is_expired",
    cleaned=True,
)
_columns("clean_times", "patientunitstayid hospitaladmittime24", cleaned=True)
_columns("clean_dates", "patientunitstayid admit_day silver_processed_date", cleaned=True)
_columns("unit_stay_hours", "patientunitstayid estimated_unit_los_hours", cleaned=True)
_columns("record_hash", "patientunitstayid record_hash", cleaned=True)
_columns("ethnic_group", "record_hash ethnicity ethnic_group_c")
_columns("insurance_rule", "record_hash age_years insurance_provider")
_columns("condition_fill", "record_hash apacheadmissiondx Condition")
_columns("care_plan_rule", "record_hash care_plan_following_discharge")
_columns("impute_stay", "record_hash los")
_columns("impute_chronic", "record_hash chronic_conditions")
_columns("impute_flags", "record_hash " + " ".join(S.FLAG_COLUMNS))
_columns("impute_visits", "record_hash ed_visits ip_visits")
_columns("impute_lace", "record_hash LACE_Score")
_columns("impute_vitals", "record_hash bp_systolic bp_diastolic pulse respirations temperature")
_columns("impute_bmi", "record_hash bmi")
_columns("impute_labs", "record_hash glucose creatinine wbc hemoglobin potassium sodium calcium")
_columns("impute_costs", "record_hash cost_of_initial_stay care_plan_costs")
_columns("derive_outcomes", "record_hash readmitted days_until_readmission readmitted_under_30_days")


@query(
    "hash_draws",
    f"{O.TO_HASH}, {O._FILL.split('fill1 AS')[0].format(source='hashed').strip().rstrip(',')}"
    " SELECT record_hash, u1, u2, u3, u4 FROM drawn",
)
def hash_draws(spark, sf_dir):
    draws = [unit_interval("record_hash", salt).alias(salt) for salt in ("u1", "u2", "u3", "u4")]
    return _clean(spark, sf_dir).select("record_hash", *draws)


@query(
    "clip_values",
    f"{O.TO_HASH} SELECT record_hash, {O.clip('los', '0e0', '14e0')} AS los_0_14, "
    f"{O.clip('chronic_conditions', '0', '8')} AS chronic_0_8 FROM hashed",
)
def clip_values(spark, sf_dir):
    return _clean(spark, sf_dir).select(
        "record_hash",
        clip(F.col("los"), 0.0, 14.0).alias("los_0_14"),
        clip(F.col("chronic_conditions"), 0, 8).alias("chronic_0_8"),
    )


@query("silver_rows", f"{O.SILVER_ROWS} SELECT * EXCLUDE (_o1,_o2,_o3,_o4) FROM silver")
def silver_rows(spark, sf_dir):
    return V.silver_rows(spark, sf_dir).drop(*V.ORDER)


@query("silver_latest", f"{O.SILVER} SELECT * EXCLUDE (_o1,_o2,_o3,_o4) FROM silver")
def silver_latest(spark, sf_dir):
    return V.silver_latest(spark, sf_dir).drop(*V.ORDER)


_RAW_AND_FILLED = set(
    """patientunitstayid patienthealthsystemstayid uniquepid hospitalid wardid hospitaldischargeoffset unitdischargeoffset
    unitvisitnumber unittype gender gender_normalized age age_years ethnicity ethnic_group_c insurance_provider
    hospital_discharge_status_normalized unit_discharge_status_normalized is_expired estimated_unit_los_hours admit_day
    apacheadmissiondx Condition care_plan_following_discharge admissionheight admissionweight""".split()
    + S.KEY_COLUMNS
    + "los LACE_Score ed_visits ip_visits chronic_conditions readmitted readmitted_under_30_days".split()
    + "days_until_readmission cost_of_initial_stay care_plan_costs bmi".split()
    + S.FLAG_COLUMNS
    + "bp_systolic bp_diastolic pulse respirations temperature".split()
    + "glucose creatinine wbc hemoglobin potassium sodium calcium".split()
)


def _silver_table(table: str) -> None:
    columns = [name for name in S.SILVER_TABLES[table] if name in _RAW_AND_FILLED]

    @query(f"silver_{table}", f"{O.SILVER} SELECT {', '.join(columns)} FROM silver")
    def build(spark, sf_dir):
        return split_silver(V.silver_rows(spark, sf_dir), V.ORDER)[table]


for _table in S.SILVER_TABLES:
    _silver_table(_table)


@query(
    "dedup_last",
    f"{O.TO_HASH}, kept AS ({O.last('hashed', 'patienthealthsystemstayid, hospitalid')}) "
    "SELECT patienthealthsystemstayid, hospitalid, patientunitstayid, los FROM kept",
)
def dedup_last(spark, sf_dir):
    keys = ["patienthealthsystemstayid", "hospitalid"]
    kept = shape.dedup_last(_clean(spark, sf_dir), keys, V.ORDER)
    return kept.select(*keys, "patientunitstayid", "los")


@query("pick_columns", f"WITH {O.RAW} SELECT gender, age, hospitalid FROM raw")
def pick_columns(spark, sf_dir):
    return shape.pick(V.visits_raw(spark, sf_dir), ["gender", "age", "no_such_column", "gender", "hospitalid"])


@query("ensure_columns", f"WITH {O.RAW} SELECT patientunitstayid, uniquepid, NULL::VARCHAR AS glucose FROM raw")
def ensure_columns(spark, sf_dir):
    full = shape.ensure_columns(V.visits_raw(spark, sf_dir), S.source_schema())
    return full.select("patientunitstayid", "uniquepid", "glucose")


def _quality_sql(base: str, source: str, known: set[str]) -> str:
    flags = {
        "expired_count": "is_expired" if "is_expired" in known else None,
        "readmitted_count": "readmitted" if "readmitted" in known else None,
        "readmitted_under_30_days_count": S.TARGET if S.TARGET in known else None,
    }
    sums = ", ".join(
        f"{f'coalesce(sum({c}::BIGINT),0)::BIGINT' if c else '0::BIGINT'} AS {n}" for n, c in flags.items()
    )
    nulls = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, "
        + (f"count(*) FILTER ({c} IS NULL)" if c in known else "count(*)")
        + f" AS null_count FROM {source}"
        for c in S.QUALITY_COLUMNS
    )
    return f"""{base}, totals AS (SELECT count(*) AS total_rows, {sums},
        count(*) - (SELECT count(*) FROM (SELECT DISTINCT patientunitstayid FROM {source})) AS duplicate_patientunitstayid
        FROM {source}), nulls AS ({nulls})
      SELECT total_rows, expired_count, readmitted_count, readmitted_under_30_days_count, duplicate_patientunitstayid,
        {O.pct('readmitted_count', 'total_rows')} AS readmitted_rate_pct,
        {O.pct('readmitted_under_30_days_count', 'total_rows')} AS readmitted_under_30_days_rate_pct,
        column_name, null_count FROM totals, nulls"""


def _report_rows(report):
    entries = F.explode("required_column_null_counts").alias("column_name", "null_count")
    return report.select(*[c for c in report.columns if c != "required_column_null_counts"], entries)


_SILVER_KNOWN = _RAW_AND_FILLED
_CLEAN_KNOWN = _RAW_AND_FILLED - {S.TARGET, "days_until_readmission"}


@query("quality_report", _quality_sql(O.SILVER_ROWS, "silver", _SILVER_KNOWN))
def quality(spark, sf_dir):
    return _report_rows(quality_report(V.silver_rows(spark, sf_dir)))


@query("quality_report_before_fill", _quality_sql(O.TO_HASH, "hashed", _CLEAN_KNOWN))
def quality_before_fill(spark, sf_dir):
    return _report_rows(quality_report(_clean(spark, sf_dir)))


_FILES = (
    f"WITH {O.RAW}, files AS (SELECT DISTINCT substr(_airbyte_emitted_at,1,10) || '/' || hospitalid AS path FROM raw), "
    "done AS (SELECT path FROM files WHERE path < '2024-01-04')"
)


@query("pending_files", f"{_FILES} SELECT path FROM files WHERE path NOT IN (SELECT path FROM done) ORDER BY path")
def pending_files(spark, sf_dir):
    path = F.concat(F.substring("_airbyte_emitted_at", 1, 10), F.lit("/"), F.col("hospitalid"))
    files = V.visits_raw(spark, sf_dir).select(path.alias("path")).distinct()
    return shape.pending_files(files, files.where("path < '2024-01-04'"))


@query("rows_after", f"WITH {O.RAW} SELECT patientunitstayid, _o1 FROM raw WHERE _o1 > 100")
def rows_after(spark, sf_dir):
    return shape.rows_after(V.visits_raw(spark, sf_dir), "_o1", 100).select("patientunitstayid", "_o1")


@query(
    "table_from_path",
    f"WITH {O.RAW} SELECT path, CASE WHEN unitstay IN ('visits_core','diagnosis_care') THEN unitstay END AS table_name "
    "FROM (SELECT 'file:/silver/' || unitstay || '/x=' || hospitalid || '/a.parquet' AS path, unitstay FROM "
    "(SELECT hospitalid, CASE CAST(wardid AS BIGINT)%3 WHEN 0 THEN 'visits_core' WHEN 1 THEN 'diagnosis_care' "
    "ELSE '_quality' END AS unitstay FROM raw))",
)
def table_from_path(spark, sf_dir):
    folder = (
        F.when(F.col("wardid").cast("long") % 3 == 0, "visits_core")
        .when(F.col("wardid").cast("long") % 3 == 1, "diagnosis_care")
        .otherwise("_quality")
    )
    path = F.concat(F.lit("file:/silver/"), folder, F.lit("/x="), F.col("hospitalid"), F.lit("/a.parquet"))
    paths = V.visits_raw(spark, sf_dir).select(path.alias("path"))
    name = shape.table_from_path(F.col("path"), "file:/silver", list(S.SILVER_TABLES))
    return paths.select("path", name.alias("table_name"))


@query(
    "numeric_inference",
    f"WITH {O.RAW} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {O.r(f'avg(CASE WHEN {O.num(c)} IS NOT NULL THEN 1e0 ELSE 0e0 END)')} AS parsed_share, "
        f"avg(CASE WHEN {O.num(c)} IS NOT NULL THEN 1e0 ELSE 0e0 END) > 0.95e0 AS is_numeric FROM raw"
        for c in ("age", "gender", "hospitalid", "los", "unittype", "admissionheight")
    ),
)
def numeric_inference(spark, sf_dir):
    from visitmart.plans.registry import rounded

    columns = ["age", "gender", "hospitalid", "los", "unittype", "admissionheight"]
    return rounded(shape.numeric_like(V.visits_raw(spark, sf_dir), columns))
