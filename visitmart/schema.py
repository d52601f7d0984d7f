"""Column lists and types of the source, Silver, Gold and final tables.

The names and their order are fixed values: they are the public contract of
the data files.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

SOURCE_COLUMNS = """
patientunitstayid patienthealthsystemstayid gender age ethnicity hospitalid wardid apacheadmissiondx
admissionheight hospitaladmittime24 hospitaladmitoffset hospitaladmitsource hospitaldischargeyear
hospitaldischargetime24 hospitaldischargeoffset hospitaldischargelocation hospitaldischargestatus unittype
unitadmittime24 unitadmitsource unitvisitnumber unitstaytype admissionweight dischargeweight
unitdischargetime24 unitdischargeoffset unitdischargelocation unitdischargestatus uniquepid
""".split()

OPTIONAL_COLUMNS = """
los admit_day discharge_day total_days sex bp_systolic bp_diastolic pulse respirations temperature bmi glucose
creatinine wbc hemoglobin potassium sodium calcium artbloodgas chronic_conditions diabetes obesity anxiety
depression dementia drugabuse mooddisorder tobacco_user ed_visits ip_visits LACE_Score cost_of_initial_stay
care_plan_costs marital_status_c ethnic_group_c insurance_provider readmitted readmitted_under_30_days
days_until_readmission Condition care_plan_following_discharge
""".split()

SYNC_COLUMNS = "_airbyte_ab_id _airbyte_emitted_at _airbyte_stream _airbyte_data".split()

REQUIRED_SOURCE = "gender age hospitaldischargestatus unitdischargestatus unitdischargeoffset".split()

INT_COLUMNS = """
patientunitstayid patienthealthsystemstayid hospitalid wardid hospitaldischargeyear hospitaladmitoffset
hospitaldischargeoffset unitdischargeoffset unitvisitnumber ed_visits ip_visits chronic_conditions diabetes
obesity anxiety depression dementia drugabuse mooddisorder tobacco_user readmitted readmitted_under_30_days
""".split()

FLOAT_COLUMNS = """
admissionheight admissionweight dischargeweight los total_days bp_systolic bp_diastolic pulse respirations
temperature bmi glucose creatinine wbc hemoglobin potassium sodium calcium artbloodgas LACE_Score
cost_of_initial_stay care_plan_costs days_until_readmission readmission_total_days
""".split()

TIME_COLUMNS = "hospitaladmittime24 hospitaldischargetime24 unitadmittime24 unitdischargetime24".split()

DATE_COLUMNS = "admit_day discharge_day readmission_admit_day readmission_discharge_day".split()

HASH_FIELDS = (
    "patientunitstayid patienthealthsystemstayid hospitalid wardid uniquepid _airbyte_emitted_at".split()
)

FLAG_COLUMNS = "diabetes obesity anxiety depression dementia drugabuse mooddisorder tobacco_user".split()

KEY_COLUMNS = "record_hash processed_at_utc _airbyte_emitted_at silver_processed_date".split()

SILVER_TABLES: dict[str, list[str]] = {
    "visits_core": KEY_COLUMNS
    + """
    patientunitstayid patienthealthsystemstayid uniquepid hospitalid wardid hospitaldischargeyear
    hospitaladmitoffset hospitaldischargeoffset unitdischargeoffset unitvisitnumber unittype unitstaytype gender
    gender_normalized age age_years ethnicity ethnic_group_c insurance_provider
    hospital_discharge_status_normalized unit_discharge_status_normalized is_expired estimated_unit_los_hours
    admit_day discharge_day readmission_admit_day readmission_discharge_day
    """.split(),
    "diagnosis_care": KEY_COLUMNS
    + "apacheadmissiondx Condition care_plan_following_discharge marital_status_c".split(),
    "utilization_outcomes": KEY_COLUMNS
    + """
    los total_days LACE_Score ed_visits ip_visits chronic_conditions diabetes obesity anxiety depression dementia
    drugabuse mooddisorder tobacco_user readmitted readmitted_under_30_days days_until_readmission
    readmission_total_days cost_of_initial_stay care_plan_costs
    """.split(),
    "clinical_features": KEY_COLUMNS
    + """
    admissionheight admissionweight dischargeweight bp_systolic bp_diastolic pulse respirations temperature bmi
    glucose creatinine wbc hemoglobin potassium sodium calcium artbloodgas
    """.split(),
}

DOCTOR_MART_COLUMNS = """
as_of_date patientunitstayid patienthealthsystemstayid uniquepid hospitalid wardid unittype apacheadmissiondx
Condition insurance_provider ethnic_group_c gender_normalized age_years los LACE_Score chronic_conditions glucose
creatinine wbc hemoglobin unitvisitnumber is_expired readmitted readmitted_under_30_days days_until_readmission
risk_score risk_band is_high_risk record_hash processed_at_utc
""".split()

MODEL_COLUMNS = """
patientunitstayid uniquepid hospitalid wardid unittype gender ethnicity ethnic_group_c insurance_provider age los
LACE_Score bp_systolic bp_diastolic pulse respirations temperature bmi glucose creatinine wbc hemoglobin potassium
sodium calcium ed_visits ip_visits chronic_conditions diabetes obesity anxiety depression dementia drugabuse
mooddisorder tobacco_user cost_of_initial_stay care_plan_costs Condition care_plan_following_discharge readmitted
readmitted_under_30_days days_until_readmission processed_at_utc
""".split()

MODEL_NUMERIC = """
age hospitalid wardid los LACE_Score bp_systolic bp_diastolic pulse respirations temperature bmi glucose creatinine
wbc hemoglobin potassium sodium calcium ed_visits ip_visits chronic_conditions diabetes obesity anxiety depression
dementia drugabuse mooddisorder tobacco_user cost_of_initial_stay care_plan_costs readmitted
readmitted_under_30_days days_until_readmission
""".split()

# Fixed values.
MODEL_TEXT_DEFAULTS = {
    "gender": "unknown",
    "ethnicity": "unknown",
    "ethnic_group_c": "unknown",
    "insurance_provider": "unknown",
    "unittype": "unknown",
    "Condition": "unspecified",
    "care_plan_following_discharge": "No documented plan",
}

QUALITY_COLUMNS = """
patientunitstayid patienthealthsystemstayid gender age hospitalid wardid uniquepid LACE_Score los Condition
readmitted readmitted_under_30_days days_until_readmission
""".split()

TARGET = "readmitted_under_30_days"
LEAKAGE_COLUMNS = [TARGET, "readmitted", "days_until_readmission", "processed_at_utc"]
ID_COLUMNS = "patientunitstayid uniquepid hospitalid wardid".split()
UNIQUE_ID_COLUMNS = "patientunitstayid uniquepid".split()

# The dashboard model's columns, segments, lab values and key features.
DASHBOARD_NUMERIC = """
age los LACE_Score glucose creatinine wbc hemoglobin chronic_conditions ed_visits ip_visits bp_systolic bp_diastolic
""".split()
DASHBOARD_CATEGORICAL = "gender ethnic_group_c insurance_provider Condition unittype".split()

SEGMENT_COLUMNS = "gender ethnic_group_c insurance_provider".split()
LAB_COLUMNS = "glucose creatinine wbc hemoglobin".split()
KEY_FEATURES = ["LACE_Score", "los", *LAB_COLUMNS, TARGET]

_SILVER_TYPES: dict[str, DataType] = {
    **{name: LongType() for name in [*INT_COLUMNS, "age_years"]},
    **{name: DoubleType() for name in [*FLOAT_COLUMNS, "estimated_unit_los_hours"]},
    **{name: TimestampNTZType() for name in DATE_COLUMNS},
    "is_expired": BooleanType(),
}


def text_schema(columns: list[str]) -> StructType:
    return StructType([StructField(name, StringType()) for name in columns])


def source_schema() -> StructType:
    """All 70 columns of the source contract, every one text."""
    return text_schema(SOURCE_COLUMNS + OPTIONAL_COLUMNS)


def bronze_schema(extra: tuple[str, ...] = ()) -> StructType:
    return text_schema(SYNC_COLUMNS + SOURCE_COLUMNS + OPTIONAL_COLUMNS + list(extra))


def silver_schema(table: str) -> StructType:
    return StructType(
        [StructField(name, _SILVER_TYPES.get(name, StringType())) for name in SILVER_TABLES[table]]
    )
