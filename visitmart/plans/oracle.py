"""The same visit frames as SQL common table expressions, for checks with another engine."""

from __future__ import annotations

from visitmart.plans.visits import VISITS_SQL

NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
WHOLE = r"^\s*[+-]?[0-9]+\s*$"


def num(c: str) -> str:
    return f"(CASE WHEN regexp_matches({c}, '{NUMBER}') THEN TRY_CAST(trim({c}) AS DOUBLE) END)"


def whole(c: str) -> str:
    n = num(c)
    return (
        f"(CASE WHEN regexp_matches({c}, '{WHOLE}') THEN TRY_CAST(trim({c}) AS BIGINT) "
        f"WHEN {n} = floor({n}) AND abs({n}) < 9.2e18 THEN TRY_CAST({n} AS BIGINT) END)"
    )


def r(x: str, digits: int = 9) -> str:
    """Half-even rounding in DOUBLE arithmetic."""
    return f"(round_even(({x}) * 1e{digits}, 0)::DOUBLE / 1e{digits})"


def clip(x: str, low: str, high: str) -> str:
    return f"(CASE WHEN {x} IS NOT NULL THEN greatest({low}, least({high}, {x})) END)"


def pct(a: str, b: str) -> str:
    return r(f"({a})::DOUBLE / nullif(({b})::DOUBLE, 0e0) * 100e0", 2)


_INTS = (
    "patientunitstayid patienthealthsystemstayid hospitalid wardid hospitaldischargeoffset unitdischargeoffset "
    "unitvisitnumber chronic_conditions readmitted"
).split()
_FLOATS = "admissionheight admissionweight los LACE_Score".split()
_REPLACED = ", ".join(
    [f"{whole(c)} AS {c}" for c in _INTS]
    + [f"{num(c)} AS {c}" for c in _FLOATS]
    + [
        "CASE WHEN regexp_matches(trim(hospitaladmittime24), '^([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]$') "
        "THEN trim(hospitaladmittime24) END AS hospitaladmittime24",
        "try_strptime(admit_day, '%-d/%-m/%Y') AS admit_day",
    ]
)

RAW = "raw AS (" + VISITS_SQL.format(lineitem="lineitem", orders="orders", part="part") + ")"

TYPED = f"""
typed AS (
  SELECT * REPLACE ({_REPLACED}),
    CASE WHEN lower(trim(gender)) IN ('male','m') THEN 'male' WHEN lower(trim(gender)) IN ('female','f') THEN 'female'
      ELSE 'unknown' END AS gender_normalized,
    {clip(whole('age'), '0', '115')} AS age_years,
    lower(trim(coalesce(hospitaldischargestatus,''))) AS hospital_discharge_status_normalized,
    lower(trim(coalesce(unitdischargestatus,''))) AS unit_discharge_status_normalized,
    strftime(TRY_CAST(_airbyte_emitted_at AS TIMESTAMP), '%Y-%m-%d') AS silver_processed_date
  FROM raw
),
hashed AS (
  SELECT *,
    hospital_discharge_status_normalized = 'expired' AS is_expired,
    coalesce(unitdischargeoffset, 0) / 60e0 AS estimated_unit_los_hours,
    '2024-02-01T00:00:00+00:00' AS processed_at_utc,
    sha256(coalesce(patientunitstayid::VARCHAR,'<NA>') ||'|'|| coalesce(patienthealthsystemstayid::VARCHAR,'<NA>')
      ||'|'|| coalesce(hospitalid::VARCHAR,'<NA>') ||'|'|| coalesce(wardid::VARCHAR,'<NA>')
      ||'|'|| coalesce(uniquepid,'None') ||'|'|| coalesce(_airbyte_emitted_at,'None')) AS record_hash
  FROM typed
)"""


def last(source: str, key: str = "record_hash") -> str:
    return f"""SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key}
      ORDER BY _o1 DESC NULLS LAST, _o2 DESC NULLS LAST, _o3 DESC NULLS LAST, _o4 DESC NULLS LAST) AS _rn
      FROM {source}) WHERE _rn = 1"""


def _draw(salt: str) -> str:
    return f"('0x'||substr(sha256(record_hash||'|{salt}'),1,8))::UBIGINT::DOUBLE / 4294967295e0 AS {salt}"


_FILL = f"""
drawn AS (
  SELECT *, {', '.join(_draw(s) for s in ('u1', 'u2', 'u3', 'u4'))},
    coalesce(age_years,0)::DOUBLE AS age0, (coalesce(age_years,0) >= 65)::BIGINT AS senior
  FROM {{source}}
),
fill1 AS (
  SELECT * REPLACE (
      coalesce(los, {r(clip('hospitaldischargeoffset/1440e0', '0.5e0', '21e0'), 2)}, {r('1.5e0 + u1*5.5e0', 2)}) AS los,
      coalesce(chronic_conditions, greatest(0, least(8, round_even(u2*5e0,0)::BIGINT + senior))) AS chronic_conditions,
      coalesce(Condition, nullif(trim(coalesce(apacheadmissiondx,'')),''), 'General Medical') AS Condition),
    CASE WHEN contains(lower(coalesce(ethnicity,'')),'white') THEN 'White'
         WHEN contains(lower(coalesce(ethnicity,'')),'caucasian') THEN 'White'
         WHEN contains(lower(coalesce(ethnicity,'')),'black') THEN 'African American'
         WHEN contains(lower(coalesce(ethnicity,'')),'african') THEN 'African American'
         WHEN contains(lower(coalesce(ethnicity,'')),'asian') THEN 'Asian'
         WHEN contains(lower(coalesce(ethnicity,'')),'hispanic') THEN 'Hispanic' ELSE 'Other' END AS ethnic_group_c,
    CASE WHEN u1 < 0.03e0 THEN 'Self-pay' WHEN age0 < 30 AND u1 < 0.4e0 THEN 'Medicaid'
         WHEN age0 >= 65 THEN 'Medicare' ELSE 'Commercial' END AS insurance_provider,
    CASE WHEN u2 < 0.15e0 THEN 'Home health + chronic disease management'
         WHEN u2 < 0.35e0 THEN 'Medication reconciliation and PCP follow-up'
         ELSE 'Standard follow-up in 7 days' END AS care_plan_following_discharge,
    (u1 < 0.23e0)::BIGINT AS diabetes, (u2 < 0.28e0)::BIGINT AS obesity, (u3 < 0.20e0)::BIGINT AS anxiety,
    (u4 < 0.18e0)::BIGINT AS depression, (age0 >= 70 AND u1 < 0.22e0)::BIGINT AS dementia,
    (u2 < 0.12e0)::BIGINT AS drugabuse, (u3 < 0.15e0)::BIGINT AS mooddisorder, (u4 < 0.27e0)::BIGINT AS tobacco_user,
    round_even(u1*4e0,0)::BIGINT AS ed_visits, round_even(u2*3e0,0)::BIGINT AS ip_visits,
    round_even(108e0+u1*42e0,0)::DOUBLE AS bp_systolic, round_even(62e0+u2*28e0,0)::DOUBLE AS bp_diastolic,
    round_even(58e0+u3*52e0,0)::DOUBLE AS pulse, round_even(12e0+u4*14e0,0)::DOUBLE AS respirations,
    {r('36.1e0+u1*2.1e0', 1)} AS temperature,
    coalesce({r("admissionweight/((nullif(admissionheight,0e0)/100e0)*(nullif(admissionheight,0e0)/100e0))", 1)},
      {r('20e0+u2*15e0', 1)}) AS bmi
  FROM drawn
),
fill2 AS (
  SELECT * REPLACE (coalesce(LACE_Score, greatest(0e0, least(19e0, round_even({clip('los', '0e0', '14e0')}*0.7e0
      + ed_visits::DOUBLE*1.2e0 + chronic_conditions::DOUBLE*1.4e0 + senior::DOUBLE*2e0 + u3*2e0, 0)::DOUBLE))) AS LACE_Score),
    {r('90e0+chronic_conditions::DOUBLE*6e0+u1*35e0', 1)} AS glucose,
    {r('0.7e0+chronic_conditions::DOUBLE*0.08e0+u2*0.7e0', 2)} AS creatinine,
    {r('4.2e0+u3*9.8e0', 2)} AS wbc, {r('10.5e0+u4*5.5e0', 2)} AS hemoglobin,
    {r('3.4e0+u1*1.8e0', 2)} AS potassium, {r('133e0+u2*12e0', 1)} AS sodium, {r('8.2e0+u3*2.1e0', 2)} AS calcium,
    {r('3500e0+los*1200e0+chronic_conditions::DOUBLE*420e0+u4*900e0', 2)} AS cost_of_initial_stay,
    {r('180e0+chronic_conditions::DOUBLE*95e0+u3*220e0', 2)} AS care_plan_costs
  FROM fill1
),
fill3 AS (
  SELECT * REPLACE (coalesce(readmitted,
      (u4 < least(0.65e0, 0.08e0 + LACE_Score/40e0 + chronic_conditions::DOUBLE/25e0))::BIGINT) AS readmitted)
  FROM fill2
),
fill4 AS (
  SELECT *, CASE WHEN readmitted = 1 THEN 1e0 + round_even(u1*59e0,0)::DOUBLE ELSE 0e0 END AS days_until_readmission
  FROM fill3
),
{{name}} AS (
  SELECT * EXCLUDE (u1,u2,u3,u4,age0,senior),
    (readmitted = 1 AND days_until_readmission <= 30)::BIGINT AS readmitted_under_30_days
  FROM fill4
)"""

TO_HASH = f"WITH {RAW},{TYPED}"
SILVER_ROWS = TO_HASH + "," + _FILL.format(source="hashed", name="silver")
SILVER = TO_HASH + f", latest AS ({last('hashed')})," + _FILL.format(source="latest", name="silver")

RISK = (
    f"(0.2e0*{clip('coalesce(age_years,0)/100e0', '0e0', '1e0')} + 0.2e0*{clip('coalesce(los,0)/30e0', '0e0', '1e0')} + "
    f"0.3e0*{clip('coalesce(LACE_Score,0)/19e0', '0e0', '1e0')} + "
    f"0.2e0*{clip('coalesce(chronic_conditions,0)/15e0', '0e0', '1e0')} + "
    "0.1e0*(coalesce(unitvisitnumber,1) > 1)::INTEGER::DOUBLE)"
)

DOCTOR = SILVER + f""", risked AS (SELECT *, greatest(0e0, least(1e0, {RISK})) AS risk_score FROM silver),
doctor AS (
  SELECT '2024-02-01' AS as_of_date, patientunitstayid, patienthealthsystemstayid, uniquepid, hospitalid, wardid, unittype,
    apacheadmissiondx, Condition, insurance_provider, ethnic_group_c, gender_normalized, age_years, los, LACE_Score,
    chronic_conditions, glucose, creatinine, wbc, hemoglobin, unitvisitnumber, is_expired, readmitted,
    readmitted_under_30_days, days_until_readmission, risk_score,
    CASE WHEN risk_score <= -0.001e0 THEN NULL WHEN risk_score <= 0.35e0 THEN 'low' WHEN risk_score <= 0.7e0 THEN 'medium'
      WHEN risk_score <= 1e0 THEN 'high' END AS risk_band,
    risk_score >= 0.7e0 AS is_high_risk, record_hash, processed_at_utc
  FROM risked)"""

_MODEL_LIST = f"""
    patientunitstayid, uniquepid, coalesce(hospitalid,0) AS hospitalid, coalesce(wardid,0) AS wardid,
    coalesce(nullif(unittype,''),'unknown') AS unittype, coalesce(nullif(gender,''),'unknown') AS gender,
    coalesce(nullif(ethnicity,''),'unknown') AS ethnicity, ethnic_group_c, insurance_provider,
    coalesce({num('age')},0e0) AS age, los, LACE_Score, bp_systolic, bp_diastolic, pulse, respirations, temperature, bmi,
    glucose, creatinine, wbc, hemoglobin, potassium, sodium, calcium, ed_visits, ip_visits, chronic_conditions, diabetes,
    obesity, anxiety, depression, dementia, drugabuse, mooddisorder, tobacco_user, cost_of_initial_stay, care_plan_costs,
    coalesce(nullif(Condition,''),'unspecified') AS Condition, care_plan_following_discharge, readmitted,
    readmitted_under_30_days, days_until_readmission, processed_at_utc"""

MODEL = SILVER + f", model AS (SELECT {_MODEL_LIST} FROM silver)"

LIVE = (
    f"(0.35e0*{clip('LACE_Score/19e0', '0e0', '1e0')} + 0.2e0*{clip('los/30e0', '0e0', '1e0')} + "
    f"0.2e0*{clip('chronic_conditions/15e0', '0e0', '1e0')} + 0.25e0*{clip('age/100e0', '0e0', '1e0')})"
)

COHORT = SILVER + f""", model AS (SELECT {_MODEL_LIST}, admit_day, record_hash FROM silver),
cohort AS (
  SELECT *, CASE WHEN risk_score_live >= 0.75e0 THEN 'Intensive Care Transition'
      WHEN risk_score_live >= 0.5e0 THEN 'Enhanced Follow-up' WHEN risk_score_live >= 0.3e0 THEN 'Standard Follow-up'
      ELSE 'Routine Monitoring' END AS suggested_intervention_bucket
  FROM (SELECT *, date_trunc('month', admit_day)::TIMESTAMP AS admit_month,
      CASE WHEN age < 0 THEN NULL WHEN age <= 30 THEN '0-30' WHEN age <= 45 THEN '31-45' WHEN age <= 60 THEN '46-60'
        WHEN age <= 75 THEN '61-75' WHEN age <= 90 THEN '76-90' WHEN age <= 120 THEN '90+' END AS age_band,
      greatest(0e0, least(1e0, {LIVE})) AS risk_score_live FROM model))"""

SCORED = COHORT + """, scored AS (
  SELECT record_hash, readmitted_under_30_days AS label, risk_score_live AS score FROM cohort)"""
