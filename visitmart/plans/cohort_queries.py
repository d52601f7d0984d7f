"""Queries on filters, trends, segments, distributions and data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from visitmart import schema as S
from visitmart.operators import cohort as C
from visitmart.operators import quality as Q
from visitmart.operators import sketches as K
from visitmart.operators.ordered import box_stats, exact_quantiles, histogram, median
from visitmart.plans import oracle as O
from visitmart.plans import visits as V
from visitmart.plans.registry import query, rounded
from visitmart.session import materialise

RATE = O.r("avg(readmitted_under_30_days) * 100e0")


@query("risk_score_live", f"{O.COHORT} SELECT record_hash, risk_score_live, suggested_intervention_bucket FROM cohort")
def risk_score_live(spark, sf_dir):
    return V.cohort(spark, sf_dir).select("record_hash", "risk_score_live", "suggested_intervention_bucket")


@query("admit_month", f"{O.COHORT} SELECT record_hash, admit_day, admit_month FROM cohort")
def admit_month(spark, sf_dir):
    return C.with_admit_month(V.silver_latest(spark, sf_dir)).select("record_hash", "admit_day", "admit_month")


@query(
    "admit_month_fallback",
    f"{O.MODEL} SELECT patientunitstayid, TIMESTAMP '2024-02-01 00:00:00' AS admit_day, "
    "TIMESTAMP '2024-02-01 00:00:00' AS admit_month FROM model",
)
def admit_month_fallback(spark, sf_dir):
    return C.with_admit_month(V.model(spark, sf_dir)).select("patientunitstayid", "admit_day", "admit_month")


@query("filter_in", f"{O.COHORT} SELECT record_hash, unittype FROM cohort WHERE unittype IN ('unknown','PROMO')")
def filter_in(spark, sf_dir):
    kept = C.filter_in(V.cohort(spark, sf_dir), "unittype", ["unknown", "PROMO"], null_as="unknown")
    return kept.select("record_hash", "unittype")


@query("filter_outcome", f"{O.COHORT} SELECT record_hash FROM cohort WHERE readmitted_under_30_days = 1")
def filter_outcome(spark, sf_dir):
    return C.filter_outcome(V.cohort(spark, sf_dir), "Readmitted").select("record_hash")


@query("filter_range", f"{O.COHORT} SELECT record_hash, age FROM cohort WHERE age BETWEEN 40 AND 65")
def filter_range(spark, sf_dir):
    return C.filter_range(V.cohort(spark, sf_dir), "age", 40, 65).select("record_hash", "age")


@query(
    "cohort_filter",
    f"{O.COHORT} SELECT record_hash, hospitalid, unittype, gender, age FROM cohort WHERE hospitalid IN (60,61,62,70,80) "
    "AND unittype IN ('unknown','PROMO','LARGE') AND gender IN ('Male','f') AND readmitted_under_30_days = 0 "
    "AND age >= 30 AND age <= 90",
)
def cohort_filter(spark, sf_dir):
    wanted = C.Cohort((60, 61, 62, 70, 80), ("unknown", "PROMO", "LARGE"), ("Male", "f"), "Not Readmitted", 30, 90)
    kept = C.apply_filters(V.cohort(spark, sf_dir), wanted)
    return kept.select("record_hash", "hospitalid", "unittype", "gender", "age")


@query(
    "filter_domains",
    f"""{O.COHORT} SELECT DISTINCT 'hospitalid' AS filter, hospitalid::VARCHAR AS value FROM cohort
      UNION SELECT 'unittype', coalesce(unittype,'unknown') FROM cohort
      UNION SELECT 'gender', coalesce(gender,'unknown') FROM cohort
      UNION SELECT 'age_min', floor(min(age))::BIGINT::VARCHAR FROM cohort
      UNION SELECT 'age_max', floor(max(age))::BIGINT::VARCHAR FROM cohort""",
)
def filter_domains(spark, sf_dir):
    return C.filter_domains(V.cohort(spark, sf_dir))


@query(
    "domain_profile",
    f"""WITH {O.RAW} SELECT DISTINCT 'gender' AS column_name, trim(gender) AS value FROM raw WHERE trim(gender) <> ''
      UNION SELECT 'ethnicity', trim(ethnicity) FROM raw WHERE trim(ethnicity) <> ''
      UNION SELECT 'apacheadmissiondx', trim(apacheadmissiondx) FROM raw WHERE trim(apacheadmissiondx) <> ''
      UNION SELECT 'unittype', trim(unittype) FROM raw WHERE trim(unittype) <> ''
      UNION SELECT 'hospitalid_min', min(hospitalid::BIGINT)::VARCHAR FROM raw
      UNION SELECT 'hospitalid_max', max(hospitalid::BIGINT)::VARCHAR FROM raw
      UNION SELECT 'wardid_min', min(wardid::BIGINT)::VARCHAR FROM raw
      UNION SELECT 'wardid_max', max(wardid::BIGINT)::VARCHAR FROM raw""",
)
def domain_profile(spark, sf_dir):
    categories = ["gender", "ethnicity", "apacheadmissiondx", "unittype"]
    return C.domain_profile(V.visits_raw(spark, sf_dir), categories, ["hospitalid", "wardid"], (60, 90))


@query(
    "executive_kpis",
    f"""{O.COHORT} SELECT count(*) AS total_admissions, sum(readmitted)::BIGINT AS total_readmissions,
      sum(readmitted_under_30_days)::BIGINT AS readmissions_30d,
      {O.r('sum(readmitted_under_30_days)::DOUBLE/count(*)::DOUBLE*100e0', 6)} AS readmission_30d_rate_pct,
      {O.r('avg(days_until_readmission) FILTER (readmitted = 1)', 6)} AS avg_days_to_readmission,
      count(*) FILTER (risk_score_live >= 0.75e0) AS high_risk_patients,
      {O.r('sum(readmitted)::DOUBLE/count(*)::DOUBLE*100e0', 6)} AS readmission_any_rate_pct,
      {O.r('count(*) FILTER (risk_score_live >= 0.75e0)::DOUBLE/count(*)::DOUBLE*100e0', 6)} AS high_risk_rate_pct,
      {O.r('avg(los)', 6)} AS avg_los, {O.r('avg(LACE_Score)', 6)} AS avg_lace_score,
      {O.r('avg(chronic_conditions)', 6)} AS avg_chronic_conditions,
      count(*) FILTER (chronic_conditions >= 2) AS multi_chronic_patients,
      {O.r('avg(cost_of_initial_stay)', 6)} AS avg_initial_stay_cost, {O.r('avg(care_plan_costs)', 6)} AS avg_care_plan_cost,
      {O.r('median(los)', 6)} AS median_los FROM cohort""",
)
def executive_kpis(spark, sf_dir):
    visits = V.cohort(spark, sf_dir)
    return rounded(C.executive_kpis(visits, median(visits, "los")), 6)


_TREND = f"""trend AS (SELECT admit_month, count(patientunitstayid) AS admissions, sum(readmitted)::BIGINT AS readmissions_any,
    sum(readmitted_under_30_days)::BIGINT AS readmissions_30d,
    sum(readmitted_under_30_days)::DOUBLE/count(patientunitstayid)::DOUBLE*100e0 AS rate FROM cohort GROUP BY admit_month)"""


@query(
    "monthly_trend",
    f"{O.COHORT}, {_TREND} SELECT admit_month, admissions, readmissions_any, readmissions_30d, "
    f"{O.r('rate')} AS readmission_30d_rate_pct FROM trend",
)
def monthly_trend(spark, sf_dir):
    return rounded(C.monthly_trend(V.cohort(spark, sf_dir)))


@query(
    "trailing_mean",
    f"""{O.COHORT}, {_TREND} SELECT admit_month, {O.r('avg(rate) OVER w')} AS readmission_30d_rate_pct_ma FROM trend
      WINDOW w AS (ORDER BY admit_month NULLS LAST ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
)
def trailing_mean(spark, sf_dir):
    smoothed = C.trailing_mean(C.monthly_trend(V.cohort(spark, sf_dir)), "admit_month", "readmission_30d_rate_pct")
    return rounded(smoothed.select("admit_month", "readmission_30d_rate_pct_ma"))


@query(
    "rate_by_age_band",
    f"""{O.COHORT} SELECT age_band, readmission_rate_pct FROM (SELECT unnest(['0-30','31-45','46-60','61-75','76-90','90+'])
      AS age_band) LEFT JOIN (SELECT age_band, {RATE} AS readmission_rate_pct FROM cohort GROUP BY 1) USING (age_band)""",
)
def rate_by_age_band(spark, sf_dir):
    return rounded(C.rate_by_age_band(V.cohort(spark, sf_dir)))


@query(
    "rate_by_segment",
    O.COHORT
    + " "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS segment, {c} AS segment_value, {RATE} AS readmission_rate_pct FROM cohort GROUP BY {c}"
        for c in S.SEGMENT_COLUMNS
    ),
)
def rate_by_segment(spark, sf_dir):
    return rounded(C.rate_by_segment(V.cohort(spark, sf_dir)))


@query(
    "top_conditions",
    f"{O.COHORT} SELECT Condition, {RATE} AS readmission_rate_pct FROM cohort GROUP BY Condition "
    "ORDER BY avg(readmitted_under_30_days) * 100e0 DESC, Condition LIMIT 10",
)
def top_conditions(spark, sf_dir):
    return rounded(C.top_conditions(V.cohort(spark, sf_dir)))


@query("rate_heatmap", f"{O.COHORT} SELECT hospitalid, unittype, {RATE} AS rate FROM cohort GROUP BY 1, 2")
def rate_heatmap(spark, sf_dir):
    return rounded(C.rate_heatmap(V.cohort(spark, sf_dir)))


def _histogram_sql(column: str, by: str = "") -> str:
    lead = f"{by}, " if by else ""
    return f"""{O.COHORT}, e AS (SELECT min({column})::DOUBLE AS low, max({column})::DOUBLE AS high FROM cohort)
      SELECT {lead}bin::INTEGER AS bin, count(*) AS count, {O.r('min(low + bin*((high-low)/30e0))')} AS bin_start FROM (
        SELECT {lead}low, high, least(coalesce(floor(({column}-low)/nullif((high-low)/30e0,0e0)),0e0), 29e0) AS bin
        FROM cohort, e WHERE {column} IS NOT NULL) GROUP BY {lead}bin"""


@query("lace_histogram", _histogram_sql("LACE_Score", "readmitted_under_30_days"))
def lace_histogram(spark, sf_dir):
    return rounded(histogram(V.cohort(spark, sf_dir), "LACE_Score", 30, [S.TARGET]))


@query("risk_histogram", _histogram_sql("risk_score_live"))
def risk_histogram(spark, sf_dir):
    return rounded(histogram(V.cohort(spark, sf_dir), "risk_score_live", 30))


def _box_sql(columns: list[str]) -> str:
    return O.COHORT + " " + " UNION ALL ".join(
        f"SELECT readmitted_under_30_days, '{c}' AS measure, count({c}) AS n, min({c})::DOUBLE AS least, "
        f"max({c})::DOUBLE AS greatest, {O.r(f'quantile_cont({c}::DOUBLE,0.25)')} AS q1, "
        f"{O.r(f'quantile_cont({c}::DOUBLE,0.5)')} AS median, {O.r(f'quantile_cont({c}::DOUBLE,0.75)')} AS q3 "
        "FROM cohort GROUP BY readmitted_under_30_days"
        for c in columns
    )


@query("lab_box_stats", _box_sql(S.LAB_COLUMNS))
def lab_box_stats(spark, sf_dir):
    return rounded(box_stats(V.cohort(spark, sf_dir), S.LAB_COLUMNS, S.TARGET))


@query("stay_box_stats", _box_sql(["los"]))
def stay_box_stats(spark, sf_dir):
    return rounded(box_stats(V.cohort(spark, sf_dir), ["los"], S.TARGET))


_MEASURES = [*S.LAB_COLUMNS, "los"]
_POINTS = 20  # few, so that the error shows on small tables as well
_SKETCHES = (
    O.COHORT
    + ", long AS ("
    + " UNION ALL ".join(
        f"SELECT strftime(admit_month, '%Y-%m') AS month, '{c}' AS measure, {c}::DOUBLE AS value FROM cohort WHERE {c} IS NOT NULL"
        for c in _MEASURES
    )
    + f"""), ranked AS (
      SELECT month, measure, value, n, ((sum(n) OVER (PARTITION BY month, measure ORDER BY value) - n) * {_POINTS})
        // sum(n) OVER (PARTITION BY month, measure) AS cut
      FROM (SELECT month, measure, value, count(*) AS n FROM long GROUP BY ALL)),
    sketch AS (SELECT month, measure, max(value) AS value, sum(n)::BIGINT AS n FROM ranked GROUP BY month, measure, cut)"""
)


def _by_month(spark, sf_dir):
    visits = V.cohort(spark, sf_dir).select(
        F.date_format("admit_month", "yyyy-MM").alias("month"), *[F.col(c).cast("double").alias(c) for c in _MEASURES]
    )
    return visits.unpivot(["month"], _MEASURES, "measure", "value")


@query("rank_sketches", f"{_SKETCHES} SELECT * FROM sketch")
def rank_sketches(spark, sf_dir):
    return K.rank_sketch(_by_month(spark, sf_dir), "value", ["month", "measure"], _POINTS)


@query(
    "sketch_quantiles",
    f"""{_SKETCHES}, upto AS (
      SELECT measure, value, sum(n) OVER (PARTITION BY measure ORDER BY value) AS upto, sum(n) OVER (PARTITION BY measure) AS total
      FROM (SELECT measure, value, sum(n) AS n FROM sketch GROUP BY ALL))
    SELECT measure, max(total)::BIGINT AS n, {O.r(f"max(total)::DOUBLE / {_POINTS}e0")} AS rank_error,
      {", ".join(f"{O.r(f'min(value) FILTER (upto >= greatest(1, ceil({q}e0 * total::DOUBLE)))')} AS {name}"
                 for name, q in (("p10", 0.1), ("median", 0.5), ("p90", 0.9)))},
      true AS within
    FROM upto GROUP BY measure""",
)
def sketch_quantiles(spark, sf_dir):
    """Quantiles of all months from the months' sketches, and whether the rows themselves have them within the bound."""
    rows = materialise(_by_month(spark, sf_dir).where("value IS NOT NULL"))
    shares = {"p10": 0.1, "median": 0.5, "p90": 0.9}
    told = materialise(K.sketch_quantiles(K.rank_sketch(rows, "value", ["month", "measure"], _POINTS), shares, ["measure"], _POINTS))
    both = rows.groupBy("measure", "value").agg(F.count("*").alias("k")).join(told, "measure")
    holds = F.lit(True)
    for name, share in shares.items():
        rank = F.greatest(F.lit(1), F.ceil(F.lit(share) * F.first("n")))
        upto, below = (F.sum(F.when(c, F.col("k")).otherwise(0)) for c in (F.col("value") <= F.col(name), F.col("value") < F.col(name)))
        holds = holds & (upto >= rank) & (below < rank + F.first("rank_error"))
    checked = both.groupBy("measure").agg(holds.alias("within"))
    return rounded(told.join(checked, "measure"))


@query(
    "risk_deciles_by_hospital",
    f"""{O.COHORT} SELECT hospitalid, count(*) AS n, {O.r('min(risk_score_live)')} AS least, {O.r('max(risk_score_live)')} AS greatest,
      {O.r('quantile_cont(risk_score_live,0.1)')} AS p10, {O.r('quantile_cont(risk_score_live,0.9)')} AS p90
      FROM cohort GROUP BY hospitalid""",
)
def risk_deciles_by_hospital(spark, sf_dir):
    quantiles = {"p10": 0.1, "p90": 0.9}
    return rounded(exact_quantiles(V.cohort(spark, sf_dir), "risk_score_live", quantiles, ["hospitalid"]))


@query(
    "rate_by_chronic",
    f"{O.COHORT} SELECT chronic_conditions, {RATE} AS readmission_rate_pct FROM cohort GROUP BY 1",
)
def rate_by_chronic(spark, sf_dir):
    return rounded(C.rate_by_chronic(V.cohort(spark, sf_dir)))




@query(
    "missing_pct",
    O.COHORT
    + " SELECT feature, "
    + O.r("pct")
    + """ AS missing_pct FROM (UNPIVOT (SELECT avg((COLUMNS(*) IS NULL)::INTEGER)*100e0 AS "\\0" FROM cohort)
    ON COLUMNS(*) INTO NAME feature VALUE pct) ORDER BY pct DESC, feature LIMIT 30""",
)
def missing_pct(spark, sf_dir):
    return rounded(Q.missing_pct(V.cohort(spark, sf_dir)))


@query(
    "completeness_by_month",
    O.TO_HASH
    + ", m AS (SELECT *, date_trunc('month', admit_day)::TIMESTAMP AS admit_month FROM hashed) SELECT admit_month, "
    # the source has two of the seven features; the others are missing in every row
    + O.r("(avg((LACE_Score IS NOT NULL)::INTEGER) + avg((los IS NOT NULL)::INTEGER)) / 7e0 * 100e0")
    + " AS completeness_pct FROM m GROUP BY admit_month",
)
def completeness_by_month(spark, sf_dir):
    from visitmart.operators.silver import clean
    from visitmart.streaming.incremental import complete_source

    cleaned = clean(complete_source(V.visits_raw(spark, sf_dir)), V.PROCESSED_AT).select("admit_day", *S.KEY_FEATURES)
    return rounded(Q.completeness_by_month(C.with_admit_month(cleaned)))


_ALL_ROWS = O.SILVER_ROWS + (
    ", days AS (SELECT patientunitstayid, admit_day, date_trunc('month', admit_day)::TIMESTAMP AS admit_month FROM silver)"
)


def _days(spark, sf_dir):
    return C.with_admit_month(V.silver_rows(spark, sf_dir).select("patientunitstayid", "admit_day"))


@query(
    "duplicate_count",
    f"""{_ALL_ROWS} SELECT sum(n-1)::BIGINT AS duplicate_rows, sum(n)::BIGINT AS total_rows,
      {O.r('sum(n-1)::DOUBLE/sum(n)::DOUBLE*100e0')} AS duplicate_pct
      FROM (SELECT count(*) AS n FROM days GROUP BY patientunitstayid, admit_day)""",
)
def duplicate_count(spark, sf_dir):
    return rounded(Q.duplicate_count(_days(spark, sf_dir)))


@query(
    "duplicates_by_month",
    f"""{_ALL_ROWS} SELECT admit_month, sum(CASE WHEN n > 1 THEN n ELSE 0 END)::BIGINT AS duplicate_rows FROM (
      SELECT admit_month, count(*) AS n FROM days GROUP BY patientunitstayid, admit_day, admit_month) GROUP BY admit_month""",
)
def duplicates_by_month(spark, sf_dir):
    return Q.duplicates_by_month(_days(spark, sf_dir))


@query(
    "label_balance",
    O.COHORT
    + " "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS label, {c} AS class, count(*) AS count FROM cohort GROUP BY {c}"
        for c in ("readmitted", "readmitted_under_30_days")
    ),
)
def label_balance(spark, sf_dir):
    return C.label_balance(V.cohort(spark, sf_dir), ["readmitted", S.TARGET])


@query(
    "label_balance_documents",
    "SELECT 'quality' AS label, quality::BIGINT AS class, count(*) AS count FROM labels WHERE quality IS NOT NULL GROUP BY 2 "
    "UNION ALL SELECT 'toxic', toxic::BIGINT, count(*) FROM labels WHERE toxic IS NOT NULL GROUP BY 2",
)
def label_balance_documents(spark, sf_dir):
    return C.label_balance(V.table(spark, sf_dir, "labels"), ["quality", "toxic"])


@query(
    "positive_rate",
    f"{O.MODEL} SELECT count(*) AS rows, {RATE} AS target_positive_rate_pct FROM model",
)
def positive_rate(spark, sf_dir):
    return rounded(C.positive_rate(V.model(spark, sf_dir)))


@query(
    "top_risk",
    f"""{O.COHORT} SELECT patientunitstayid, risk_score_live, LACE_Score, los, chronic_conditions,
      suggested_intervention_bucket FROM cohort ORDER BY risk_score_live DESC, record_hash LIMIT 30""",
)
def top_risk(spark, sf_dir):
    return C.top_risk(V.cohort(spark, sf_dir))


@query(
    "preventable_by_capacity",
    f"""{O.COHORT}, ranked AS (SELECT risk_score_live AS s, row_number() OVER (ORDER BY risk_score_live DESC, record_hash) AS k
      FROM cohort), n AS (SELECT count(*) AS n FROM cohort)
    SELECT intervention_capacity::BIGINT AS intervention_capacity,
      {O.r('coalesce(sum(s),0e0) * 0.3e0')} AS expected_preventable_readmissions
    FROM (SELECT asked, least(asked, n) AS intervention_capacity FROM
        (SELECT DISTINCT least(a, CASE WHEN a = 1000 THEN n ELSE a END) AS asked FROM
          (SELECT unnest([50,100,200,500,1000]) AS a), n), n)
      LEFT JOIN ranked ON k <= intervention_capacity GROUP BY asked, intervention_capacity""",
)
def preventable_by_capacity(spark, sf_dir):
    return rounded(C.preventable_by_capacity(V.cohort(spark, sf_dir)))
