"""Cohort filters and the aggregates drawn from the final dataset."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitmart import schema as S
from visitmart.functions.bands import AGE_BANDS, cut, intervention_bucket
from visitmart.functions.numbers import percent, to_float
from visitmart.functions.risk import risk_score_live
from visitmart.functions.text import parse_day_first, utc_wall_time
from visitmart.operators.final import with_all_bands

HIGH_RISK_LIVE = 0.75
_FALLBACK_DATES = "processed_at_utc _airbyte_emitted_at discharge_day readmission_admit_day".split()
_NO_TIME = "timestamp_ntz"


def _as_time(df: DataFrame, name: str, day_first: bool) -> Column:
    if name not in df.columns:
        return F.lit(None).cast(_NO_TIME)
    kind = df.schema[name].dataType.typeName()
    if kind.startswith("timestamp") or kind == "date":
        return F.col(name).cast(_NO_TIME)
    return parse_day_first(name) if day_first else utc_wall_time(name)


def _add_month(df: DataFrame, day: Column) -> DataFrame:
    out = df.withColumn("admit_day", day)
    return out.withColumn("admit_month", F.date_trunc("month", "admit_day").cast(_NO_TIME))


def with_admit_month(df: DataFrame) -> DataFrame:
    """Admission day and its month.

    Only when no row has an admission day does another column stand in: the first
    of four that has any value. Which one it is comes from one aggregate over
    the five columns.
    """
    days = [_as_time(df, "admit_day", True)] + [
        _as_time(df, name, name in S.DATE_COLUMNS) for name in _FALLBACK_DATES
    ]
    choice = F.coalesce(
        *[F.when(F.max(day.isNotNull()), F.lit(position)) for position, day in enumerate(days)], F.lit(0)
    )
    chosen = df.agg(choice.alias("choice")).scalar()
    day = F.when(F.lit(False), days[0])
    for position, candidate in enumerate(days[1:], start=1):
        day = day.when(chosen == position, candidate)
    return _add_month(df, day.otherwise(days[0]))


def prepare(df: DataFrame, has_admit_day: bool = False) -> DataFrame:
    """Add month, age band, live risk score and intervention to the final dataset.

    ``has_admit_day`` says that admission days are known to be there, which saves the
    pass that looks for them.
    """
    typed = {name: to_float(df, name) for name in ("age",) if name in df.columns}
    typed.update(
        {
            name: F.coalesce(to_float(df, name), F.lit(0.0)).cast("long")
            for name in ("readmitted", S.TARGET)
            if name in df.columns
        }
    )
    out = df.withColumns(typed)
    out = _add_month(out, _as_time(out, "admit_day", True)) if has_admit_day else with_admit_month(out)
    out = out.withColumns(
        {"age_band": cut("age", AGE_BANDS), "risk_score_live": risk_score_live(out)}
    )
    return out.withColumn("suggested_intervention_bucket", intervention_bucket("risk_score_live"))


# ---------------------------------------------------------------- filters


def filter_in(df: DataFrame, column: str, values: list, null_as: str | None = None) -> DataFrame:
    """Rows whose value is listed. No list means no filter."""
    if not values:
        return df
    col = F.col(column) if null_as is None else F.coalesce(F.col(column), F.lit(null_as))
    return df.where(col.isin(list(values)))


def filter_outcome(df: DataFrame, which: str = "All") -> DataFrame:
    flags = {"Readmitted": 1, "Not Readmitted": 0}
    return df if which == "All" else df.where(F.col(S.TARGET) == flags[which])


def filter_range(df: DataFrame, column: str, low: float | None = None, high: float | None = None) -> DataFrame:
    """Rows within the bounds, both included; a row without a value is left out."""
    out = df.where(F.col(column).isNotNull())
    if low is not None:
        out = out.where(F.col(column) >= low)
    return out if high is None else out.where(F.col(column) <= high)


@dataclass(frozen=True)
class Cohort:
    hospitals: tuple[int, ...] = ()
    units: tuple[str, ...] = ()
    genders: tuple[str, ...] = ()
    outcome: str = "All"
    age_low: float | None = None
    age_high: float | None = None


def apply_filters(df: DataFrame, cohort: Cohort) -> DataFrame:
    out = filter_in(df, "hospitalid", list(cohort.hospitals))
    out = filter_in(out, "unittype", list(cohort.units), null_as="unknown")
    out = filter_in(out, "gender", list(cohort.genders), null_as="unknown")
    out = filter_outcome(out, cohort.outcome)
    return filter_range(out, "age", cohort.age_low, cohort.age_high)


def filter_domains(df: DataFrame) -> DataFrame:
    """What each filter can offer: ``(filter, value)`` rows for lists, two rows for the age range."""
    lists = df.select(
        F.col("hospitalid").cast("string").alias("hospitalid"),
        F.coalesce("unittype", F.lit("unknown")).alias("unittype"),
        F.coalesce("gender", F.lit("unknown")).alias("gender"),
    )
    options = lists.unpivot([], ["hospitalid", "unittype", "gender"], "filter", "value")
    ages = df.agg(
        F.floor(F.min("age")).cast("string").alias("age_min"), F.floor(F.max("age")).cast("string").alias("age_max")
    ).unpivot([], ["age_min", "age_max"], "filter", "value")
    return options.where("value IS NOT NULL").distinct().unionByName(ages).orderBy("filter", "value")


def domain_profile(df: DataFrame, categories: list[str], ids: list[str], default: tuple[int, int]) -> DataFrame:
    """Distinct trimmed non-empty values per category, and the least and greatest id per id column.

    One row per value, so a column with very many values stays spread over the cluster.
    """
    texts = df.select([F.trim(F.col(name).cast("string")).alias(name) for name in categories])
    values = texts.unpivot([], categories, "column_name", "value").where("value <> ''").distinct()
    bounds = df.agg(
        *[
            F.coalesce(pick_bound(to_float(df, name)), F.lit(float(fallback))).cast("long").cast("string").alias(
                f"{name}_{side}"
            )
            for name in ids
            for side, pick_bound, fallback in (("min", F.min, default[0]), ("max", F.max, default[1]))
        ]
    )
    names = bounds.columns
    return values.unionByName(bounds.unpivot([], names, "column_name", "value")).orderBy("column_name", "value")


# ---------------------------------------------------------------- KPIs and segments


def executive_kpis(df: DataFrame, median_los: DataFrame) -> DataFrame:
    """One row with the fifteen headline numbers. ``median_los`` is a one-row, one-column frame."""
    high = f"count_if(risk_score_live >= {HIGH_RISK_LIVE}D)"
    out = df.agg(
        F.count(F.lit(1)).alias("total_admissions"),
        F.sum("readmitted").alias("total_readmissions"),
        F.sum(S.TARGET).alias("readmissions_30d"),
        percent(f"sum({S.TARGET})", "count(1)", None).alias("readmission_30d_rate_pct"),
        F.avg(F.when(F.col("readmitted") == 1, F.col("days_until_readmission"))).alias("avg_days_to_readmission"),
        F.expr(high).alias("high_risk_patients"),
        percent("sum(readmitted)", "count(1)", None).alias("readmission_any_rate_pct"),
        percent(high, "count(1)", None).alias("high_risk_rate_pct"),
        F.avg("los").alias("avg_los"),
        F.avg("LACE_Score").alias("avg_lace_score"),
        F.avg("chronic_conditions").alias("avg_chronic_conditions"),
        F.sum((F.col("chronic_conditions") >= 2).cast("long")).alias("multi_chronic_patients"),
        F.avg("cost_of_initial_stay").alias("avg_initial_stay_cost"),
        F.avg("care_plan_costs").alias("avg_care_plan_cost"),
    )
    return out.withColumn("median_los", median_los.scalar())


def monthly_trend(df: DataFrame) -> DataFrame:
    out = df.groupBy("admit_month").agg(
        F.count("patientunitstayid").alias("admissions"),
        F.sum("readmitted").alias("readmissions_any"),
        F.sum(S.TARGET).alias("readmissions_30d"),
    )
    rate = percent("readmissions_30d", "admissions", None)
    return out.withColumn("readmission_30d_rate_pct", rate)


def trailing_mean(monthly: DataFrame, order: str, column: str, rows: int = 3) -> DataFrame:
    """Mean of the last ``rows`` rows. For aggregates with few rows only: it orders them in one task."""
    window = Window.orderBy(F.col(order).asc_nulls_last()).rowsBetween(1 - rows, 0)
    return monthly.withColumn(f"{column}_ma", F.avg(column).over(window))


def _rate() -> Column:
    return (F.avg(S.TARGET) * F.lit(100.0)).alias("readmission_rate_pct")


def rate_by_age_band(df: DataFrame) -> DataFrame:
    rates = df.where("age_band IS NOT NULL").groupBy("age_band").agg(_rate())
    return with_all_bands(rates, AGE_BANDS, "age_band").orderBy("band_order").drop("band_order")


def rate_by_segment(df: DataFrame, columns: list[str] = S.SEGMENT_COLUMNS) -> DataFrame:
    """Rate per value of each column, stacked. Each column is reduced map-side before its shuffle."""
    narrow = df.select(*columns, S.TARGET)
    return narrow.unpivot([S.TARGET], columns, "segment", "segment_value").groupBy("segment", "segment_value").agg(
        _rate()
    )


def top_conditions(df: DataFrame, n: int = 10) -> DataFrame:
    rates = df.groupBy("Condition").agg(_rate())
    return rates.orderBy(F.col("readmission_rate_pct").desc(), "Condition").limit(n)


def rate_heatmap(df: DataFrame) -> DataFrame:
    return df.groupBy("hospitalid", "unittype").agg((F.avg(S.TARGET) * F.lit(100.0)).alias("rate"))


def rate_by_chronic(df: DataFrame) -> DataFrame:
    return df.groupBy("chronic_conditions").agg(_rate()).orderBy("chronic_conditions")


def label_balance(df: DataFrame, labels: list[str]) -> DataFrame:
    """Rows per class of each label column."""
    narrow = df.select([F.col(name).cast("long").alias(name) for name in labels])
    out = narrow.unpivot([], labels, "label", "class").where("class IS NOT NULL")
    return out.groupBy("label", "class").agg(F.count(F.lit(1)).alias("count"))


def positive_rate(df: DataFrame, label: str = S.TARGET) -> DataFrame:
    """Rows, and the share of positive ones in percent; a missing label counts as negative."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        (F.avg(F.coalesce(to_float(df, label), F.lit(0.0))) * F.lit(100.0)).alias("target_positive_rate_pct"),
    )


# ---------------------------------------------------------------- ranking


def top_risk(df: DataFrame, score: str = "risk_score_live", n: int = 30, tie: str = "record_hash") -> DataFrame:
    columns = ["patientunitstayid", score, "LACE_Score", "los", "chronic_conditions", "suggested_intervention_bucket"]
    ranked = df.orderBy(F.col(score).desc(), F.col(tie).asc()).limit(n)
    return ranked.select([name for name in columns if name in df.columns])


CAPACITIES = (50, 100, 200, 500, 1000)


def preventable_by_capacity(
    df: DataFrame, efficacy: float = 0.3, score: str = "risk_score_live", tie: str = "record_hash"
) -> DataFrame:
    """Expected readmissions prevented by treating the k riskiest visits, for each capacity k.

    Only the 1000 riskiest rows can matter, so they are taken first and only
    they are ordered in one task. A capacity beyond the number of rows is
    cut to that number; the last capacity is shown once when it equals another.
    """
    best = df.select(score, tie).orderBy(F.col(score).desc(), F.col(tie).asc()).limit(max(CAPACITIES))
    walk = Window.orderBy(F.col(score).desc(), F.col(tie).asc()).rowsBetween(Window.unboundedPreceding, 0)
    running = best.select(
        F.row_number().over(Window.orderBy(F.col(score).desc(), F.col(tie).asc())).alias("k"),
        F.sum(score).over(walk).alias("total"),
    )
    sums = [
        F.coalesce(F.max(F.when(F.col("k") <= capacity, F.col("total"))), F.lit(0.0)).alias(f"s{capacity}")
        for capacity in CAPACITIES
    ]
    rows = F.count(F.lit(1)).alias("n")
    reached = running.agg(rows, *sums)
    fixed = [
        F.struct(
            F.lit(capacity).cast("long").alias("asked"),
            F.least(F.lit(capacity), F.col("n")).cast("long").alias("intervention_capacity"),
            (F.col(f"s{capacity}") * F.lit(efficacy)).alias("expected_preventable_readmissions"),
        )
        for capacity in CAPACITIES
    ]
    out = reached.select("n", F.inline(F.array(*fixed)))
    # The last capacity is min(1000, n): it repeats one of the others when n is 50, 100, 200 or 500.
    repeated = (F.col("asked") == max(CAPACITIES)) & F.col("n").isin(list(CAPACITIES[:-1]))
    return out.where(~repeated).select("intervention_capacity", "expected_preventable_readmissions")
