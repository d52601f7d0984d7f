"""From raw visit rows to the typed, completed Silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitmart import schema as S
from visitmart.functions import text as X
from visitmart.functions.numbers import record_hash, round_even_sql, to_float, to_int, unit_interval
from visitmart.operators.shape import dedup_last, pick
from visitmart.session import stored


def with_record_hash(df: DataFrame) -> DataFrame:
    """Add the record hash; ids count after their coercion to whole numbers."""
    return df.withColumn("record_hash", record_hash(df, S.HASH_FIELDS, set(S.INT_COLUMNS)))


def clean(df: DataFrame, processed_at: str) -> DataFrame:
    """Type and normalise every known column and add the record hash. Fills nothing in."""
    missing = [name for name in S.REQUIRED_SOURCE if name not in df.columns]
    if missing:
        raise ValueError(f"required columns are missing: {missing}")
    if "record_hash" not in df.columns:
        df = with_record_hash(df)
    present = set(df.columns)

    typed = {
        "gender_normalized": X.normalize_gender("gender"),
        "age_years": to_int(df, "age"),
        "hospital_discharge_status_normalized": X.normalize_text("hospitaldischargestatus"),
        "unit_discharge_status_normalized": X.normalize_text("unitdischargestatus"),
        "processed_at_utc": F.lit(processed_at),
    }
    typed.update({name: to_int(df, name) for name in S.INT_COLUMNS if name in present})
    typed.update({name: to_float(df, name) for name in S.FLOAT_COLUMNS if name in present})
    typed.update({name: X.sanitize_time(name) for name in S.TIME_COLUMNS if name in present})
    typed.update({name: X.parse_day_first(name) for name in S.DATE_COLUMNS if name in present})
    if "_airbyte_emitted_at" in present:
        typed["silver_processed_date"] = X.utc_date("_airbyte_emitted_at")
    else:
        typed["silver_processed_date"] = F.lit(processed_at[:10])

    # A second stage, so that the parsed numbers are named and not parsed again.
    return df.withColumns(typed).withColumns(
        {
            "age_years": F.expr("CASE WHEN age_years IS NOT NULL THEN greatest(0, least(115, age_years)) END"),
            "is_expired": F.expr("hospital_discharge_status_normalized = 'expired'"),
            "estimated_unit_los_hours": F.expr("coalesce(unitdischargeoffset, 0) / 60D"),
        }
    )


# The rule that gives each condition flag when the source has none.
FLAG_RULES = {
    "diabetes": "_u1 < 0.23D",
    "obesity": "_u2 < 0.28D",
    "anxiety": "_u3 < 0.20D",
    "depression": "_u4 < 0.18D",
    "dementia": "_age >= 70 AND _u1 < 0.22D",
    "drugabuse": "_u2 < 0.12D",
    "mooddisorder": "_u3 < 0.15D",
    "tobacco_user": "_u4 < 0.27D",
}

# Level of each vital sign, and the digits it is rounded to.
VITAL_RULES = {
    "bp_systolic": ("108D + _u1 * 42D", 0),
    "bp_diastolic": ("62D + _u2 * 28D", 0),
    "pulse": ("58D + _u3 * 52D", 0),
    "respirations": ("12D + _u4 * 14D", 0),
    "temperature": ("36.1D + _u1 * 2.1D", 1),
}

# Level of each lab value and cost, and the digits it is rounded to.
LAB_AND_COST_RULES = {
    "glucose": ("90D + CAST(chronic_conditions AS DOUBLE) * 6D + _u1 * 35D", 1),
    "creatinine": ("0.7D + CAST(chronic_conditions AS DOUBLE) * 0.08D + _u2 * 0.7D", 2),
    "wbc": ("4.2D + _u3 * 9.8D", 2),
    "hemoglobin": ("10.5D + _u4 * 5.5D", 2),
    "potassium": ("3.4D + _u1 * 1.8D", 2),
    "sodium": ("133D + _u2 * 12D", 1),
    "calcium": ("8.2D + _u3 * 2.1D", 2),
    "cost_of_initial_stay": (
        "3500D + los * 1200D + CAST(chronic_conditions AS DOUBLE) * 420D + _u4 * 900D",
        2,
    ),
    "care_plan_costs": ("180D + CAST(chronic_conditions AS DOUBLE) * 95D + _u3 * 220D", 2),
}

# The rules for insurance, care plan, stay, risk index, chance of return and body mass.
INSURANCE = """CASE WHEN _u1 < 0.03D THEN 'Self-pay' WHEN _age < 30 AND _u1 < 0.4D THEN 'Medicaid'
    WHEN _age >= 65 THEN 'Medicare' ELSE 'Commercial' END"""

CARE_PLAN = """CASE WHEN _u2 < 0.15D THEN 'Home health + chronic disease management'
    WHEN _u2 < 0.35D THEN 'Medication reconciliation and PCP follow-up' ELSE 'Standard follow-up in 7 days' END"""

STAY = """CASE WHEN {offset} IS NOT NULL
    THEN rint(greatest(0.5D, least(21D, {offset} / 1440D)) * 100D) / 100D
    ELSE rint((1.5D + _u1 * 5.5D) * 100D) / 100D END"""

LACE = """greatest(0D, least(19D, rint(greatest(0D, least(14D, los)) * 0.7D + CAST(ed_visits AS DOUBLE) * 1.2D
    + CAST(chronic_conditions AS DOUBLE) * 1.4D + CAST(_senior AS DOUBLE) * 2D + _u3 * 2D)))"""

RETURN_CHANCE = "least(0.65D, 0.08D + LACE_Score / 40D + CAST(chronic_conditions AS DOUBLE) / 25D)"

BMI = "rint({weight} / ((nullif({height}, 0D) / 100D) * (nullif({height}, 0D) / 100D)) * 10D) / 10D"


def enrich(df: DataFrame) -> DataFrame:
    """Fill missing model features of cleaned rows from repeatable numbers drawn from the record hash.

    Each ``withColumns`` is one stage of dependence: the numbers; what follows
    from them; what needs stay and conditions; the outcome; its delay; its flag.
    """
    present = set(df.columns)

    def kept(name: str, rule: str, kind: str) -> str:
        """The value already there, else what the rule gives."""
        filled = f"CAST({rule} AS {kind})"
        return f"coalesce(`{name}`, {filled})" if name in present else filled

    def source(name: str, kind: str) -> str:
        return f"`{name}`" if name in present else f"CAST(NULL AS {kind})"

    draws = {f"_u{i}": unit_interval("record_hash", f"u{i}") for i in (1, 2, 3, 4)}
    age = f"coalesce({source('age_years', 'BIGINT')}, 0)"
    numbers = df.withColumns(
        {**draws, "_age": F.expr(age), "_senior": F.expr(f"CAST({age} >= 65 AS BIGINT)")}
    )

    ethnicity = f"lower(coalesce({source('ethnicity', 'STRING')}, ''))"
    diagnosis = f"nullif(trim(coalesce({source('apacheadmissiondx', 'STRING')}, '')), '')"
    bmi = BMI.format(weight=source("admissionweight", "DOUBLE"), height=source("admissionheight", "DOUBLE"))
    first = {
        "ethnic_group_c": kept("ethnic_group_c", X.ethnic_group_sql(ethnicity), "STRING"),
        "insurance_provider": kept("insurance_provider", INSURANCE, "STRING"),
        "Condition": kept("Condition", f"coalesce({diagnosis}, 'General Medical')", "STRING"),
        "care_plan_following_discharge": kept("care_plan_following_discharge", CARE_PLAN, "STRING"),
        "los": kept("los", STAY.format(offset=source("hospitaldischargeoffset", "BIGINT")), "DOUBLE"),
        "chronic_conditions": kept(
            "chronic_conditions", "greatest(0, least(8, CAST(rint(_u2 * 5D) AS BIGINT) + _senior))", "BIGINT"
        ),
        "ed_visits": kept("ed_visits", "rint(_u1 * 4D)", "BIGINT"),
        "ip_visits": kept("ip_visits", "rint(_u2 * 3D)", "BIGINT"),
        "bmi": kept("bmi", f"coalesce({bmi}, rint((20D + _u2 * 15D) * 10D) / 10D)", "DOUBLE"),
    }
    first.update({name: kept(name, rule, "BIGINT") for name, rule in FLAG_RULES.items()})
    first.update(
        {name: kept(name, round_even_sql(rule, digits), "DOUBLE") for name, (rule, digits) in VITAL_RULES.items()}
    )
    second = {"LACE_Score": kept("LACE_Score", LACE, "DOUBLE")}
    second.update(
        {name: kept(name, round_even_sql(rule, n), "DOUBLE") for name, (rule, n) in LAB_AND_COST_RULES.items()}
    )
    third = {"readmitted": kept("readmitted", f"_u4 < {RETURN_CHANCE}", "BIGINT")}
    delay = "CASE WHEN readmitted = 1 THEN 1D + rint(_u1 * 59D) ELSE 0D END"
    fourth = {"days_until_readmission": kept("days_until_readmission", delay, "DOUBLE")}
    fifth = {S.TARGET: kept(S.TARGET, "readmitted = 1 AND days_until_readmission <= 30", "BIGINT")}

    out = numbers
    for stage in (first, second, third, fourth, fifth):
        out = out.withColumns({name: F.expr(rule) for name, rule in stage.items()})
    return out.drop(*draws, "_age", "_senior")


def to_silver(df: DataFrame, processed_at: str) -> DataFrame:
    """Clean, then complete: one wide row per source row."""
    return enrich(clean(df, processed_at))


def with_numbers(df: DataFrame, kept: list[str]) -> DataFrame:
    """Number columns as ``clean`` types them, but for those in ``kept``. Typing a typed column again changes nothing."""
    present = set(df.columns) - set(kept)
    typed = {name: to_int(df, name) for name in S.INT_COLUMNS if name in present}
    return df.withColumns(typed | {name: to_float(df, name) for name in S.FLOAT_COLUMNS if name in present})


def latest_silver(df: DataFrame, processed_at: str, order: list[str]) -> DataFrame:
    """One wide Silver row per record hash, the last by ``order``.

    The same rows as ``to_silver`` followed by ``dedup_last``. Only the hash is needed to
    find them; cleaning and filling in look at one row each, so they run after the
    shuffle, on the rows that stay. Numbers are typed before it, since they take less room than their texts.
    """
    narrow = with_record_hash(with_numbers(df, order))
    return to_silver(dedup_last(narrow, ["record_hash"], order), processed_at)


def split_silver(
    df: DataFrame, order: list[str] | None = None, carried: list[str] | None = None, once: bool = False
) -> dict[str, DataFrame]:
    """The four tables of the wide frame. With ``order`` each keeps one row per record hash.

    The winner of a hash is the same row in all four, so the wide frame is
    deduplicated, not each table. ``carried`` columns go into all four, so that a later
    choice between stored rows of one hash is the same in each. With ``once`` the wide frame is worked out and
    stored now, for callers that read several of the tables.
    """
    wide = df if order is None else dedup_last(df, ["record_hash"], order)
    if once:
        wide = stored(pick(wide, [c for columns in [*S.SILVER_TABLES.values(), carried or []] for c in columns]))
    return {
        table: pick(wide, [*columns, *[c for c in carried or [] if c not in columns]])
        for table, columns in S.SILVER_TABLES.items()
    }
