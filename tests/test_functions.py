"""Literal rows for each rule that is easy to get wrong."""

import pytest
from pyspark.sql import functions as F

from visitmart.functions import bands as B
from visitmart.functions import numbers as N
from visitmart.functions import text as X
from visitmart.functions.risk import risk_score, risk_score_live


def one(spark, value, kind, build):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(build(df).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "text,expected",
    [(" 12 ", 12), ("12d", None), ("1e3", 1000), ("> 89", None), ("inf", None), ("45.0", 45), ("45.7", None),
     (None, None), ("", None), ("9007199254740993", 9007199254740993), ("nan", None)],
)
def test_whole_numbers(spark, text, expected):
    assert one(spark, text, "string", lambda df: N.to_int(df, "x")) == expected


@pytest.mark.parametrize("text,expected", [("45.7", 45.7), ("12d", None), (".5", 0.5), ("-1e2", -100.0), ("nan", None)])
def test_floats(spark, text, expected):
    assert one(spark, text, "string", lambda df: N.to_float(df, "x")) == expected


def test_nan_is_missing(spark):
    assert one(spark, float("nan"), "double", lambda df: N.to_float(df, "x")) is None
    assert one(spark, 7, "long", lambda df: N.to_float(df, "x")) == 7.0
    assert one(spark, 7.5, "double", lambda df: N.to_int(df, "x")) is None
    assert one(spark, 7, "long", lambda df: N.to_int(df, "absent")) is None


@pytest.mark.parametrize("value,expected", [(None, None), (-3, 0), (130, 115), (40, 40)])
def test_clip_keeps_missing(spark, value, expected):
    assert one(spark, value, "long", lambda df: N.clip(F.col("x"), 0, 115)) == expected


@pytest.mark.parametrize("value,expected", [(2.5, 2.0), (3.5, 4.0), (0.125, 0.12)])
def test_rounding_is_half_even(spark, value, expected):
    digits = 2 if value < 1 else 0
    assert one(spark, value, "double", lambda df: N.round_even(F.col("x"), digits)) == expected


def test_unit_interval(spark):
    assert one(spark, "abc", "string", lambda df: N.unit_interval("x", "u1")) == 0.38221713956031417


def test_record_hash_tokens(spark):
    import hashlib

    df = spark.createDataFrame([(" 7 ", None, "p")], "a string, b string, c string")
    got = df.select(N.record_hash(df, ["a", "b", "c", "gone"], {"a", "b"})).first()[0]
    assert got == hashlib.sha256(b"7|<NA>|p|").hexdigest()
    got = df.select(N.record_hash(df, ["a", "b"], {"a"})).first()[0]
    assert got == hashlib.sha256(b"7|None").hexdigest()


@pytest.mark.parametrize(
    "value,expected", [(" M ", "male"), ("FEMALE", "female"), (None, "unknown"), ("Unknown", "unknown"), ("f", "female")]
)
def test_gender(spark, value, expected):
    assert one(spark, value, "string", lambda df: X.normalize_gender("x")) == expected


@pytest.mark.parametrize("value,expected", [("09:15:30", "09:15:30"), ("24:61:00", None), ("", None), (None, None)])
def test_time(spark, value, expected):
    assert one(spark, value, "string", lambda df: X.sanitize_time("x")) == expected


@pytest.mark.parametrize("value,expected", [("31/1/2020", "2020-01-31"), ("2020-01-31", None), ("n/a", None), ("31/2/2020", None)])
def test_day_first(spark, value, expected):
    got = one(spark, value, "string", lambda df: X.parse_day_first("x"))
    assert (got and got.date().isoformat()) == expected


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Tokyo"])
def test_utc_date_ignores_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        value = "2024-01-02T23:30:00-05:00"
        assert one(spark, value, "string", lambda df: X.utc_date("x")) == "2024-01-03"
        assert one(spark, value, "string", lambda df: X.utc_wall_time("x")).hour == 4
        assert one(spark, "rubbish", "string", lambda df: X.utc_date("x")) is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    "value,expected",
    [("Caucasian", "White"), ("African American", "African American"), ("Asian", "Asian"), ("Native American", "Other"),
     (None, "Other"), ("Hispanic", "Hispanic")],
)
def test_ethnic_group(spark, value, expected):
    got = one(spark, value, "string", lambda df: F.expr(X.ethnic_group_sql("lower(coalesce(x, ''))")))
    assert got == expected


@pytest.mark.parametrize("value,expected", [(0.0, "low"), (0.35, "low"), (0.350001, "medium"), (0.7, "medium"), (1.0, "high")])
def test_risk_band(spark, value, expected):
    assert one(spark, value, "double", lambda df: B.cut("x", B.RISK_BANDS)) == expected


@pytest.mark.parametrize("value,expected", [(5.0, "0-5"), (5.5, "6-10"), (15.0, "11-15"), (15.5, "16+"), (26.0, None), (None, None)])
def test_lace_band(spark, value, expected):
    assert one(spark, value, "double", lambda df: B.cut("x", B.LACE_BANDS)) == expected


@pytest.mark.parametrize("value,expected", [(0.0, "0-30"), (30.0, "0-30"), (31.0, "31-45"), (120.0, "90+"), (121.0, None), (-1.0, None)])
def test_age_band(spark, value, expected):
    assert one(spark, value, "double", lambda df: B.cut("x", B.AGE_BANDS)) == expected


@pytest.mark.parametrize("value,expected", [(0.75, "Intensive Care Transition"), (0.5, "Enhanced Follow-up"),
                                            (0.3, "Standard Follow-up"), (0.29, "Routine Monitoring")])
def test_intervention(spark, value, expected):
    assert one(spark, value, "double", lambda df: B.intervention_bucket("x")) == expected


def test_risk_scores_take_missing_as_zero(spark):
    df = spark.createDataFrame([(None, 30.0, None)], "age_years long, los double, unitvisitnumber long")
    assert df.select(risk_score(df)).first()[0] == pytest.approx(0.2)
    assert df.select(risk_score_live(df)).first()[0] == pytest.approx(0.2)
