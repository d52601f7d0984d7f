"""Visit rows derived from the star-schema tables, and the frames the queries start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitmart.operators.cohort import prepare
from visitmart.operators.final import model_dataset
from visitmart.operators.gold import doctor_mart
from visitmart.operators.silver import latest_silver, to_silver
from visitmart.session import tune, widen

PROCESSED_AT = "2024-02-01T00:00:00+00:00"
ORDER = ["_o1", "_o2", "_o3", "_o4"]

# One text for both engines; the table names are filled in.
VISITS_SQL = """
SELECT
  CAST(l_orderkey*10+l_linenumber AS STRING) AS patientunitstayid,
  CAST(o_orderkey AS STRING) AS patienthealthsystemstayid,
  CASE o_custkey%7 WHEN 0 THEN ' M ' WHEN 1 THEN NULL WHEN 2 THEN 'f' WHEN 3 THEN 'Unknown' WHEN 4 THEN 'Male'
    ELSE 'Female' END AS gender,
  CASE WHEN o_custkey%23=0 THEN '> 89' ELSE CAST(18+o_custkey%100 AS STRING) END AS age,
  CASE o_custkey%6 WHEN 0 THEN 'Caucasian' WHEN 1 THEN 'African American' WHEN 2 THEN 'Hispanic' WHEN 3 THEN 'Asian'
    WHEN 4 THEN 'Native American' ELSE NULL END AS ethnicity,
  CAST(60+o_custkey%31 AS STRING) AS hospitalid,
  CAST(80+l_linenumber AS STRING) AS wardid,
  CASE WHEN l_partkey%8=0 THEN '' ELSE p_name END AS apacheadmissiondx,
  CASE WHEN l_partkey%20=0 THEN '' ELSE CAST(145+l_partkey%50 AS STRING) END AS admissionheight,
  CASE WHEN l_partkey%7=0 THEN NULL ELSE CAST(45+l_partkey%95 AS STRING) END AS admissionweight,
  CASE WHEN l_suppkey%11=0 THEN '24:61:00' ELSE '0'||CAST(l_suppkey%10 AS STRING)||':15:30' END AS hospitaladmittime24,
  CASE WHEN l_suppkey%9=0 THEN NULL ELSE CAST((l_partkey*7)%12000 AS STRING) END AS hospitaldischargeoffset,
  CASE WHEN l_returnflag='R' THEN ' Expired ' ELSE 'Alive' END AS hospitaldischargestatus,
  CASE WHEN l_linestatus='O' THEN 'Alive' ELSE NULL END AS unitdischargestatus,
  CASE WHEN p_size<4 THEN NULL ELSE p_type END AS unittype,
  CAST(1+l_linenumber%3 AS STRING) AS unitvisitnumber,
  CAST(l_partkey%5000 AS STRING) AS unitdischargeoffset,
  '002-'||CAST(o_custkey AS STRING) AS uniquepid,
  CASE WHEN l_suppkey%13=0 THEN 'n/a' ELSE CAST(day(o_orderdate) AS STRING)||'/'||CAST(month(o_orderdate) AS STRING)
    ||'/'||CAST(year(o_orderdate) AS STRING) END AS admit_day,
  CASE WHEN l_linenumber=1 THEN NULL ELSE CAST(CAST(l_quantity AS BIGINT)%33 AS STRING) END AS los,
  CASE WHEN l_linenumber=2 THEN NULL ELSE CAST(CAST(l_quantity AS BIGINT)%28 AS STRING) END AS LACE_Score,
  CASE WHEN l_linenumber=3 THEN NULL ELSE CAST(l_partkey%16 AS STRING) END AS chronic_conditions,
  CASE WHEN l_returnflag='N' THEN NULL WHEN l_returnflag='R' THEN '1' ELSE '0' END AS readmitted,
  CASE WHEN p_size%10=0 THEN '' ELSE p_brand END AS Condition,
  '2024-01-0'||CAST(1+o_orderkey%7 AS STRING)||'T00:00:00+00:00' AS _airbyte_emitted_at,
  l_partkey AS _o1, l_suppkey AS _o2, l_extendedprice AS _o3, l_shipdate AS _o4
FROM {lineitem} JOIN {orders} ON l_orderkey=o_orderkey JOIN {part} ON l_partkey=p_partkey
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def visits_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return spark.sql(
        VISITS_SQL,
        lineitem=widen(table(spark, sf_dir, "lineitem"), "l_orderkey"),
        orders=table(spark, sf_dir, "orders"),
        part=table(spark, sf_dir, "part"),
    )


def silver_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every visit row, cleaned and completed."""
    return to_silver(visits_raw(spark, sf_dir), PROCESSED_AT)


def silver_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per record hash."""
    return latest_silver(visits_raw(spark, sf_dir), PROCESSED_AT, ORDER)


def doctor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doctor_mart(silver_latest(spark, sf_dir))


def model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model_dataset(silver_latest(spark, sf_dir))


def cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model dataset with admission day and hash, prepared for the cohort aggregates."""
    dataset = model_dataset(silver_latest(spark, sf_dir), extra=("admit_day", "record_hash"))
    return prepare(dataset, has_admit_day=True)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hash, label and live risk score per visit: the input of the evaluation operators."""
    return cohort(spark, sf_dir).select(
        "record_hash", F.col("readmitted_under_30_days").alias("label"), F.col("risk_score_live").alias("score")
    )
