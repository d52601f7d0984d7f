"""Queries that write derived visits to the shared folder and read them back, in batch and incrementally."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from visitmart import schema as S
from visitmart.operators.evaluation import classification_metrics
from visitmart.operators.gold import doctor_mart, hospital_kpi
from visitmart.operators.quality import quality_report
from visitmart.plans import gold_queries, model_queries, silver_queries  # noqa: F401  (their SQL is used again here)
from visitmart.plans import oracle as O
from visitmart.plans import visits as V
from visitmart.plans.registry import SQL, query, rounded
from visitmart.session import shared_dir, tune
from visitmart.sources import files, sinks
from visitmart.streaming import incremental as I

_FIRST, _SECOND = "2024-03-01T06:00:00+00:00", "2024-03-02T07:00:00+00:00"


def _fresh(spark) -> str:
    """A new folder per run below the shared one."""
    return f"{shared_dir(spark).rstrip('/')}/run-{uuid.uuid4().hex}"


def _source_csv(frame, path: str, extra: tuple[str, ...] = ()) -> None:
    """Append to a folder of source CSV files."""
    sinks.write_csv(I.complete_source(frame, extra), path, "append")


_TEXT = "patientunitstayid gender age apacheadmissiondx admissionheight unittype admit_day Condition uniquepid".split()
_BLANKED = ", ".join(f"CASE WHEN {c} NOT IN ('', 'n/a') THEN {c} END AS {c}" for c in _TEXT)

_BASE_TEXT = [c for c in _TEXT if c in S.SOURCE_COLUMNS]
_BASE_BLANKED = ", ".join(f"CASE WHEN {c} NOT IN ('', 'n/a') THEN {c} END AS {c}" for c in _BASE_TEXT)


@query("csv_source", f"WITH {O.RAW} SELECT {_BLANKED}, NULL::VARCHAR AS glucose FROM raw")
def csv_source(spark, sf_dir):
    path = _fresh(spark)
    _source_csv(V.visits_raw(spark, sf_dir), path)
    return files.read_visits_csv(spark, path).select(*_TEXT, "glucose")


@query("optional_source", f"WITH {O.RAW} SELECT {', '.join(f'{c}::VARCHAR AS {c}' for c in _TEXT)} FROM raw")
def optional_source(spark, sf_dir):
    """A stored table followed by one that was never written: the latter has the schema and no rows."""
    path = _fresh(spark)
    stored = V.visits_raw(spark, sf_dir).select([F.col(c).cast("string").alias(c) for c in _TEXT])
    stored.write.parquet(f"{path}/there")
    there, absent = (files.read_or_empty(spark, f"{path}/{name}", stored.schema) for name in ("there", "absent"))
    return there.unionByName(absent)


@query(
    "raw_envelope",
    f"WITH {O.RAW} SELECT '{_FIRST}' AS _airbyte_emitted_at, 'ehr_visits' AS _airbyte_stream, patientunitstayid, "
    "uniquepid AS json_uniquepid, gender AS json_gender, true AS has_id FROM raw",
)
def raw_envelope(spark, sf_dir):
    raw = V.visits_raw(spark, sf_dir).drop("_airbyte_emitted_at", *V.ORDER)
    return sinks.to_raw_envelope(raw, "ehr_visits", _FIRST).select(
        "_airbyte_emitted_at",
        "_airbyte_stream",
        "patientunitstayid",
        F.get_json_object("_airbyte_data", "$.uniquepid").alias("json_uniquepid"),
        F.get_json_object("_airbyte_data", "$.gender").alias("json_gender"),
        (F.length("_airbyte_ab_id") == 36).alias("has_id"),
    )


@query(
    "bronze_partitions",
    f"WITH {O.RAW} SELECT '2024-03-01' AS load_date, '06' AS load_hour, count(*) AS rows, true AS files_within_limit FROM raw",
)
def bronze_partitions(spark, sf_dir):
    path = _fresh(spark)
    raw = V.visits_raw(spark, sf_dir).drop("_airbyte_emitted_at", *V.ORDER)
    sinks.write_bronze(sinks.to_raw_envelope(raw, "ehr_visits", _FIRST), path, _FIRST, 5000)
    stored = spark.read.option("basePath", path).parquet(path)
    per_file = stored.select(
        F.date_format("load_date", "yyyy-MM-dd").alias("load_date"),
        F.lpad(F.col("load_hour").cast("string"), 2, "0").alias("load_hour"),
        F.input_file_name().alias("file"),
    )
    per_file = per_file.groupBy("load_date", "load_hour", "file").agg(F.count(F.lit(1)).alias("n"))
    return per_file.groupBy("load_date", "load_hour").agg(
        F.sum("n").alias("rows"), (F.max("n") <= 5000).alias("files_within_limit")
    )


@query(
    "silver_round_trip",
    f"{O.SILVER} SELECT * EXCLUDE (_o1,_o2,_o3,_o4,hospitaladmittime24,hospitaldischargestatus,unitdischargestatus) FROM silver",
)
def silver_round_trip(spark, sf_dir):
    path = _fresh(spark)
    sinks.write_wide_silver(V.silver_latest(spark, sf_dir), path, "2024-02-01")
    return files.read_silver(spark, path)


@query("silver_legacy", f"{O.SILVER} SELECT record_hash, los, unittype FROM silver")
def silver_legacy(spark, sf_dir):
    path = _fresh(spark)
    V.silver_latest(spark, sf_dir).write.parquet(f"{path}/process_date=2024-02-01")
    return files.read_silver(spark, path).select("record_hash", "los", "unittype")


@query(
    "silver_files",
    f"{O.SILVER} SELECT t AS table_name, count(*) AS rows FROM silver, "
    "(SELECT unnest(['visits_core','diagnosis_care','utilization_outcomes','clinical_features']) AS t) GROUP BY t",
)
def silver_files(spark, sf_dir):
    path = _fresh(spark)
    sinks.write_wide_silver(V.silver_latest(spark, sf_dir), path, "2024-02-01", batch=0)
    name = files.table_from_path(F.input_file_name(), path, list(S.SILVER_TABLES))
    rows = files.read_table(spark, path).select(name.alias("table_name"))
    known = files.silver_files(spark, path).select("table_name").distinct()
    return rows.join(known, "table_name", "left_semi").groupBy("table_name").agg(F.count(F.lit(1)).alias("rows"))


@query("mart_versions", f"{O.DOCTOR} SELECT record_hash, risk_band FROM doctor WHERE is_expired")
def mart_versions(spark, sf_dir):
    path = _fresh(spark)
    sinks.write_mart(V.doctor(spark, sf_dir).select("record_hash", "risk_band", "is_expired"), path)
    second = sinks.read_mart(spark, path).where("is_expired").drop("is_expired")
    sinks.write_mart(second, path)
    return sinks.read_mart(spark, path)


@query(
    "report_round_trip",
    f"{O.SILVER_ROWS} SELECT count(*) AS total_rows, sum(is_expired::BIGINT)::BIGINT AS expired_count, "
    "count(*) FILTER (unittype IS NULL) AS null_units FROM silver",
)
def report_round_trip(spark, sf_dir):
    path = _fresh(spark)
    sinks.write_report(quality_report(V.silver_rows(spark, sf_dir), ["unittype"]), path)
    stored = spark.read.json(path)
    return stored.selectExpr(
        "total_rows", "expired_count", "required_column_null_counts.unittype AS null_units"
    )


@query("metrics_round_trip", SQL["classification_metrics"])
def metrics_round_trip(spark, sf_dir):
    path = _fresh(spark)
    metrics = classification_metrics(V.scored(spark, sf_dir), 0.45)
    counts = ["tn", "fp", "fn", "tp"]
    nested = F.struct(*[c for c in metrics.columns if c not in counts], F.struct(*counts).alias("confusion_matrix"))
    sinks.write_report(metrics.select(nested.alias("metrics")), path)
    return rounded(files.read_metrics(spark, path).select(metrics.columns))


@query(
    "final_csv",
    f"{O.MODEL} SELECT patientunitstayid::VARCHAR AS patientunitstayid, unittype, readmitted::VARCHAR AS readmitted FROM model",
)
def final_csv(spark, sf_dir):
    path = _fresh(spark)
    sinks.write_csv(V.model(spark, sf_dir), path)
    return spark.read.option("header", True).csv(path).select("patientunitstayid", "unittype", "readmitted")


def _two_runs(spark, sf_dir) -> I.Layout:
    """Two source files, each followed by a run of the incremental stages."""
    tune(spark)
    root = _fresh(spark)
    raw = V.visits_raw(spark, sf_dir)
    layout = None
    for now, rows in (
        (_FIRST, raw.where("_airbyte_emitted_at < '2024-01-04'")),
        (_SECOND, raw.where("_airbyte_emitted_at >= '2024-01-04'")),
    ):
        layout = I.Layout(f"{root}/source", root, now)
        _source_csv(rows, layout.source)
        I.sync_new_files(spark, layout)
        I.bronze_to_silver(spark, layout)
        I.silver_to_gold(spark, layout)
    return layout


_RUNS = f"""WITH {O.RAW}, runs AS (SELECT *, CASE WHEN _airbyte_emitted_at < '2024-01-04' THEN '2024-03-01' ELSE '2024-03-02' END
    AS as_of_date FROM raw), kept AS (SELECT DISTINCT as_of_date, patientunitstayid, patienthealthsystemstayid, hospitalid,
    wardid, uniquepid FROM runs)"""


@query(
    "incremental_marts",
    f"{_RUNS} SELECT as_of_date, hospitalid::BIGINT AS hospitalid, count(*) AS total_visits, "
    "count(DISTINCT uniquepid) AS unique_patients FROM kept GROUP BY 1, 2",
)
def incremental_marts(spark, sf_dir):
    layout = _two_runs(spark, sf_dir)
    marts = sinks.read_mart(spark, layout.mart("hospital_kpi"))
    return marts.select("as_of_date", "hospitalid", "total_visits", "unique_patients")


#: The row order of the derived visits as one text, which a CSV file can carry.
_ROW_NO = (
    "lpad(CAST(_o1 AS STRING), 12, '0') || lpad(CAST(_o2 AS STRING), 12, '0') || "
    "lpad(CAST(CAST(round(_o3 * 100) AS BIGINT) AS STRING), 15, '0') || CAST(_o4 AS STRING)"
)


def _overlapping_runs(spark, sf_dir) -> I.Layout:
    """Two syncs at one time of emission, so the second replaces visits of the first; Gold follows each."""
    tune(spark)
    root = _fresh(spark)
    raw = V.visits_raw(spark, sf_dir).withColumn("row_no", F.expr(_ROW_NO))
    layout = I.Layout(f"{root}/source", root, _FIRST, order=("_airbyte_emitted_at", "row_no"), extra=("row_no",))
    for part in ("_o1 % 3 < 2", "_o1 % 3 > 0"):
        _source_csv(raw.where(part), layout.source, ("row_no",))
        I.sync_new_files(spark, layout)
        I.bronze_to_silver(spark, layout)
        I.silver_to_gold(spark, layout)
    return layout


_BLANK = "gender apacheadmissiondx admissionheight unittype admit_day Condition".split()


def _one_sync(sql: str) -> str:
    """``sql`` over all rows synced at ``_FIRST`` from CSV files, where empty texts are missing."""
    blanked = ", ".join(f"CASE WHEN {c} NOT IN ('', 'n/a') THEN {c} END AS {c}" for c in _BLANK)
    synced = f"raw AS (SELECT * REPLACE ({blanked}, '{_FIRST}' AS _airbyte_emitted_at) FROM derived)"
    sql = sql.replace(O.RAW, O.RAW.replace("raw AS (", "derived AS (", 1) + ", " + synced)
    return sql.replace("2024-02-01T00:00:00+00:00", _FIRST).replace("'2024-02-01' AS as_of_date", "'2024-03-01' AS as_of_date")


_ONE_SYNC = _one_sync(O.DOCTOR)


@query("incremental_doctor_mart", f"{_ONE_SYNC} SELECT * FROM doctor")
def incremental_doctor_mart(spark, sf_dir):
    """The visit mart after two runs that share visits, by buckets, against one over all rows."""
    return sinks.read_mart(spark, _overlapping_runs(spark, sf_dir).mart("doctor"))


#: Stays have two decimals at most; added up as decimals, both sides round the same number.
_MEAN_STAY = "(sum(los::DECIMAL(18,2))::DOUBLE / nullif(count(los), 0))"


@query("incremental_hospital_kpi", SQL["hospital_kpi"].replace(O.DOCTOR, _ONE_SYNC).replace("avg(los)", _MEAN_STAY))
def incremental_hospital_kpi(spark, sf_dir):
    """Stored sums from which replaced visits were taken out, against sums over the final visits."""
    return rounded(sinks.read_mart(spark, _overlapping_runs(spark, sf_dir).mart("hospital_kpi")))


@query("incremental_department_kpi", SQL["department_kpi"].replace(O.DOCTOR, _ONE_SYNC).replace("avg(los)", _MEAN_STAY))
def incremental_department_kpi(spark, sf_dir):
    return rounded(sinks.read_mart(spark, _overlapping_runs(spark, sf_dir).mart("department_kpi")))


_QUALITY_SYNC = SQL["quality_report"].replace(O.SILVER_ROWS, _one_sync(O.SILVER_ROWS))


@query(
    "quality_report_incremental",
    f"SELECT *, '{_FIRST}' AS generated_at_utc, true AS names_files FROM ({_QUALITY_SYNC})",
)
def quality_report_incremental(spark, sf_dir):
    """One report over a run of several batches of a file each, which share visit ids."""
    tune(spark)
    root = _fresh(spark)
    layout = I.Layout(f"{root}/source", root, _FIRST, max_rows=1_000_000, max_files=1)
    _source_csv(V.visits_raw(spark, sf_dir).repartition(3), layout.source)
    I.sync_new_files(spark, layout)
    bronze = spark.read.option("recursiveFileLookup", True).parquet(layout.bronze).inputFiles()
    I.bronze_to_silver(spark, layout)
    report = spark.read.json(f"{layout.quality}/run={_FIRST.replace(':', '.')}")
    # the map comes back as a struct of the required columns
    counts = F.explode(F.from_json(F.to_json("required_column_null_counts"), "map<string, bigint>"))
    kept = [c for c in report.columns if c not in ("required_column_null_counts", "input_files")]
    return report.select(*kept, (F.size("input_files") == len(bronze)).alias("names_files"), counts.alias("column_name", "null_count"))


@query(
    "incremental_rows",
    f"WITH {O.RAW}, runs AS (SELECT CASE WHEN _o1 <= 60 THEN '{_FIRST}' ELSE '{_SECOND}' END AS _airbyte_emitted_at FROM raw) "
    "SELECT _airbyte_emitted_at, count(*) AS rows FROM runs GROUP BY 1",
)
def incremental_rows(spark, sf_dir):
    root = _fresh(spark)
    raw = V.visits_raw(spark, sf_dir)
    for now, rows in ((_FIRST, raw.where("_o1 <= 60")), (_SECOND, raw)):
        source = f"{root}/source-{now[:10]}"
        _source_csv(rows, source, ("_o1",))
        I.sync_rows_after(spark, I.Layout(source, root, now), "_o1")
    stored = files.read_table(spark, I.Layout("", root, _SECOND).bronze)
    return stored.groupBy("_airbyte_emitted_at").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "incremental_row_offsets",
    f"WITH {O.RAW} SELECT CASE WHEN _o1 <= 60 THEN '{_FIRST}' ELSE '{_SECOND}' END AS _airbyte_emitted_at, patientunitstayid, "
    "uniquepid, row_number() OVER (ORDER BY _o1 > 60, _o1, patientunitstayid, uniquepid) AS source_row FROM raw",
)
def incremental_row_offsets(spark, sf_dir):
    """Two syncs of one growing file without an order column: rows keep the place they have in the file."""
    root = _fresh(spark)
    raw = V.visits_raw(spark, sf_dir)
    for now, rows in ((_FIRST, raw.where("_o1 <= 60")), (_SECOND, raw)):
        source = f"{root}/source-{now[:10]}"
        # The file is written in parts that follow each other, so that no task writes all of it.
        _source_csv(rows.orderBy(F.col("_o1") > 60, "_o1", "patientunitstayid", "uniquepid"), source)
        I.sync_row_offsets(spark, I.Layout(source, root, now, max_rows=1_000_000), parts=True)
    stored = files.read_table(spark, I.Layout("", root, _SECOND).bronze)
    return stored.select(
        "_airbyte_emitted_at", "patientunitstayid", "uniquepid", F.col(I.SOURCE_ROW).alias("source_row")
    )


@query(
    "stage_counts",
    f"""WITH {O.RAW}, kept AS (SELECT DISTINCT patientunitstayid, patienthealthsystemstayid, hospitalid, wardid, uniquepid FROM raw)
    SELECT 'bronze' AS stage, count(*) AS rows FROM raw UNION ALL SELECT 'silver', count(*) FROM kept
    UNION ALL SELECT 'gold', count(*) FROM kept UNION ALL SELECT 'final', count(*) FROM kept""",
)
def stage_counts(spark, sf_dir):
    tune(spark)
    root = _fresh(spark)
    layout = I.Layout(f"{root}/source", root, _FIRST)
    _source_csv(V.visits_raw(spark, sf_dir), layout.source)
    counts = I.run_all(spark, layout)
    return spark.createDataFrame(list(counts.items()), "stage string, rows long")


def _two_headers(frame, path: str) -> None:
    """Source files with the base columns only: those of even visits in contract order, the others' reversed."""
    base = frame.select([F.col(c).cast("string").alias(c) for c in S.SOURCE_COLUMNS])
    even = F.col("patientunitstayid").cast("long") % 2 == 0
    sinks.write_csv(base.where(even), path, "append")
    sinks.write_csv(base.where(~even).select(base.columns[::-1]), path, "append")


@query(
    "incremental_small_batches",
    f"""WITH {O.RAW}, kept AS (SELECT DISTINCT patientunitstayid, patienthealthsystemstayid, hospitalid, wardid, uniquepid FROM raw)
    SELECT count(*) AS visits, 0::BIGINT AS different FROM kept""",
)
def incremental_small_batches(spark, sf_dir):
    """The visit mart after batches of one file each, and its rows that one batch of all files gives otherwise."""
    tune(spark)
    root = _fresh(spark)
    source = f"{root}/source"
    _source_csv(V.visits_raw(spark, sf_dir).repartition(3), source)
    marts = []
    for name, most in (("whole", 1000), ("steps", 1)):
        layout = I.Layout(source, f"{root}/{name}", _FIRST, max_files=most)
        I.sync_new_files(spark, layout)
        I.bronze_to_silver(spark, layout)
        I.silver_to_gold(spark, layout)
        marts.append(sinks.read_mart(spark, layout.mart("doctor")))
    different = marts[0].exceptAll(marts[1]).union(marts[1].exceptAll(marts[0])).count()
    return marts[1].agg(F.count(F.lit(1)).alias("visits"), F.lit(different).cast("long").alias("different"))


@query("csv_mixed_headers", f"WITH {O.RAW} SELECT {_BASE_BLANKED}, NULL::VARCHAR AS los FROM raw")
def csv_mixed_headers(spark, sf_dir):
    path = _fresh(spark)
    _two_headers(I.complete_source(V.visits_raw(spark, sf_dir)), path)
    return files.read_visits_csv(spark, path).select(*_BASE_TEXT, "los")


@query("ingest_base_columns", SQL["stage_counts"])
def ingest_base_columns(spark, sf_dir):
    """All stages on files without the optional columns and with two different headers."""
    tune(spark)
    root = _fresh(spark)
    layout = I.Layout(f"{root}/source", root, _FIRST)
    _two_headers(I.complete_source(V.visits_raw(spark, sf_dir)), layout.source)
    counts = I.run_all(spark, layout)
    return spark.createDataFrame(list(counts.items()), "stage string, rows long")


@query("stored_hospital_kpi", SQL["hospital_kpi"])
def stored_hospital_kpi(spark, sf_dir):
    """The KPI mart from Silver as stored, which is how it runs at scale."""
    path = _fresh(spark)
    sinks.write_wide_silver(V.silver_latest(spark, sf_dir), path, "2024-02-01")
    return rounded(hospital_kpi(doctor_mart(files.read_silver(spark, path))))
