"""What the plans must look like for the work to stay spread over the cluster."""

import json
import re

import pytest
from pyspark.sql.types import StructType

import __spark_entry__ as entry
from visitmart.operators import cohort as C
from visitmart.operators.gold import assemble
from visitmart.operators.retrieval import term_counts, tokenize
from visitmart.plans import training_queries
from visitmart.plans import visits as V
from visitmart.sources import files


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_draws_are_computed_once(spark, sf):
    plan = optimized(V.doctor(spark, sf).select("record_hash", "risk_score", "glucose", "hemoglobin"))
    assert plan.count("sha2(") == 5


@pytest.mark.parametrize("name", ["hospital_kpi", "model_dataset", "reason_summary", "top_risk", "monthly_trend", "tfidf_weights"])
def test_no_python_in_plans(spark, sf, name):
    plan = physical(entry.queries()[name](spark, sf))
    assert not re.search("Python|Pandas|Cartesian|NestedLoop", plan)


def test_columns_are_pruned_and_filters_reach_the_scan(spark, sf):
    plan = physical(V.visits_raw(spark, sf).where("_o1 > 100").select("hospitalid"))
    lineitem = next(line for line in plan.splitlines() if "FileScan" in line and "l_orderkey" in line)
    assert "l_quantity" not in lineitem and "GreaterThan(l_partkey,100)" in lineitem


def test_dedup_ranks_before_the_shuffle(spark, sf):
    plan = physical(V.silver_latest(spark, sf))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Final") < plan.index("Exchange hashpartitioning(record_hash") < plan.index("Partial")


def test_numbers_are_typed_before_the_shuffle(spark, sf):
    def windows(node):
        found = [node] if node.nodeName() == "Window" else []
        return found + [w for i in range(node.children().size()) for w in windows(node.children().apply(i))]

    (window,) = windows(V.silver_latest(spark, sf)._jdf.queryExecution().sparkPlan())
    sent = StructType.fromJson(json.loads(window.children().apply(0).schema().json()))
    for name in ("patientunitstayid", "hospitaldischargeoffset", "admissionweight", "LACE_Score"):
        assert sent[name].dataType.typeName() in ("long", "double")


def test_assembly_of_stored_rows_reads_them(spark, sf):
    plan = physical(entry.queries()["assemble_silver"](spark, sf))
    assert "Window" not in plan and "lineitem" not in plan


def test_chunks_read_stored_visits(spark, sf):
    assert "lineitem" not in physical(entry.queries()["evidence_chunks"](spark, sf))


def test_visits_to_train_on_are_stored_as_parquet(spark, sf, monkeypatch):
    monkeypatch.setattr(type(spark.range(1)), "checkpoint", None)
    rows = training_queries._rows(spark, sf)
    assert rows.inputFiles() and all(name.endswith(".zstd.parquet") for name in rows.inputFiles())
    assert rows.count() == V.silver_latest(spark, sf).count()


def test_wide_silver_is_spooled_and_not_cached(spark, sf, tmp_path, monkeypatch):
    from visitmart.sources import sinks

    monkeypatch.setattr(type(spark.range(1)), "persist", None)
    wide = V.silver_latest(spark, sf)
    sinks.write_wide_silver(wide, f"{tmp_path}/silver", "2024-02-01")
    assert files.read_silver(spark, f"{tmp_path}/silver").count() == wide.count()
    assert not list((tmp_path / "silver_spool").iterdir())


def test_top_rows_are_taken_per_task_first(spark, sf):
    assert "TakeOrderedAndProject" in physical(C.top_risk(V.cohort(spark, sf)))


def test_assembly_shuffles_each_stored_table_once(spark, sf, tmp_path):
    from visitmart.operators.silver import split_silver
    from visitmart.sources import sinks

    sinks.write_silver(split_silver(V.silver_latest(spark, sf)), str(tmp_path), "2024-02-01")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical(assemble(files.read_silver_tables(spark, str(tmp_path)), ["processed_at_utc"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(record_hash") == 4


def test_terms_are_counted_without_a_shuffle_of_terms(spark, sf):
    counts = term_counts(tokenize(V.table(spark, sf, "documents"), "doc_id", "text", []), "doc_id")
    assert physical(counts).count("Exchange") == 1


def test_every_query_has_a_name_of_its_own_and_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 110
