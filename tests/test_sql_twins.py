"""A part of the registered queries against their SQL twins; ``check.py`` runs them all."""

import duckdb
import pytest

import __spark_entry__ as entry
import check

NAMES = """silver_latest hospital_kpi department_kpi driver_summary executive_kpis lab_box_stats rate_by_segment
preventable_by_capacity stratified_split ranking_quality threshold_sweep retrieve_documents upsert_mart csv_source
quality_report""".split()


@pytest.fixture(scope="module")
def connection(sf):
    c = duckdb.connect()
    for table in check.TABLES:
        c.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_same_rows(spark, connection, sf, name):
    good, note = check.compare(spark, connection, name, sf)
    assert good, note


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
