"""Sources, sinks and restarts of the incremental runs."""

import pytest
from pyspark.sql import functions as F

from visitmart import schema as S
from visitmart.sources import files, paths, sinks
from visitmart.streaming import incremental as I

from test_operators import frame, visit

DAY1, DAY2 = "2024-03-01T06:00:00+00:00", "2024-03-02T07:00:00+00:00"


def put(spark, folder, *visits, extra=()):
    df = I.complete_source(frame(spark, *visits).drop("_airbyte_emitted_at"), extra)
    sinks.write_csv(df.coalesce(1), folder, "append")


def test_missing_source_and_optional_inputs(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_visits_csv(spark, str(tmp_path / "none.csv"))
    empty = files.read_or_empty(spark, str(tmp_path / "none"), S.silver_schema("visits_core"))
    assert (empty.count(), len(empty.columns)) == (0, len(S.SILVER_TABLES["visits_core"]))
    assert files.read_metrics(spark, str(tmp_path / "none")) is None
    assert files.read_silver(spark, str(tmp_path / "none")) is None


def test_csv_source_reads_quotes_and_missing_texts(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text('age,apacheadmissiondx,gender\n70,"Renal failure, ""acute""",NaN\n> 89,,n/a\n')
    got = files.read_visits_csv(spark, str(path)).select("age", "apacheadmissiondx", "gender", "los").collect()
    assert [tuple(r) for r in got] == [("70", 'Renal failure, "acute"', None, None), ("> 89", None, None, None)]


def test_differing_files_are_stacked(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "x long, y string").write.parquet(str(tmp_path / "t/process_date=1/a"))
    spark.createDataFrame([(2, 0.5)], "x long, z double").write.parquet(str(tmp_path / "t/process_date=2/b"))
    got = files.read_table(spark, str(tmp_path / "t")).select("x", "y", "z").orderBy("x").collect()
    assert [tuple(r) for r in got] == [(1, "a", None), (2, None, 0.5)]


def test_unknown_folders_are_no_table(spark, tmp_path):
    for name in ("visits_core", "_quality", "other"):
        spark.range(1).write.parquet(str(tmp_path / name / "p=1"))
    got = files.silver_files(spark, f"file:{tmp_path}")
    assert {r["table_name"] for r in got.collect()} == {"visits_core"}


def test_envelope_json_has_all_columns(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    row = sinks.to_raw_envelope(df, "s", DAY1).first()
    assert row["_airbyte_data"] == '{"x":"a","y":null}'
    assert (row["_airbyte_stream"], row["_airbyte_emitted_at"], row["x"]) == ("s", DAY1, "a")


def test_mart_keeps_the_version_being_read(spark, tmp_path):
    path = str(tmp_path / "mart")
    assert sinks.read_mart(spark, path) is None
    for n in (1, 2, 3):
        current = sinks.read_mart(spark, path)
        nxt = spark.range(n) if current is None else current.union(spark.range(100, 101))
        assert sinks.write_mart(nxt, path) == n
    assert sinks.read_mart(spark, path).count() == 3
    assert paths.children(spark, path) == ["version=000002", "version=000003"]
    # A version without its success mark does not exist for readers.
    spark.range(9).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/version=000004")
    assert sinks.read_mart(spark, path).count() == 3


def test_publish_checks_before_it_connects(spark):
    df = spark.createDataFrame([(1,), (1,)], "k long")
    with pytest.raises(ValueError, match="identifier"):
        sinks.publish_table(df, "jdbc:none", "a", "t; drop", ["k"])
    with pytest.raises(ValueError, match="share"):
        sinks.publish_table(df, "jdbc:none", "a", "t", ["k"])


def test_growing_source(spark, tmp_path):
    def grown(n):
        folder = tmp_path / f"source{n}"
        visits = [visit(patientunitstayid=str(i)) for i in range(1, n + 1)]
        df = frame(spark, *visits).withColumn("row_no", F.col("patientunitstayid"))
        sinks.write_csv(I.complete_source(df, ("row_no",)), str(folder))
        return I.Layout(str(folder), str(tmp_path / "root"), DAY1, max_rows=2)

    assert I.sync_rows_after(spark, grown(3), "row_no") == 3
    assert I.sync_rows_after(spark, grown(5), "row_no") == 2
    assert I.sync_rows_after(spark, grown(5), "row_no") == 0
    assert I.sync_rows_after(spark, grown(2), "row_no") == 0
    stored = files.read_table(spark, f"{tmp_path}/root/bronze/ehr_visits")
    assert sorted(r["row_no"] for r in stored.collect()) == [1, 2, 3, 4, 5]
    per_file = stored.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert per_file <= 2


def test_growing_file_without_order_column(spark, tmp_path):
    path = tmp_path / "source.csv"
    layout = I.Layout(str(path), str(tmp_path / "root"), DAY1)

    def grown(n, end="\n"):
        path.write_text("uniquepid,patientunitstayid" + "".join(f"\nn/a,{1000 - i}" for i in range(n)) + end)
        return layout

    with pytest.raises(FileNotFoundError):
        I.sync_row_offsets(spark, layout)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")  # many splits, cut inside lines
    try:
        assert I.sync_row_offsets(spark, grown(0)) == 0
        assert I.sync_row_offsets(spark, grown(300)) == 300
        assert I.sync_row_offsets(spark, grown(300, "")) == 0
        assert I.sync_row_offsets(spark, grown(7)) == 0
        spark.conf.set("spark.sql.files.maxPartitionBytes", "333")
        assert I.sync_row_offsets(spark, grown(450)) == 150
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    stored = files.read_table(spark, layout.bronze).select(I.SOURCE_ROW, "patientunitstayid", "uniquepid").collect()
    assert sorted(map(tuple, stored)) == [(i + 1, str(1000 - i), None) for i in range(450)]
    several = tmp_path / "several"
    spark.range(4).repartition(2).write.option("header", True).csv(str(several))
    with pytest.raises(ValueError, match="one file"):
        files.number_rows(spark, str(several), S.text_schema(["id"]), "n")


def test_restart_changes_nothing_and_new_files_are_merged(spark, tmp_path):
    source, root = str(tmp_path / "source"), str(tmp_path / "root")
    put(spark, source, visit(), visit(), visit(patientunitstayid="2", hospitalid="61"))
    first = I.Layout(source, root, DAY1)
    assert I.run_all(spark, first) == {"bronze": 3, "silver": 2, "gold": 2, "final": 2}
    assert I.run_all(spark, first) == {"bronze": 3, "silver": 2, "gold": 2, "final": 2}

    put(spark, source, visit(patientunitstayid="3"))
    second = I.Layout(source, root, DAY2)
    assert I.run_all(spark, second) == {"bronze": 4, "silver": 3, "gold": 3, "final": 3}
    mart = sinks.read_mart(spark, second.mart("doctor"))
    assert mart.select("record_hash").distinct().count() == 3
    assert {(r["as_of_date"], r["hospitalid"]): r["total_visits"] for r in
            sinks.read_mart(spark, second.mart("hospital_kpi")).collect()} == {
        ("2024-03-01", 60): 1, ("2024-03-01", 61): 1, ("2024-03-02", 60): 1}
    report = spark.read.json(second.quality).orderBy("total_rows").collect()
    assert [(r["total_rows"], r["duplicate_patientunitstayid"]) for r in report] == [(1, 0), (3, 1)]


def test_batch_written_twice_is_one_batch(spark, tmp_path):
    source, root = str(tmp_path / "source"), str(tmp_path / "root")
    put(spark, source, visit(), visit(patientunitstayid="2"))
    layout = I.Layout(source, root, DAY1)
    I.sync_new_files(spark, layout)
    bronze = spark.read.schema(S.bronze_schema()).parquet(layout.bronze)
    I.write_silver_batch(bronze, 0, layout)
    # The crash comes here: written, not committed. The stream repeats batch 0.
    assert I.bronze_to_silver(spark, layout) == 2
    keys = files.read_table(spark, f"{layout.silver}/visits_core").select("record_hash")
    I.merge_touched(keys, layout)
    assert I.silver_to_gold(spark, layout) == 2


def test_part_file_that_comes_before_its_core_file(spark, tmp_path):
    source, root = str(tmp_path / "source"), str(tmp_path / "root")
    put(spark, source, visit())
    layout = I.Layout(source, root, DAY1)
    I.sync_new_files(spark, layout)
    from visitmart.operators.silver import split_silver, to_silver

    tables = split_silver(to_silver(spark.read.schema(S.bronze_schema()).parquet(layout.bronze), DAY1))
    sinks.write_silver({k: v for k, v in tables.items() if k != "visits_core"}, layout.silver, "2024-03-01", 0)
    assert I.merge_touched(tables["diagnosis_care"].select("record_hash"), layout) is None
    sinks.write_silver({"visits_core": tables["visits_core"]}, layout.silver, "2024-03-01", 1)
    assert I.silver_to_gold(spark, layout) == 1
    assert sinks.read_mart(spark, layout.mart("doctor")).first()["los"] is not None


def test_mart_is_rebuilt_when_it_is_gone(spark, tmp_path):
    source, root = str(tmp_path / "source"), str(tmp_path / "root")
    put(spark, source, visit())
    layout = I.Layout(source, root, DAY1)
    assert I.run_all(spark, layout)["gold"] == 1
    other = I.Layout(source, root, DAY1)
    paths.remove(spark, other.mart("doctor"))
    assert I.silver_to_gold(spark, other) == 1


def test_files_of_different_headers_are_united_by_name(spark, tmp_path):
    from visitmart import schema as S
    from visitmart.sources.files import header_groups, read_visits_csv
    from visitmart.streaming import incremental as I

    base = S.SOURCE_COLUMNS
    first = {c: "1" for c in base} | {"gender": "Female", "age": "52", "unittype": "Neuro, ICU", "uniquepid": "002-7053"}
    second = {c: "2" for c in base} | {"gender": "Male", "age": "33", "uniquepid": "002-1"}
    source = tmp_path / "source"
    source.mkdir()
    quoted = lambda row, names: ",".join(f'"{row[c]}"' for c in names)
    (source / "a.csv").write_text(",".join(base) + "\n" + quoted(first, base) + "\n")
    (source / "b.csv").write_text(",".join(base[::-1]) + "\n" + quoted(second, base[::-1]) + "\n")
    assert len(header_groups(spark, str(source))) == 2
    rows = {r.gender: r for r in read_visits_csv(spark, str(source)).collect()}
    assert rows["Female"].age == "52" and rows["Male"].age == "33" and rows["Female"].unittype == "Neuro, ICU"
    layout = I.Layout(str(source), str(tmp_path / "root"), "2024-03-01T06:00:00+00:00", max_files=1)
    assert I.run_all(spark, layout) == {"bronze": 2, "silver": 2, "gold": 2, "final": 2}
    assert I.run_all(spark, layout)["bronze"] == 2


def test_a_batch_moves_no_envelope_and_leaves_no_cache(spark, tmp_path, monkeypatch):
    source, root = str(tmp_path / "source"), str(tmp_path / "root")
    put(spark, source, visit(), visit(patientunitstayid="2"))
    layout, seen = I.Layout(source, root, DAY1), []
    write = sinks.write_wide_silver
    monkeypatch.setattr(sinks, "write_wide_silver", lambda wide, *a, **k: (seen.extend(wide.columns), write(wide, *a, **k)))
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    assert I.run_all(spark, layout) == {"bronze": 2, "silver": 2, "gold": 2, "final": 2}
    assert I.CONTENT in seen and not {"_airbyte_data", "_airbyte_ab_id"} & set(seen)
    assert spark.conf.get(name) == before
    assert paths.children(spark, f"{layout.silver}_spool") == [] and paths.children(spark, f"{layout.gold}/_spool") == []
    assert any(".zstd." in path for path in files.read_table(spark, layout.silver).inputFiles())


def test_batches_follow_source_files_not_rows(spark, tmp_path, monkeypatch):
    source, root = str(tmp_path / "source"), str(tmp_path / "root")
    for day in range(2):
        put(spark, source, *[visit(patientunitstayid=str(10 * day + i)) for i in range(1, 8)])
    layout = I.Layout(source, root, DAY1, max_rows=2, max_files=1)
    I.sync_new_files(spark, layout)
    stored = files.read_table(spark, layout.bronze)
    assert len(stored.inputFiles()) > 4 and stored.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] <= 2
    numbers, write = [], I.write_silver_batch
    monkeypatch.setattr(I, "write_silver_batch", lambda batch, number, where: (numbers.append(number), write(batch, number, where)))
    sources = len(list((tmp_path / "source").glob("*.csv")))
    assert I.bronze_to_silver(spark, layout) == 14
    assert len(numbers) <= sources < len(stored.inputFiles())


def test_growing_file_in_parts(spark, tmp_path):
    root = str(tmp_path / "root")
    for n in (50, 120):
        rows = spark.range(n).selectExpr("CAST(id AS STRING) AS patientunitstayid", "'p' AS uniquepid", "id AS at")
        folder = str(tmp_path / f"source{n}")
        sinks.write_csv(I.complete_source(rows.repartitionByRange(5, "at").sortWithinPartitions("at").drop("at")), folder)
        assert len(list((tmp_path / f"source{n}").glob("part-*.csv"))) == 5
        layout = I.Layout(folder, root, DAY1)
        assert I.sync_row_offsets(spark, layout, parts=True) == min(n, 70)
    stored = files.read_table(spark, layout.bronze).select(I.SOURCE_ROW, "patientunitstayid").collect()
    assert sorted(map(tuple, stored)) == [(i + 1, str(i)) for i in range(120)]
