"""Bucketed marts: what a run touches, one-step manifests, and KPI sums with rows taken out again."""

from pyspark.sql import functions as F

from visitmart.operators.gold import department_kpi, hospital_kpi
from visitmart.sources import buckets as B
from visitmart.sources import files, paths, sinks
from visitmart.streaming import gold_state as G
from visitmart.streaming import incremental as I

from test_incremental import DAY1, DAY2, put
from test_operators import visit

DOCTOR = (
    "record_hash string, as_of_date string, hospitalid long, unittype string, uniquepid string, patientunitstayid long, "
    "age_years long, los double, is_expired boolean, is_high_risk boolean, readmitted long, "
    "readmitted_under_30_days long, processed_at_utc string"
)


def rows(spark, *changes):
    base = ("h0", "2024-03-01", 60, "ICU", "p0", 1, 50, 2.5, False, False, 0, 0, DAY1)
    names = [part.split()[0] for part in DOCTOR.split(", ")]
    return spark.createDataFrame([tuple((dict(zip(names, base)) | c)[n] for n in names) for c in changes], DOCTOR)


def check_marts(spark, root):
    """The stored KPI marts equal those worked out afresh from the stored visits."""
    doctor = sinks.read_mart(spark, f"{root}/doctor")
    for name, build in (("hospital_kpi", hospital_kpi), ("department_kpi", department_kpi)):
        stored = sinks.read_mart(spark, f"{root}/{name}")
        fresh = build(doctor).select(stored.columns)
        tidy = lambda df: sorted(
            (tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()), key=repr
        )
        assert tidy(stored) == tidy(fresh)
    return doctor


def test_replaced_visits_leave_their_groups(spark, tmp_path):
    root = str(tmp_path / "gold")
    first = [
        {"record_hash": f"h{i}", "hospitalid": 60 + i % 3, "uniquepid": f"p{i % 7}", "patientunitstayid": i, "los": i / 7}
        for i in range(40)
    ]
    first += [{"record_hash": "n1", "hospitalid": None, "uniquepid": None, "los": None, "age_years": None, "unittype": None}]
    assert G.apply_changes(spark, root, rows(spark, *first), 4) == 1
    check_marts(spark, root)
    # moved to another hospital, patient and day; a patient whose last visit goes; a null key; a new visit
    second = [
        {"record_hash": "h3", "hospitalid": 99, "uniquepid": "p3", "los": 0.1, "is_expired": True},
        {"record_hash": "h4", "hospitalid": 61, "uniquepid": "new", "as_of_date": "2024-03-02", "readmitted": 1},
        {"record_hash": "n1", "hospitalid": 60, "uniquepid": "p0", "patientunitstayid": None},
        {"record_hash": "x1", "hospitalid": None, "uniquepid": "p9", "is_high_risk": None},
    ]
    assert G.apply_changes(spark, root, rows(spark, *second), 4) == 2
    assert check_marts(spark, root).count() == 42
    # repeated after a crash: nothing counts twice
    assert G.apply_changes(spark, root, rows(spark, *second), 4) == 3
    assert check_marts(spark, root).count() == 42
    # all visits of a group go elsewhere: the group is gone
    everywhere = [c | {"hospitalid": 7, "los": 1.0} for c in first]
    G.apply_changes(spark, root, rows(spark, *everywhere), 4)
    check_marts(spark, root)
    assert {r.hospitalid for r in sinks.read_mart(spark, f"{root}/hospital_kpi").collect()} == {7, 99, None, 61} - {99, 61}
    assert G.apply_changes(spark, root, rows(spark).limit(0), 4) == 0


def test_a_run_reads_and_writes_only_its_bucket(spark, tmp_path):
    source, root = str(tmp_path / "source"), str(tmp_path / "root")
    put(spark, source, *[visit(patientunitstayid=str(i)) for i in range(40)])
    layout = I.Layout(source, root, DAY1, buckets=8)
    I.run_all(spark, layout)
    before = B.BucketStore(spark, layout.gold).tables["doctor"]["folders"]
    assert len(before) == 8
    put(spark, source, visit(patientunitstayid="1000"))
    I.run_all(spark, I.Layout(source, root, DAY2, buckets=8))
    store = B.BucketStore(spark, layout.gold)
    after = store.tables["doctor"]["folders"]
    changed = [k for k in after if after[k] != before[k]]
    assert len(changed) == 1  # written
    number = int(changed[0])
    (name,) = [n for n in paths.children(spark, f"{layout.gold}/doctor") if n in after[changed[0]]]
    assert [n for n in paths.children(spark, f"{layout.gold}/doctor/{name}") if "=" in n] == [f"in_bucket={number}"]
    read = store.read("doctor", [number]).inputFiles()
    assert read and all(f"/{after[changed[0]]}/" in path for path in read)  # read
    label = f"bucket={B.bucket_label(number, 8)}"
    for table in files.read_silver_tables(spark, layout.silver, ([number], 8)).values():
        assert all(f"/{label}/" in path for path in table.inputFiles())  # and in Silver
    assert store.read("doctor").count() == 41


def test_silver_outside_buckets_is_read_too(spark, tmp_path):
    root = str(tmp_path / "silver")
    spark.createDataFrame([("a",)], "record_hash string").write.parquet(f"{root}/visits_core/process_date=1/batch=0")
    spark.createDataFrame([("b",)], "record_hash string").write.parquet(f"{root}/visits_core/bucket={B.bucket_label(0, 4)}/x")
    spark.createDataFrame([("c",)], "record_hash string").write.parquet(f"{root}/visits_core/bucket={B.bucket_label(1, 4)}/x")
    spark.createDataFrame([("d",)], "record_hash string").write.parquet(f"{root}/visits_core/bucket={B.bucket_label(0, 2)}/x")
    got = files.read_silver_tables(spark, root, ([1], 4))["visits_core"]
    assert sorted(r[0] for r in got.collect()) == ["a", "c", "d"]
    assert files.read_silver_tables(spark, root)["visits_core"].count() == 4


def test_manifest_changes_all_tables_in_one_step(spark, tmp_path):
    root = str(tmp_path / "store")
    store = B.BucketStore(spark, root)
    assert store.read("t") is None and not store.has("t")
    frame = lambda *ids: spark.createDataFrame([(i, f"v{i}") for i in ids], "id long, v string")
    store.commit({"t": (store.write("t", frame(*range(50)), ["id"], 4), None)})
    (touched,) = B.touched_buckets(frame(7), ["id"], 4)
    new = store.write("t", frame(7), ["id"], 4)
    assert B.BucketStore(spark, root).read("t").count() == 50  # written, not committed
    store.commit({"t": (new, [touched])})
    again = B.BucketStore(spark, root)
    there = again.read("t", [touched])
    assert [r.id for r in there.collect()] == [7]
    assert again.read("t").where(B.bucket_number(["id"], 4) != touched).count() == again.read("t").count() - 1
    # a touched bucket that has no rows any more is gone, an untouched one stays; old folders are removed
    again.commit({"t": (again.write("t", frame(), ["id"], 4), [touched])})
    assert again.read("t", [touched]).count() == 0 and again.read("t", [touched]).columns == ["id", "v"]
    runs = paths.children(spark, f"{root}/t")
    again.commit({"t": (again.write("t", frame(1), ["id"], 4), None)})
    again.commit({"t": (again.write("t", frame(2), ["id"], 4), None)})
    assert [r.id for r in B.BucketStore(spark, root).read("t").collect()] == [2]
    left = [n for n in paths.children(spark, f"{root}/t") if paths.has_files(spark, f"{root}/t/{n}")]
    assert len(runs) >= 3 and len(left) == 2
    nulls = spark.createDataFrame([(None, "x"), (None, "y")], "id long, v string")
    assert len(B.touched_buckets(nulls, ["id"], 4)) == 1
    assert nulls.select(F.max(B.bucket_number(["id"], 4)) < 4).first()[0]


def test_run_wide_quality_counts_across_batches(spark, tmp_path):
    from visitmart.operators.quality import quality_report
    from visitmart.streaming import quality_state as Q

    schema = "patientunitstayid long, unittype string, is_expired boolean, readmitted long, readmitted_under_30_days long"
    batches = [
        [(1, "a", True, 1, 0), (1, None, False, 0, 0), (None, "b", None, None, 1)],
        [(2, None, True, 1, 1), (1, "a", False, 0, 0), (None, None, False, 0, 0)],
        [(3, "c", False, 0, 0)],
    ]
    root, required = str(tmp_path / "state"), ["unittype", "glucose"]
    assert Q.run_report(spark, root, required, DAY1) is None
    frame = lambda part: spark.createDataFrame(part, schema)
    paths_of = lambda n: spark.createDataFrame([(f"f{n}",)] * 2, "path string")
    for n, part in enumerate(batches):
        assert Q.add_batch(spark, root, frame(part), paths_of(n), n, required, 4)
        assert not Q.add_batch(spark, root, frame(part), paths_of(n), n, required, 4)  # repeated after a crash
    got = Q.run_report(spark, root, required, DAY1).first().asDict()
    whole = quality_report(frame(sum(batches, [])), required).first().asDict()
    assert got["duplicate_patientunitstayid"] == 3  # two of id 1, one of the missing id
    assert got.pop("generated_at_utc") == DAY1 and got.pop("input_files") == ["f0", "f1", "f2"]
    assert got == whole


def test_one_report_for_a_run_and_what_was_left_of_the_last(spark, tmp_path, monkeypatch):
    source, root = str(tmp_path / "source"), str(tmp_path / "root")
    put(spark, source, visit(), visit(patientunitstayid="2"))
    first = I.Layout(source, root, DAY1, buckets=2)
    I.sync_new_files(spark, first)
    with monkeypatch.context() as patch:  # the run ends after its batches and before its report
        patch.setattr(I, "report_quality", lambda *_: None)
        I.bronze_to_silver(spark, first)
    put(spark, source, visit(patientunitstayid="2"))
    second = I.Layout(source, root, DAY2, buckets=2)
    I.sync_new_files(spark, second)
    I.bronze_to_silver(spark, second)
    (report,) = spark.read.json(second.quality).collect()
    assert (report.total_rows, report.duplicate_patientunitstayid, report.generated_at_utc) == (3, 1, DAY2)
    assert len(report.input_files) == 2
    I.bronze_to_silver(spark, second)
    assert spark.read.json(second.quality).count() == 1  # nothing new, no report
