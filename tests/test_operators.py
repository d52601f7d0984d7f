"""Operators on small frames, against answers worked out by hand or by brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from visitmart import schema as S
from visitmart.operators import cohort as C
from visitmart.operators import evaluation as E
from visitmart.operators import final, gold, ordered, quality, retrieval, shape
from visitmart.operators.silver import clean, split_silver, to_silver

NOW = "2024-02-01T00:00:00+00:00"


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_pick_ensure_union(spark):
    df = spark.createDataFrame([(1, "a")], "x long, y string")
    assert shape.pick(df, ["y", "gone", "y", "x"]).columns == ["y", "x"]
    full = shape.ensure_columns(df, S.text_schema(["y", "z"]))
    assert rows(full) == [(1, "a", None)]
    assert rows(shape.union_all([df.select("x"), df.select("y")])) == [(1, None), (None, "a")]


def test_dedup_last_with_hot_key(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 1000, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("o"))
    kept = shape.dedup_last(df, ["k"], ["o"])
    assert kept.count() == 2001
    assert kept.where("k = 0").first()["o"] == 999
    assert kept._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") >= 2


def test_upsert_by_hash_and_by_visit(spark):
    cols = "record_hash string, patientunitstayid long, patienthealthsystemstayid long, processed_at_utc string, v int"
    old = spark.createDataFrame([("a", 1, 1, "t", 1), ("b", 2, 2, "t", 1)], cols)
    new = spark.createDataFrame([("b", 2, 2, "u", 2), ("c", 3, 3, "u", 2), ("c", 3, 3, "v", 3)], cols)
    got = {r["record_hash"]: r["v"] for r in shape.upsert(old, new, ["processed_at_utc"]).collect()}
    assert got == {"a": 1, "b": 2, "c": 3}
    holed = spark.createDataFrame([(None, 2, 2, "t", 9)], cols)
    got = shape.upsert(old, holed, ["v"])
    assert sorted(r["v"] for r in got.collect()) == [1, 9]
    plain = spark.createDataFrame([(1,), (1,)], "z int")
    assert shape.upsert(plain, plain, []).count() == 1


def test_key_check(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None)], "x long, y string")
    assert rows(shape.key_violations(df, ["x", "y"])) == [(1, 2)]
    with pytest.raises(ValueError, match="1 rows have a null"):
        shape.validate_key(df, ["x", "y"])
    with pytest.raises(ValueError, match="2 rows share"):
        shape.validate_key(df.where("y IS NOT NULL"), ["x", "y"])
    with pytest.raises(ValueError, match="missing"):
        shape.validate_key(df, ["gone"])
    assert shape.validate_key(df.limit(1), ["x"]).count() == 1


def visit(**values):
    row = dict.fromkeys(S.SOURCE_COLUMNS + S.OPTIONAL_COLUMNS)
    row.update(patientunitstayid="1", patienthealthsystemstayid="2", hospitalid="60", wardid="80", uniquepid="002-1",
               gender="Male", age="70", _airbyte_emitted_at="2024-01-01T00:00:00+00:00")
    row.update(values)
    return row


def frame(spark, *visits):
    schema = S.text_schema(S.SOURCE_COLUMNS + S.OPTIONAL_COLUMNS + ["_airbyte_emitted_at"])
    return spark.createDataFrame([[v.get(f.name) for f in schema] for v in visits], schema)


def draws(key):
    import hashlib

    return [int(hashlib.sha256(f"{key}|u{i}".encode()).hexdigest()[:8], 16) / 4294967295.0 for i in (1, 2, 3, 4)]


def test_silver_fills_only_what_is_missing(spark):
    out = to_silver(frame(spark, visit(), visit(patientunitstayid="3", los="4.5", diabetes="1", Condition="")), NOW)
    filled, kept = out.orderBy("patientunitstayid").collect()
    u1, u2, u3, u4 = draws(filled["record_hash"])
    assert filled["los"] == round(1.5 + u1 * 5.5, 2)
    chronic = min(8, round(u2 * 5) + 1)
    assert filled["chronic_conditions"] == chronic
    lace = round(min(14, filled["los"]) * 0.7 + round(u1 * 4) * 1.2 + chronic * 1.4 + 2.0 + u3 * 2.0)
    assert filled["LACE_Score"] == min(19, max(0, lace))
    chance = min(0.65, 0.08 + filled["LACE_Score"] / 40 + chronic / 25)
    assert filled["readmitted"] == int(u4 < chance)
    days = 1 + round(u1 * 59) if filled["readmitted"] else 0
    assert filled["days_until_readmission"] == days
    assert filled[S.TARGET] == int(filled["readmitted"] == 1 and days <= 30)
    assert filled["bmi"] == round(20 + u2 * 15, 1)
    assert (kept["los"], kept["diabetes"], kept["Condition"]) == (4.5, 1, "")
    assert filled["Condition"] == "General Medical"


def test_silver_needs_its_columns(spark):
    with pytest.raises(ValueError, match="gender"):
        clean(spark.createDataFrame([("1",)], "age string"), NOW)


def test_height_zero_gives_drawn_bmi(spark):
    out = to_silver(frame(spark, visit(admissionheight="0", admissionweight="70")), NOW).first()
    assert out["bmi"] == round(20 + draws(out["record_hash"])[1] * 15, 1)


def test_split_and_assemble(spark):
    silver = to_silver(frame(spark, visit(), visit(los="9"), visit(patientunitstayid="5")), NOW)
    tables = split_silver(silver, ["los"])
    assert {name: t.columns == S.SILVER_TABLES[name] or set(t.columns) <= set(S.SILVER_TABLES[name])
            for name, t in tables.items()} == dict.fromkeys(S.SILVER_TABLES, True)
    whole = gold.assemble(tables)
    assert whole.count() == 2
    assert whole.where("patientunitstayid = 1").first()["los"] == 9.0
    assert gold.assemble({}) is None
    assert "glucose" not in gold.assemble({"visits_core": tables["visits_core"]}).columns


def test_assembly_packs_hashes_and_keeps_other_texts(spark):
    keys = ["ab" * 32, "AB" * 32, "zz" * 32, "cd" * 31, "é", "", None]
    core = spark.createDataFrame([(k, str(i)) for i, k in enumerate(keys)] * 2, "record_hash string, age string")
    part = spark.createDataFrame([(k, str(i), i) for i, k in enumerate(keys)], "record_hash string, age string, los int")
    tables = {"visits_core": core, "utilization_outcomes": part}
    out = gold.assemble(tables, ["age"])
    assert out.columns == ["record_hash", "age", "los"]
    got = {(k, str(i), None if k is None else i) for i, k in enumerate(keys)}
    assert len(rows(out)) == len(keys) and set(rows(out)) == got
    only = spark.createDataFrame([(keys[0],), (keys[4],)], "record_hash string")
    assert set(rows(gold.assemble(tables, ["age"], only))) == {(keys[0], "0", 0), (keys[4], "4", 4)}
    assert "lower(hex" in out._jdf.queryExecution().optimizedPlan().toString()


def test_marts_keep_null_groups(spark):
    silver = to_silver(frame(spark, visit(hospitalid=None), visit(unittype="MICU", patientunitstayid="8")), NOW)
    doctor = gold.doctor_mart(silver)
    assert doctor.columns == S.DOCTOR_MART_COLUMNS
    assert {r["hospitalid"] for r in gold.hospital_kpi(doctor).collect()} == {None, 60}
    assert {r["unittype"] for r in gold.department_kpi(doctor).collect()} == {None, "MICU"}


def test_driver_summary_invariants(spark):
    fixed = [("0-5", 1905, 28, 1.47), ("6-10", 1302, 149, 11.44), ("11-15", 703, 135, 19.2), ("16+", 125, 25, 20.0)]
    middle = {"0-5": 3.0, "6-10": 8.0, "11-15": 12.0, "16+": 20.0}
    parts = [
        spark.range(n).select(
            F.col("id").alias("patientunitstayid"), F.lit(middle[band]).alias("LACE_Score"), F.lit(1.0).alias("los"),
            F.lit(2).alias("chronic_conditions"), (F.col("id") < early).cast("long").alias(S.TARGET))
        for band, n, early, _ in fixed
    ]
    got = final.driver_summary(shape.union_all(parts)).select(
        "lace_band", "patients", "readmission_30d_count", "readmission_30d_rate_pct")
    assert rows(got) == fixed
    empty = {r["lace_band"]: r for r in final.driver_summary(parts[0]).collect()}["16+"]
    assert (empty["patients"], empty["avg_los"], empty["readmission_30d_rate_pct"]) == (0, None, None)


def test_metric_invariants(spark):
    counts = spark.createDataFrame([(731, 9, 26, 41)], "tn long, fp long, fn long, tp long")
    got = E.with_ratios(counts).first()
    assert got["accuracy"] == pytest.approx(0.9566295, abs=1e-7)
    assert (got["precision"], got["recall"], got["f1"]) == (
        pytest.approx(0.82), pytest.approx(0.6119403, abs=1e-7), pytest.approx(0.7008547, abs=1e-7))
    none = spark.createDataFrame([(5, 0, 0, 0)], "tn long, fp long, fn long, tp long")
    assert E.with_ratios(none).select("precision", "recall", "f1").first() == (0.0, 0.0, 0.0)


def test_quality_counts_missing_columns_and_repeats(spark):
    df = spark.createDataFrame([(1, True), (None, False), (None, False), (1, False)], "patientunitstayid long, is_expired boolean")
    got = quality.quality_report(df, ["patientunitstayid", "gone"]).first()
    assert got["required_column_null_counts"] == {"patientunitstayid": 2, "gone": 4}
    assert (got["total_rows"], got["duplicate_patientunitstayid"], got["expired_count"]) == (4, 2, 1)
    assert (got["readmitted_count"], got["readmitted_rate_pct"]) == (0, 0.0)
    nothing = quality.quality_report(df.where("1 = 0"), ["patientunitstayid"]).first()
    assert (nothing["total_rows"], nothing["readmitted_rate_pct"]) == (0, 0.0)


@pytest.mark.parametrize("pieces", [1, 4, 64])
def test_running_totals_match_brute_force(spark, pieces):
    random.seed(5)
    data = [(g, v, random.randint(1, 9)) for g in ("a", "b", None) for v in random.sample(range(1000), 150)]
    df = spark.createDataFrame(data, "g string, v int, n long").withColumn("v", F.col("v").cast("double"))
    got = {(r["g"], r["v"]): (r["n_upto"], r["n_total"]) for r in
           ordered.running_totals(df, "v", ["n"], ["g"], descending=True, pieces=pieces).collect()}
    assert len(got) == len(data)
    for g, v, _ in data:
        mine = [n for h, w, n in data if h == g and w >= v]
        assert got[(g, float(v))] == (sum(mine), sum(n for h, _, n in data if h == g))


def test_quantiles_with_heavy_value(spark):
    values = [3.0] * 400 + [float(i) for i in range(200)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = ordered.exact_quantiles(df, "v", {"q1": 0.25, "median": 0.5, "q3": 0.75}).first()
    ordered_values = sorted(values)

    def q(p):
        h = p * (len(values) - 1)
        low = math.floor(h)
        return ordered_values[low] + (ordered_values[math.ceil(h)] - ordered_values[low]) * (h - low)

    assert (got["n"], got["least"], got["greatest"]) == (600, 0.0, 199.0)
    assert [got["q1"], got["median"], got["q3"]] == [pytest.approx(q(p)) for p in (0.25, 0.5, 0.75)]


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(2.0,), (2.0,), (None,)], "v double")
    assert rows(ordered.histogram(df, "v", 5).select("bin", "count")) == [(0, 2)]


def brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_curves_match_brute_force(spark):
    random.seed(3)
    pairs = [(round(random.random(), 2), int(random.random() < 0.3)) for _ in range(400)]
    df = spark.createDataFrame(pairs, "score double, label int")
    curve = E.score_curve(df)
    assert E.ranking_quality(curve).first()["roc_auc"] == pytest.approx(brute_auc(pairs))
    best = E.best_threshold(curve).first()

    def f1(t):
        tp = sum(y for s, y in pairs if s >= t)
        fp = sum(1 - y for s, y in pairs if s >= t)
        p, r = tp / (tp + fp), tp / sum(y for _, y in pairs)
        return 2 * p * r / max(p + r, 1e-12)

    scores = sorted({s for s, _ in pairs})
    assert best["f1"] == pytest.approx(max(map(f1, scores)))
    assert best["threshold"] == max(scores, key=lambda t: (f1(t), -t))


@pytest.mark.parametrize("parts", [{"train": 60, "validation": 20, "test": 20}, {"train": 70, "test": 30}])
def test_split_is_exact_per_class(spark, parts):
    df = spark.range(1007).select("id", (F.col("id") % 5 == 0).cast("int").alias("label"))
    got = E.stratified_split(df, "label", "id", parts)
    assert got.count() == 1007
    for label, n in ((0, 805), (1, 202)):
        sizes = {r["part"]: r["count"] for r in got.where(F.col("label") == label).groupBy("part").count().collect()}
        done, before = 0, 0
        for name, share in parts.items():
            done += share
            upto = math.floor(n * done / 100 + 0.5)
            assert sizes[name] == upto - before
            before = upto
    again = E.stratified_split(df, "label", "id", parts)
    assert got.exceptAll(again).count() == 0


def test_split_keeps_rows_of_a_hot_key_together(spark):
    df = spark.range(900).select(F.when(F.col("id") < 300, 0).otherwise(F.col("id")).alias("k"), F.lit(1).alias("label"))
    got = E.stratified_split(df, "label", "k", {"train": 50, "test": 50})
    assert got.where("k = 0").select("part").distinct().count() == 1
    assert got.count() == 900


def test_split_of_tiny_class(spark):
    df = spark.createDataFrame([(1, 1)] + [(i, 0) for i in range(2, 12)], "id long, label int")
    got = E.stratified_split(df, "label", "id", {"train": 20, "test": 80})
    assert got.where("label = 1").first()["part"] == "test"


def test_target_guard(spark):
    df = spark.createDataFrame([(0,), (None,)], f"{S.TARGET} int")
    with pytest.raises(ValueError, match="single class"):
        E.check_target(df)
    with pytest.raises(ValueError, match="missing"):
        E.check_target(df.select(F.lit(1).alias("x")))


def test_admit_month_falls_back_only_when_no_day_is_known(spark):
    cols = "admit_day string, processed_at_utc string"
    none = spark.createDataFrame([("n/a", NOW), (None, NOW)], cols)
    assert {r["admit_month"].isoformat() for r in C.with_admit_month(none).collect()} == {"2024-02-01T00:00:00"}
    some = spark.createDataFrame([("5/3/2020", NOW), (None, NOW)], cols)
    assert {r["admit_month"] and r["admit_month"].isoformat() for r in C.with_admit_month(some).collect()} == {
        "2020-03-01T00:00:00", None}


def test_capacity_repeats_and_limits(spark):
    df = spark.range(120).select(F.lit(0.5).alias("risk_score_live"), F.col("id").cast("string").alias("record_hash"))
    got = sorted(rows(C.preventable_by_capacity(df, 0.5)))
    assert [k for k, _ in got] == [50, 100, 120, 120, 120]
    hundred = sorted(rows(C.preventable_by_capacity(df.limit(100), 0.5)))
    assert [k for k, _ in hundred] == [50, 100, 100, 100]


def test_filters(spark):
    df = spark.createDataFrame([(60, None, "f", 1, 40.0), (61, "A", None, 0, None), (61, "A", "f", 0, 50.0)],
                               f"hospitalid long, unittype string, gender string, {S.TARGET} long, age double")
    assert C.apply_filters(df, C.Cohort()).count() == 2
    assert C.apply_filters(df, C.Cohort(units=("unknown",))).count() == 1
    assert C.apply_filters(df, C.Cohort(outcome="Readmitted")).count() == 1
    assert C.apply_filters(df, C.Cohort(age_low=50, age_high=50)).count() == 1


def test_duplicates_without_day(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x"), (3, "z")], "patientunitstayid long, admit_month string")
    assert dict(rows(quality.duplicates_by_month(df))) == {"x": 1, "y": 1, "z": 0}
    assert rows(quality.duplicate_count(df)) == [(1, 4, 25.0)]


def test_tokens_and_pairs(spark):
    df = spark.createDataFrame([(1, "The Quick, brown_fox a über!"), (2, "a b")], "id long, text string")
    got = retrieval.tokenize(df, "id", "text", ["the"])
    assert sorted(r["term"] for r in got.where("id = 1").collect()) == [
        "brown_fox", "brown_fox über", "quick", "quick brown_fox", "über"]
    assert rows(got.where("id = 2")) == [(2, None)]


def test_retrieval_order_and_fallback(spark):
    texts = [(1, "alpha beta", "s"), (2, "beta beta gamma", "s"), (3, "delta", "s")]
    df = spark.createDataFrame(texts, "id long, text string, source string")
    assert [r["id"] for r in retrieval.retrieve(df, "id", "text", "gamma", 2, []).collect()] == [2, 1]
    assert [r["id"] for r in retrieval.retrieve(df, "id", "text", "nothing known", 2, []).collect()] == [1, 2]
    top = retrieval.retrieve(df, "id", "text", "delta", 1, [])
    assert retrieval.context(top, "id").first()["context"] == "[1] source=s | delta"


def test_tfidf_rows_have_length_one(spark):
    df = spark.createDataFrame([(1, "alpha beta beta"), (2, "beta gamma")], "id long, text string")
    got = retrieval.tfidf(df, "id", "text", [])
    for r in got.groupBy("id").agg(F.sum(F.col("weight") ** 2).alias("s")).collect():
        assert r["s"] == pytest.approx(1.0)
    weights = {(r["id"], r["term"]): r["weight"] for r in got.collect()}
    idf = {"alpha": math.log(3 / 2) + 1, "beta": 1.0, "alpha beta": math.log(3 / 2) + 1, "beta beta": math.log(3 / 2) + 1}
    norm = math.sqrt(sum(((2 if t == "beta" else 1) * w) ** 2 for t, w in idf.items()))
    assert weights[(1, "beta")] == pytest.approx(2 / norm)


def test_chunks(spark):
    empty = retrieval.render_chunks(spark)
    assert rows(empty) == [(0, "No analytics files were found in Data/final.", "system")]
    importance = spark.createDataFrame([("los", 0.25), ("age", 0.5)], "feature string, importance double")
    metrics = spark.createDataFrame([(0.9, 0.5, 1, 2, 3, 4)], "roc_auc double, pr_auc double, tn long, fp long, fn long, tp long")
    full = metrics.selectExpr("*", "0.8D accuracy", "0.7D precision", "0.6D recall", "0.65D f1", "'forest' selected_model")
    got = [r["text"] for r in retrieval.render_chunks(spark, importance=importance, metrics=full).orderBy("chunk_id").collect()]
    assert got == [
        "model_feature=age importance=0.5",
        "model_feature=los importance=0.25",
        "model_metrics roc_auc=0.9 pr_auc=0.5 accuracy=0.8 precision=0.7 recall=0.6 f1=0.65 selected_model=forest "
        "tn=1 fp=2 fn=3 tp=4",
    ]
