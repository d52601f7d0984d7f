"""Training on a small frame: shapes, bounds and round trips."""

import pytest
from pyspark.sql import functions as F

from visitmart import schema as S
from visitmart.operators import training as T
from visitmart.operators.final import model_dataset
from visitmart.operators.silver import to_silver
from visitmart.plans import visits as V
from visitmart.session import materialise
from visitmart.sources import files, sinks

SMALL = {"forest_trees": 4, "extra_trees": 4, "max_depth": 4, "max_iter": 20}


@pytest.fixture(scope="module")
def rows(spark, sf):
    silver = to_silver(V.visits_raw(spark, sf), V.PROCESSED_AT).where("hospitalid < 75").dropDuplicates(["record_hash"])
    return materialise(model_dataset(silver, extra=("record_hash",)))


@pytest.fixture(scope="module")
def trained(rows):
    return T.train(rows, "record_hash", **SMALL)


def test_columns_leave_out_outcomes_and_row_ids(trained):
    used = set(trained.columns.numeric + trained.columns.categorical)
    assert not used & {*S.LEAKAGE_COLUMNS, *S.UNIQUE_ID_COLUMNS, "record_hash"}
    assert "age" in trained.columns.numeric and "gender" in trained.columns.categorical


def test_metrics_are_consistent(rows, trained):
    m = trained.metrics.first()
    assert m["tn"] + m["fp"] + m["fn"] + m["tp"] == pytest.approx(rows.count() * 0.2, abs=2)
    assert 0.5 < m["roc_auc"] <= 1 and 0 <= m["pr_auc"] <= 1
    assert m["selected_model"] in ("logistic_regression", "random_forest", "extra_trees")


def test_importance_names_every_feature(trained):
    got = trained.importance.collect()
    last = trained.model.stages[-1]
    assert len(got) == last.numFeatures
    assert all(a["importance"] >= b["importance"] for a, b in zip(got, got[1:]))


def test_scores_of_all_rows_and_saved_model(spark, rows, trained, tmp_path):
    scored = T.score(trained, rows)
    assert scored.columns == [*S.ID_COLUMNS, S.TARGET, "predicted_readmission_30d", "predicted_readmission_risk"]
    assert scored.count() == rows.count()
    T.save_model(trained.model, str(tmp_path / "model"))
    loaded = T.load_model(str(tmp_path / "model"))
    again = T.score(T.Trained(**{**trained.__dict__, "model": loaded}), rows)
    assert scored.exceptAll(again).count() == 0


def test_unseen_category_and_missing_number_are_scored(rows, trained):
    odd = rows.limit(5).withColumns({"unittype": F.lit("never seen"), "los": F.lit(None).cast("double")})
    assert T.score(trained, odd).where("predicted_readmission_risk IS NULL").count() == 0


def test_report_round_trip(spark, rows, trained, tmp_path):
    sinks.write_report(T.metrics_report(trained, rows, {"model_path": "m"}), str(tmp_path / "metrics"))
    got = files.read_metrics(spark, str(tmp_path / "metrics")).first()
    assert got["selected_model"] == trained.name and got["tp"] == trained.metrics.first()["tp"]


def test_dashboard_model_guards(spark, rows):
    assert T.fit_dashboard_model(rows.limit(20), "record_hash") is None
    assert T.fit_dashboard_model(rows.withColumn(S.TARGET, F.lit(0)), "record_hash") is None


def test_single_class_is_an_error(rows):
    with pytest.raises(ValueError):
        T.train(rows.withColumn(S.TARGET, F.lit(1)), "record_hash", **SMALL)


def test_text_columns_with_too_many_values_are_named(rows):
    assert rows.select("gender").distinct().count() == 6
    with pytest.raises(ValueError, match=r"gender \(6\)"):
        T.check_categories(rows, ["gender", "insurance_provider"], limit=5)
    T.check_categories(rows, ["gender", "insurance_provider"], limit=6)


def test_a_missing_label_is_a_class_of_its_own(spark):
    from collections import Counter

    from visitmart.operators.evaluation import stratified_split

    rows = [(i, None if i < 50 else i % 2) for i in range(150)]
    df = spark.createDataFrame(rows, "id long, y int")
    parts = stratified_split(df, "y", "id", {"train": 60, "validation": 20, "test": 20})
    got = Counter((r.y, r.part) for r in parts.collect())
    assert got == Counter({(y, p): n for y in (None, 0, 1) for p, n in (("train", 30), ("validation", 10), ("test", 10))})


def test_preprocessing_is_exact_and_the_dashboard_leaves_numbers_unscaled(spark):
    from visitmart.operators import training as T

    rows = [(float(v), c) for v, c in zip([1, 2, 3, 4, 100, 7], ["a", "b", "a", None, "it's", "a"])] + [(None, "b")]
    df = spark.createDataFrame(rows, "x double, c string")
    columns = T.Columns(["x"], ["c"])
    assert T.medians(df, ["x"]) == {"x": 3.5}
    plain = T.preprocessor(df, columns, scale=False).transform(df)
    assert {r["x"]: r[T.FEATURES][0] for r in plain.collect()}[None] == 3.5
    assert [r[T.FEATURES][0] for r in plain.where("x = 100").collect()] == [100.0]
    scaled = T.preprocessor(df, columns).transform(df).collect()
    assert abs(sum(r[T.FEATURES][0] for r in scaled)) < 1e-9
    assert T.feature_names(T.preprocessor(df, columns), columns) == ["x", "c_a", "c_b", "c_it's"]
