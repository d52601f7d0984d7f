"""Training and applying the readmission classifier with Spark ML."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import (
    OneHotEncoder,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitmart import schema as S
from visitmart.functions.numbers import round_even, to_float
from visitmart.operators import evaluation as E
from visitmart.operators.ordered import exact_quantiles
from visitmart.operators.shape import numeric_like, spread
from visitmart.session import stored

LABEL, WEIGHT, FEATURES, KEY = "_label", "_weight", "_features", "_row_key"
# The indexer keeps every value of a text column on the driver and in the model.
MAX_CATEGORIES = 100_000


@dataclass(frozen=True)
class Columns:
    numeric: list[str]
    categorical: list[str]


@dataclass(frozen=True)
class Trained:
    name: str
    model: PipelineModel
    threshold: float
    validation_f1: float
    metrics: DataFrame
    columns: Columns
    importance: DataFrame


def infer_columns(df: DataFrame, keep_ids: bool = False) -> Columns:
    """Feature columns by kind; a text column that nearly always parses as a number counts as one."""
    features = E.feature_columns(df, keep_ids)
    numbers = {f.name for f in features.schema if f.dataType.typeName() in ("double", "float", "long", "integer")}
    texts = [name for name in features.columns if name not in numbers and not name.startswith("_")]
    # One row per text column.
    parsed = {r["feature"] for r in numeric_like(features, texts).where("is_numeric").collect()} if texts else set()
    return Columns(
        numeric=[name for name in features.columns if name in numbers or name in parsed],
        categorical=[name for name in texts if name not in parsed],
    )


def typed_features(df: DataFrame, columns: Columns) -> DataFrame:
    return df.withColumns(
        {
            **{name: to_float(df, name) for name in columns.numeric},
            **{name: F.col(name).cast("string") for name in columns.categorical},
            LABEL: E.target(df).cast("double"),
        }
    )


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows per value of each column."""
    return (
        df.select([F.col(name).cast("string").alias(name) for name in columns])
        .unpivot([], columns, "feature", "value")
        .where("value IS NOT NULL")
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def most_frequent(df: DataFrame, columns: list[str]) -> DataFrame:
    """The most frequent value of each column, the least of them on a tie. One row per column."""
    first = Window.partitionBy("feature").orderBy(F.col("n").desc(), F.col("value").asc())
    ranked = value_counts(df, columns).withColumn("_rank", F.row_number().over(first))
    return ranked.where("_rank = 1").select("feature", "value")


def check_categories(df: DataFrame, columns: list[str], limit: int = MAX_CATEGORIES) -> None:
    """An error naming the text columns with so many values that their list does not belong in a model."""
    sizes = value_counts(df, columns).groupBy("feature").agg(F.count(F.lit(1)).alias("n"))
    large = [f"{row['feature']} ({row['n']})" for row in sizes.where(F.col("n") > limit).collect()]
    if large:
        raise ValueError(f"text columns with more than {limit} values: {', '.join(sorted(large))}")


def medians(df: DataFrame, columns: list[str]) -> dict[str, float]:
    """Exact median of each column that has a value. One row per column is collected."""
    long = df.select([F.col(name).cast("double").alias(name) for name in columns]).unpivot([], columns, "feature", "value")
    return {r["feature"]: r["median"] for r in exact_quantiles(long, "value", {"median": 0.5}, ["feature"]).collect()}


def _fills(values: dict[str, str], columns: list[str]) -> SQLTransformer:
    fills = ", ".join(f"coalesce(`{name}`, {values[name]}) AS `{name}__filled`" for name in columns)
    return SQLTransformer(statement=f"SELECT *, {fills} FROM __THIS__")


def preprocessor(df: DataFrame, columns: Columns, scale: bool = True) -> PipelineModel:
    """Fitted on ``df``: median fill and scaling of numbers, most-frequent fill and indicator columns of texts.

    A column without any value is filled with 0. A value not seen in training gives no indicator: the indexer
    puts it last and the encoder drops the last.
    """
    numeric, categorical = columns.numeric, columns.categorical
    stages: list = []
    parts: list[str] = []
    if numeric:
        middle = medians(df, numeric)
        stages += [
            _fills({name: f"{float(middle.get(name) or 0.0)!r}D" for name in numeric}, numeric),
            VectorAssembler(inputCols=[f"{name}__filled" for name in numeric], outputCol="_numbers"),
        ]
        if scale:
            stages.append(StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True, withStd=True))
        parts.append("_scaled" if scale else "_numbers")
    if categorical:
        check_categories(df, categorical)
        values = {row["feature"]: row["value"] for row in most_frequent(df, categorical).collect()}
        quoted = {name: "'" + values.get(name, "").replace("\\", "\\\\").replace("'", "\\'") + "'" for name in categorical}
        index = [f"{name}__index" for name in categorical]
        flags = [f"{name}__flags" for name in categorical]
        stages += [
            _fills(quoted, categorical),
            StringIndexer(
                inputCols=[f"{name}__filled" for name in categorical],
                outputCols=index,
                handleInvalid="keep",
                stringOrderType="alphabetAsc",
            ),
            OneHotEncoder(inputCols=index, outputCols=flags, dropLast=True),
        ]
        parts += flags
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=parts, outputCol=FEATURES)]).fit(df)


def fit_after(prepared: PipelineModel, classifier: Estimator, df: DataFrame) -> PipelineModel:
    """The fitted preprocessing followed by ``classifier`` fitted on what it makes of ``df``."""
    vectors = prepared.transform(df).select(FEATURES, LABEL, WEIGHT)
    return PipelineModel(stages=[*prepared.stages, classifier.fit(vectors)])


def candidates(
    rows: int,
    seed: int = 42,
    forest_trees: int = 600,
    extra_trees: int = 700,
    max_depth: int = 30,
    max_iter: int = 5000,
) -> dict[str, Estimator]:
    """The three classifiers to choose from, in order of preference on a tie.

    The depth is the greatest that Spark grows. The last one draws no bootstrap sample and
    looks at few features per split.
    """
    common = {"featuresCol": FEATURES, "labelCol": LABEL, "weightCol": WEIGHT}
    trees = {**common, "minInstancesPerNode": 2, "maxDepth": max_depth, "seed": seed}
    return {
        "logistic_regression": LogisticRegression(
            maxIter=max_iter, regParam=1.0 / max(rows, 1), standardization=False, **common
        ),
        "random_forest": RandomForestClassifier(numTrees=forest_trees, featureSubsetStrategy="sqrt", **trees),
        "extra_trees": RandomForestClassifier(
            numTrees=extra_trees, featureSubsetStrategy="log2", bootstrap=False, **trees
        ),
    }


def probability(model, df: DataFrame) -> DataFrame:
    """Add ``score``: the probability of the positive class."""
    return model.transform(df).withColumn("score", vector_to_array("probability")[1])


def feature_names(model: PipelineModel, columns: Columns) -> list[str]:
    names = list(columns.numeric)
    for stage in model.stages:
        if hasattr(stage, "labelsArray"):
            for column, labels in zip(columns.categorical, stage.labelsArray):
                names += [f"{column}_{label}" for label in labels]
    return names


def feature_importance(model: PipelineModel, columns: Columns, spark) -> DataFrame:
    """Weight of each feature, greatest first: size of its coefficient, or its share of the impurity removed."""
    last = model.stages[-1]
    vector = last.coefficients if hasattr(last, "coefficients") else last.featureImportances
    rows = [(name, abs(float(weight))) for name, weight in zip(feature_names(model, columns), vector.toArray())]
    frame = spark.createDataFrame(rows, "feature string, importance double")
    return frame.orderBy(F.col("importance").desc(), "feature")


def select_model(
    prepared: PipelineModel, train: DataFrame, validation: DataFrame, choices: dict[str, Estimator]
) -> tuple[str, float, float]:
    """Name, threshold and F1 of the candidate with the best F1 on the validation rows; the first on a tie.

    All candidates are fitted on the same vectors, worked out once.
    """
    best = ("", 0.5, -1.0)
    vectors = stored(prepared.transform(train).select(FEATURES, LABEL, WEIGHT))
    unseen = stored(prepared.transform(validation).select(FEATURES, LABEL))
    for name, classifier in choices.items():
        scored = probability(classifier.fit(vectors), unseen).select("score", F.col(LABEL).alias("label"))
        found = E.best_threshold(E.score_curve(scored)).first()
        threshold, f1 = (found["threshold"], found["f1"]) if found["f1"] is not None else (0.5, 0.0)
        if f1 > best[2]:
            best = (name, float(threshold), float(f1))
    if not best[0]:
        raise ValueError("no candidate was trained")
    return best


def test_metrics(scored: DataFrame, threshold: float, name: str, validation_f1: float) -> DataFrame:
    """One row: ranking quality and the metrics at the threshold."""
    quality = E.ranking_quality(E.score_curve(scored)).select("roc_auc", F.col("average_precision").alias("pr_auc"))
    at = E.classification_metrics(scored, threshold)
    # Two one-row frames side by side.
    both = at.withColumn("_q", quality.select(F.struct("roc_auc", "pr_auc").alias("q")).scalar())
    return both.select(
        F.col("_q.roc_auc").alias("roc_auc"),
        F.col("_q.pr_auc").alias("pr_auc"),
        *at.columns,
        F.lit(threshold).alias("threshold"),
        F.lit("best_f1_on_validation").alias("threshold_selection"),
        F.lit(validation_f1).alias("validation_f1"),
        F.lit(name).alias("selected_model"),
    )


def train(
    df: DataFrame,
    key: str,
    keep_ids: bool = False,
    seed: int = 42,
    test_pct: int = 20,
    **options,
) -> Trained:
    """Choose a classifier and its threshold on validation rows, refit on all but the test rows, and test it.

    ``key`` names a column unique per row; it orders the split and is no feature. The split
    rows are written once: the fits pass over them many times.
    """
    E.check_target(df)
    validation_pct = (100 - test_pct) // 4
    keyed = df.withColumnRenamed(key, KEY)
    columns = infer_columns(keyed, keep_ids)
    ready = typed_features(keyed, columns)
    parts = {"train": 100 - test_pct - validation_pct, "validation": validation_pct, "test": test_pct}
    used = ready.select(KEY, LABEL, *columns.numeric, *columns.categorical)
    split = stored(E.stratified_split(used, LABEL, KEY, parts, seed))

    fitting, validation = split.where("part = 'train'"), split.where("part = 'validation'")
    both, test = split.where("part <> 'test'"), split.where("part = 'test'")
    weighted = E.balanced_weight(fitting, LABEL, WEIGHT)
    choices = candidates(fitting.count(), seed, **options)
    name, threshold, f1 = select_model(preprocessor(fitting, columns), weighted, validation, choices)

    # The regularisation of the refit follows from its own number of rows.
    chosen = candidates(both.count(), seed, **options)[name]
    model = fit_after(preprocessor(both, columns), chosen, E.balanced_weight(both, LABEL, WEIGHT))
    scored = probability(model, test).select("score", F.col(LABEL).alias("label"))
    return Trained(
        name,
        model,
        threshold,
        f1,
        test_metrics(scored, threshold, name, f1),
        columns,
        feature_importance(model, columns, df.sparkSession),
    )


def score(trained: Trained, df: DataFrame) -> DataFrame:
    """Ids, label, prediction and risk of every row."""
    ids = [name for name in S.ID_COLUMNS if name in df.columns]
    kept = df.select(*[F.col(name).alias(f"_id_{name}") for name in ids], "*")
    scored = probability(trained.model, typed_features(kept, trained.columns))
    return scored.select(
        *[F.col(f"_id_{name}").alias(name) for name in ids],
        F.col(LABEL).cast("int").alias(S.TARGET),
        (F.col("score") >= F.lit(trained.threshold)).cast("int").alias("predicted_readmission_30d"),
        round_even(F.col("score"), 6).alias("predicted_readmission_risk"),
    )


def metrics_report(trained: Trained, df: DataFrame, artifacts: dict[str, str] | None = None) -> DataFrame:
    """One row with size, positive rate, metrics and where the artefacts are kept."""
    size = df.select(E.target(df).alias("_y")).agg(
        F.count(F.lit(1)).alias("rows"),
        round_even(F.avg("_y") * F.lit(100.0), 4).alias("target_positive_rate_pct"),
    )
    metrics = trained.metrics.select(
        F.struct(
            *[c for c in trained.metrics.columns if c not in ("tn", "fp", "fn", "tp")],
            F.struct("tn", "fp", "fn", "tp").alias("confusion_matrix"),
        ).alias("m")
    )
    out = size.withColumn("metrics", metrics.scalar())
    if artifacts:
        out = out.withColumn("artifacts", F.struct(*[F.lit(v).alias(k) for k, v in artifacts.items()]))
    return out


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def fit_dashboard_model(df: DataFrame, key: str, seed: int = 42, min_rows: int = 50) -> Trained | None:
    """Balanced logistic model on the dashboard's features, tested on 30 % of the rows.

    None when there are too few rows, one class only, or no feature.
    """
    columns = Columns(
        [name for name in S.DASHBOARD_NUMERIC if name in df.columns],
        [name for name in S.DASHBOARD_CATEGORICAL if name in df.columns],
    )
    if S.TARGET not in df.columns or not (columns.numeric or columns.categorical):
        return None
    size = E.target_classes(df).first()
    if size["classes"] < 2 or size["rows"] < min_rows:
        return None
    ready = typed_features(df.withColumnRenamed(key, KEY), columns)
    unknown = {name: F.coalesce(F.col(name), F.lit("unknown")) for name in columns.categorical}
    used = ready.withColumns(unknown).select(KEY, LABEL, *columns.numeric, *columns.categorical)
    split = stored(E.stratified_split(used, LABEL, KEY, {"train": 70, "test": 30}, seed))
    fitting, test = split.where("part = 'train'"), split.where("part = 'test'")
    logistic = candidates(fitting.count(), seed, max_iter=2000)["logistic_regression"]
    # Medians and indicator columns come from all rows, and numbers stay as they are.
    model = fit_after(preprocessor(split, columns, scale=False), logistic, E.balanced_weight(fitting, LABEL, WEIGHT))
    scored = probability(model, test).select("score", F.col(LABEL).alias("label"))
    importance = feature_importance(model, columns, df.sparkSession)
    return Trained("logistic_regression", model, 0.5, 0.0, test_metrics(scored, 0.5, "logistic_regression", 0.0),
                   columns, importance)


def with_probability(trained: Trained, df: DataFrame) -> DataFrame:
    """``df`` with the model's probability, for ranking all rows."""
    unknown = {name: F.coalesce(F.col(name).cast("string"), F.lit("unknown")) for name in trained.columns.categorical}
    numbers = {name: to_float(df, name) for name in trained.columns.numeric}
    scored = probability(trained.model, df.withColumns({**unknown, **numbers}))
    return scored.select(*df.columns, F.col("score").alias("predicted_readmission_probability"))


def importance_table(trained: Trained, n: int = 20) -> DataFrame:
    return trained.importance.limit(n)


def metric_rows(trained: Trained) -> DataFrame:
    """The numeric metrics as ``(metric, value)`` rows."""
    names = [c for c in trained.metrics.columns if c not in ("threshold_selection", "selected_model")]
    numbers = trained.metrics.select([F.col(name).cast("double").alias(name) for name in names])
    return spread(numbers, names, "metric", "value")
