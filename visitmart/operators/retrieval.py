"""Text evidence: chunks from the result tables, TF-IDF weights and ranking by cosine."""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitmart import schema as S
from visitmart.operators.cohort import positive_rate
from visitmart.operators.shape import union_all

# Fixed pattern: a token is a run of two or more letters, digits or underscores.
TOKEN = r"[\p{L}\p{N}_]{2,}"
MAX_FEATURES = 20_000
# A task takes apart about so many letters, which bounds its terms.
TASK_LETTERS = 4_000_000


def default_stop_words() -> list[str]:
    return StopWordsRemover.loadDefaultStopWords("english")


def text_tasks(df: DataFrame, text: str) -> int:
    """How many tasks the texts are dealt to: by their length, since terms take many times the room of a packed text."""
    letters = df.agg(F.sum(F.length(text).cast("long"))).first()[0] or 0
    spread = min(df.sparkSession.sparkContext.defaultParallelism, letters // 100_000)
    return max(1, spread, -(-letters // TASK_LETTERS))


def tokenize(df: DataFrame, key: str, text: str, stop_words: list[str] | None = None) -> DataFrame:
    """One row per token and per pair of neighbouring tokens, stop words taken out first.

    A row without any token stays, with a null term. The texts are partitioned by
    key before they are taken apart: later steps that count per text then
    need no shuffle of the many terms. The number of parts follows from the letters of all texts (one pass over
    them), so the terms that a task counts stay in its memory.
    """
    stop = default_stop_words() if stop_words is None else stop_words
    listed = ", ".join("'" + word.replace("'", "\\'") + "'" for word in stop)
    kept = f"filter(_all, w -> w NOT IN ({listed}))" if stop else "_all"
    return (
        df.select(key, text)
        .repartition(text_tasks(df, text), F.col(key))
        .select(key, F.expr(f"regexp_extract_all(lower({text}), r'{TOKEN}', 0)").alias("_all"))
        .select(key, F.expr(kept).alias("_w"))
        .select(
            key,
            F.explode_outer(
                F.expr(
                    "concat(_w, zip_with(slice(_w, 1, greatest(size(_w) - 1, 0)), "
                    "slice(_w, 2, greatest(size(_w) - 1, 0)), (a, b) -> concat(a, ' ', b)))"
                )
            ).alias("term"),
        )
    )


def term_counts(tokens: DataFrame, key: str) -> DataFrame:
    return tokens.groupBy(key, "term").agg(F.count("term").alias("tf"))


def vocabulary(counts: DataFrame, texts: DataFrame, max_features: int = MAX_FEATURES) -> DataFrame:
    """The most frequent terms with their smoothed inverse document frequency. At most ``max_features`` rows."""
    n = texts.agg(F.count(F.lit(1))).scalar()
    terms = counts.where("term IS NOT NULL").groupBy("term").agg(
        F.sum("tf").alias("corpus_tf"), F.count(F.lit(1)).alias("df")
    )
    top = terms.orderBy(F.col("corpus_tf").desc(), F.col("term").asc()).limit(max_features)
    idf = F.log((F.lit(1.0) + n) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    return top.withColumn("idf", idf)


def tfidf(
    df: DataFrame, key: str, text: str, stop_words: list[str] | None = None, max_features: int = MAX_FEATURES
) -> DataFrame:
    """Weight of every vocabulary term in every text, each text scaled to length 1."""
    counts = term_counts(tokenize(df, key, text, stop_words), key)
    known = F.broadcast(vocabulary(counts, df, max_features).select("term", "idf"))
    weighted = counts.join(known, "term").withColumn("_w", F.col("tf") * F.col("idf"))
    # One text has at most max_features rows here.
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(key)))
    return weighted.select(key, "term", "tf", (F.col("_w") / norm).alias("weight"))


def score_texts(
    df: DataFrame,
    key: str,
    text: str,
    question: str,
    stop_words: list[str] | None = None,
    max_features: int = MAX_FEATURES,
) -> DataFrame:
    """Cosine of the question with every text; 0 for a text that shares no term with it."""
    counts = term_counts(tokenize(df, key, text, stop_words), key)
    asked = df.sparkSession.createDataFrame([(0, question)], "q int, question string")
    asked_counts = term_counts(tokenize(asked, "q", "question", stop_words), "q").select(
        "term", F.col("tf").alias("_qtf")
    )
    known = vocabulary(counts, df, max_features).select("term", "idf")
    known = known.join(F.broadcast(asked_counts), "term", "left").withColumn(
        "_q", F.coalesce(F.col("_qtf"), F.lit(0)) * F.col("idf")
    )
    # At most max_features rows, so one task may see them all and the result may be broadcast.
    length = F.sqrt(F.sum(F.col("_q") * F.col("_q")).over(Window.partitionBy(F.lit(0))))
    known = known.withColumn("_qlen", length).drop("_qtf")
    weighted = counts.join(F.broadcast(known), "term", "left").withColumn("_w", F.col("tf") * F.col("idf"))
    sums = weighted.groupBy(key).agg(
        F.sum(F.col("_w") * F.col("_q")).alias("_dot"),
        F.sqrt(F.sum(F.col("_w") * F.col("_w"))).alias("_len"),
        F.max("_qlen").alias("_qlen"),
    )
    cosine = F.col("_dot") / F.nullif(F.col("_len") * F.col("_qlen"), F.lit(0.0))
    return sums.select(key, F.coalesce(cosine, F.lit(0.0)).alias("score"))


def retrieve(
    df: DataFrame,
    key: str,
    text: str,
    question: str,
    k: int = 8,
    stop_words: list[str] | None = None,
    max_features: int = MAX_FEATURES,
    digits: int = 9,
) -> DataFrame:
    """The ``k`` texts closest to the question; with no match at all, the first ``k`` by key.

    Scores are rounded before ranking, so that texts of equal weight fall back to key order.
    """
    scored = score_texts(df, key, text, question, stop_words, max_features)
    scored = scored.withColumn("score", F.round("score", digits))
    top = scored.orderBy(F.col("score").desc(), F.col(key).asc()).limit(k)
    return df.join(F.broadcast(top), key).orderBy(F.col("score").desc(), F.col(key).asc())


def context(retrieved: DataFrame, key: str) -> DataFrame:
    """The retrieved texts as numbered lines in one text. The input has k rows."""
    rank = F.row_number().over(Window.orderBy(F.col("score").desc(), F.col(key).asc()))
    line = F.concat(F.lit("["), F.col("n").cast("string"), F.lit("] source="), "source", F.lit(" | "), "text")
    numbered = retrieved.withColumn("n", rank).select(F.struct("n", line.alias("line")).alias("entry"))
    lines = F.transform(F.array_sort(F.collect_list("entry")), lambda entry: entry["line"])
    return numbered.agg(F.array_join(lines, "\n").alias("context"))


# ---------------------------------------------------------------- chunks

# Fixed formats: name in the text, column.
_REASON = [
    ("Condition", "Condition"),
    ("total_admissions", "total_admissions"),
    ("readmissions_under_30_days", "readmissions_under_30_days"),
    ("readmission_30d_rate_pct", "readmission_30d_rate_pct"),
    ("avg_lace_score", "avg_lace_score"),
    ("avg_los", "avg_los"),
]
_DRIVER = [
    ("lace_band", "lace_band"),
    ("patients", "patients"),
    ("readmission_30d_count", "readmission_30d_count"),
    ("readmission_30d_rate_pct", "readmission_30d_rate_pct"),
    ("avg_los", "avg_los"),
    ("avg_chronic_conditions", "avg_chronic_conditions"),
]
_FEATURE = [("model_feature", "feature"), ("importance", "importance")]
_METRICS = [(name, name) for name in "roc_auc pr_auc accuracy precision recall f1 selected_model tn fp fn tp".split()]

_SECTION = 100_000


def _pairs(fields: list[tuple[str, str]]) -> Column:
    texts = [
        F.concat(F.lit(f"{name}="), F.coalesce(F.col(column).cast("string"), F.lit("None"))) for name, column in fields
    ]
    return F.concat_ws(" ", *texts)


def _numbered(df: DataFrame, section: int, text: Column, source: str, *order: Column) -> DataFrame:
    """Chunks of one section. ``df`` is limited to a few hundred rows before it comes here."""
    rank = F.row_number().over(Window.orderBy(*order))
    return df.select(
        (F.lit(section * _SECTION) + rank).cast("long").alias("chunk_id"), text.alias("text"), F.lit(source).alias("source")
    )


def reason_chunks(reason: DataFrame, n: int = 300) -> DataFrame:
    order = (F.col("readmissions_under_30_days").desc(), F.col("Condition").asc())
    return _numbered(reason.orderBy(*order).limit(n), 1, _pairs(_REASON), "readmission_reason_summary.csv", *order)


def driver_chunks(driver: DataFrame) -> DataFrame:
    order = F.expr("array_position(array('0-5', '6-10', '11-15', '16+'), lace_band)")
    return _numbered(driver, 2, _pairs(_DRIVER), "readmission_driver_summary.csv", order)


def importance_chunks(importance: DataFrame, n: int = 80) -> DataFrame:
    order = (F.col("importance").desc(), F.col("feature").asc())
    top = importance.orderBy(*order).limit(n)
    return _numbered(top, 3, _pairs(_FEATURE), "readmission_feature_importance.csv", *order)


def metrics_chunk(metrics: DataFrame) -> DataFrame:
    """``metrics`` has one row."""
    text = F.concat(F.lit("model_metrics "), _pairs(_METRICS))
    return _numbered(metrics.limit(1), 4, text, "readmission_model_metrics.json", F.lit(0))


def dataset_chunk(model: DataFrame) -> DataFrame:
    rate = positive_rate(model)
    text = F.format_string("dataset_rows=%d target_positive_rate_pct=%.2f", "rows", "target_positive_rate_pct")
    return _numbered(rate, 5, text, "readmission_model_dataset.csv", F.lit(0))


def condition_chunks(model: DataFrame, n: int = 40) -> DataFrame:
    rates = model.groupBy("Condition").agg((F.avg(S.TARGET) * F.lit(100.0)).alias("rate"))
    order = (F.col("rate").desc(), F.col("Condition").asc())
    text = F.format_string("condition_rate Condition=%s readmission_30d_rate_pct=%.2f", "Condition", "rate")
    return _numbered(rates.orderBy(*order).limit(n), 6, text, "readmission_model_dataset.csv", *order)


def render_chunks(
    spark,
    reason: DataFrame | None = None,
    driver: DataFrame | None = None,
    importance: DataFrame | None = None,
    metrics: DataFrame | None = None,
    model: DataFrame | None = None,
) -> DataFrame:
    """All chunks of the tables that exist; a single note when none does."""
    parts = []
    if reason is not None:
        parts.append(reason_chunks(reason))
    if driver is not None:
        parts.append(driver_chunks(driver))
    if importance is not None:
        parts.append(importance_chunks(importance))
    if metrics is not None:
        parts.append(metrics_chunk(metrics))
    if model is not None:
        if S.TARGET in model.columns:
            parts.append(dataset_chunk(model))
            if "Condition" in model.columns:
                parts.append(condition_chunks(model))
    if not parts:
        note = [(0, "No analytics files were found in Data/final.", "system")]
        return spark.createDataFrame(note, "chunk_id long, text string, source string")
    return union_all(parts)
