"""Queries on tokens, TF-IDF weights, retrieval and evidence chunks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from visitmart.operators import evaluation as E
from visitmart.operators import final
from visitmart.operators import retrieval as R
from visitmart.operators import text_index as X
from visitmart.plans import model_queries  # noqa: F401  (its SQL is used again here)
from visitmart.plans import oracle as O
from visitmart.plans import visits as V
from visitmart.plans.gold_queries import DRIVER_SQL, REASON_SQL
from visitmart.plans.registry import SQL, query, rounded
from visitmart.session import materialise, shared_dir, stored

STOP = "the of and to in is it that this for with on as by an at be from or are was".split()
QUESTION = "Where were the worthless onstable things with relation and the condition of thenti"
VOCABULARY = 20_000

_LISTED = ", ".join(f"'{word}'" for word in STOP)


def _tokens_sql(source: str, key: str, text: str) -> str:
    """CTEs ``words`` and ``terms`` (key, term) of a table."""
    return f"""words_{source} AS (SELECT {key} AS k, list_filter(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}_]{{2,}}'),
      lambda w: w NOT IN ({_LISTED})) AS w FROM {source}),
    terms_{source} AS (SELECT k, unnest(w) AS term FROM words_{source} UNION ALL
      SELECT k, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i+1])) AS term FROM words_{source}),
    tf_{source} AS (SELECT k, term, count(*) AS tf FROM terms_{source} GROUP BY k, term)"""


def _vocabulary_sql(source: str) -> str:
    return f"""vocab AS (SELECT term, corpus_tf, df, ln((1e0 + (SELECT count(*) FROM {source})) / (1e0 + df)) + 1e0 AS idf
      FROM (SELECT term, sum(tf)::BIGINT AS corpus_tf, count(*) AS df FROM tf_{source} GROUP BY term)
      ORDER BY corpus_tf DESC, term LIMIT {VOCABULARY})"""


_DOCS = f"WITH {_tokens_sql('documents', 'doc_id', 'text')}, {_vocabulary_sql('documents')}"


@query("tokens", f"WITH {_tokens_sql('documents', 'doc_id', 'text')} SELECT k AS doc_id, count(*) AS terms, "
       "count(DISTINCT term) AS distinct_terms, sum(length(term))::BIGINT AS characters FROM terms_documents GROUP BY k")
def tokens(spark, sf_dir):
    found = R.tokenize(V.table(spark, sf_dir, "documents"), "doc_id", "text", STOP).where("term IS NOT NULL")
    per_term = found.groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("n"))
    return per_term.groupBy("doc_id").agg(
        F.sum("n").alias("terms"),
        F.count("term").alias("distinct_terms"),
        F.sum(F.col("n") * F.length("term")).alias("characters"),
    )


@query("vocabulary", f"{_DOCS} SELECT term, corpus_tf, df, {O.r('idf')} AS idf FROM vocab")
def vocabulary(spark, sf_dir):
    documents = V.table(spark, sf_dir, "documents")
    counts = R.term_counts(R.tokenize(documents, "doc_id", "text", STOP), "doc_id")
    return rounded(R.vocabulary(counts, documents, VOCABULARY))


@query(
    "tfidf_weights",
    f"""{_DOCS}, w AS (SELECT k, term, tf, tf * idf AS w FROM tf_documents JOIN vocab USING (term))
    SELECT k AS doc_id, term, tf, {O.r('w / sqrt(sum(w*w) OVER (PARTITION BY k))')} AS weight FROM w""",
)
def tfidf_weights(spark, sf_dir):
    return rounded(R.tfidf(V.table(spark, sf_dir, "documents"), "doc_id", "text", STOP, VOCABULARY))


def _retrieve_sql(source: str, key: str, question: str, k: int, show: str) -> str:
    quoted = question.replace("'", "''")
    return f""", question AS (SELECT 0 AS q, '{quoted}' AS question), {_tokens_sql('question', 'q', 'question')},
    known AS (SELECT v.term, v.idf, coalesce(q.tf,0) * v.idf AS q FROM vocab v LEFT JOIN tf_question q USING (term)),
    dots AS (SELECT k, sum(t.tf*idf*q) AS dot, sqrt(sum((t.tf*idf)*(t.tf*idf))) AS len FROM tf_{source} t
      JOIN known USING (term) GROUP BY k),
    scores AS (SELECT {key} AS k, round(coalesce(dot / nullif(len * (SELECT sqrt(sum(q*q)) FROM known), 0e0), 0e0), 9) AS score
      FROM {source} LEFT JOIN dots ON {key} = k),
    top AS (SELECT k, score, row_number() OVER (ORDER BY score DESC, k) AS n FROM scores ORDER BY score DESC, k LIMIT {k})
    SELECT {show} FROM top JOIN {source} ON {key} = k"""


@query(
    "retrieve_documents",
    _DOCS + _retrieve_sql("documents", "doc_id", QUESTION, 8, "doc_id, source, text, score"),
)
def retrieve_documents(spark, sf_dir):
    documents = V.table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return R.retrieve(documents, "doc_id", "text", QUESTION, 8, STOP, VOCABULARY)


@query(
    "retrieve_without_match",
    _DOCS + _retrieve_sql("documents", "doc_id", "zzqqxx", 5, "doc_id, score"),
)
def retrieve_without_match(spark, sf_dir):
    documents = V.table(spark, sf_dir, "documents").select("doc_id", "text")
    return R.retrieve(documents, "doc_id", "text", "zzqqxx", 5, STOP, VOCABULARY).select("doc_id", "score")


@query(
    "retrieve_many",
    f"""{_DOCS}, questions AS (SELECT item_id, text FROM benchmark), {_tokens_sql('questions', 'item_id', 'text')},
    asked AS (SELECT k AS q, term, tf * idf AS q_w FROM tf_questions JOIN vocab USING (term)),
    asked_len AS (SELECT q, sqrt(sum(q_w * q_w)) AS q_len FROM asked GROUP BY q),
    weighted AS (SELECT k, term, tf * idf AS w FROM tf_documents JOIN vocab USING (term)),
    lens AS (SELECT k, sqrt(sum(w * w)) AS len FROM weighted GROUP BY k),
    dots AS (SELECT q, k, sum(w * q_w) AS dot FROM weighted JOIN asked USING (term) GROUP BY q, k),
    cosines AS (SELECT q, k, dot / (len * q_len) AS c FROM dots JOIN lens USING (k) JOIN asked_len USING (q)),
    scores AS (SELECT item_id AS question_id, doc_id, coalesce(round(c, 9), 0e0) AS score FROM benchmark CROSS JOIN documents
      LEFT JOIN cosines ON q = item_id AND k = doc_id)
    SELECT question_id, rank::INTEGER AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY question_id
      ORDER BY score DESC, doc_id) AS rank FROM scores) WHERE rank <= 8""",
)
def retrieve_many(spark, sf_dir):
    """The benchmark's items as questions on an index of all documents."""
    folder = f"{shared_dir(spark)}/text-index-{uuid.uuid4().hex}"
    X.build_index(V.table(spark, sf_dir, "documents"), "doc_id", "text", folder, STOP, VOCABULARY)
    items = V.table(spark, sf_dir, "benchmark").selectExpr("item_id AS question_id", "text AS question")
    return X.retrieve_many(spark, folder, items)


@query("vocabulary_after_change", f"{_DOCS} SELECT term, corpus_tf, df, {O.r('idf')} AS idf FROM vocab")
def vocabulary_after_change(spark, sf_dir):
    """The vocabulary of all documents from the statistics of an earlier state of them.

    At that time the benchmark's items were in the corpus, documents of the first source were not, and English ones ended
    in another word.
    """
    documents = V.table(spark, sf_dir, "documents")
    first = documents.agg(F.min("source")).scalar()
    fresh = F.col("source").eqNullSafe(first)
    altered = F.col("lang").eqNullSafe("en") & ~fresh
    earlier = documents.where(~fresh).withColumn("text", F.when(altered, F.concat("text", F.lit(" draft"))).otherwise(F.col("text")))
    items = V.table(spark, sf_dir, "benchmark").selectExpr("item_id AS doc_id", "text")

    def counted(rows):
        return X.term_frequencies(rows, "doc_id", "text", STOP)

    stored = materialise(X.corpus_statistics(counted(earlier.select("doc_id", "text").unionAll(items))))
    gone = counted(earlier.where(altered).select("doc_id", "text").unionAll(items))
    statistics = X.changed_statistics(stored, gone, counted(documents.where(fresh | altered)))
    return rounded(X.top_terms(statistics, documents.count(), VOCABULARY))


_CHUNKS = f"""{O.MODEL}, {REASON_SQL}, {DRIVER_SQL},
  reason6 AS (SELECT * REPLACE ({O.r('avg_lace_score', 6)} AS avg_lace_score, {O.r('avg_los', 6)} AS avg_los) FROM reason),
  driver6 AS (SELECT * REPLACE ({O.r('avg_chronic_conditions', 6)} AS avg_chronic_conditions, {O.r('avg_los', 6)} AS avg_los)
    FROM driver),
  chunks AS (
    SELECT (100000 + row_number() OVER (ORDER BY readmissions_under_30_days DESC, Condition))::BIGINT AS chunk_id,
      'Condition=' || Condition || ' total_admissions=' || total_admissions || ' readmissions_under_30_days=' ||
      readmissions_under_30_days || ' readmission_30d_rate_pct=' || readmission_30d_rate_pct || ' avg_lace_score=' ||
      avg_lace_score || ' avg_los=' || avg_los AS text, 'readmission_reason_summary.csv' AS source
    FROM (SELECT * FROM reason6 ORDER BY readmissions_under_30_days DESC, Condition LIMIT 300)
    UNION ALL SELECT 200000 + list_position(['0-5','6-10','11-15','16+'], lace_band), 'lace_band=' || lace_band || ' patients='
      || patients || ' readmission_30d_count=' || readmission_30d_count || ' readmission_30d_rate_pct=' ||
      readmission_30d_rate_pct || ' avg_los=' || avg_los || ' avg_chronic_conditions=' || avg_chronic_conditions,
      'readmission_driver_summary.csv' FROM driver6
    UNION ALL SELECT 500001, 'dataset_rows=' || count(*) || ' target_positive_rate_pct=' ||
      printf('%.2f', avg(readmitted_under_30_days)*100e0), 'readmission_model_dataset.csv' FROM model
    UNION ALL SELECT 600000 + row_number() OVER (ORDER BY rate DESC, Condition), 'condition_rate Condition=' || Condition ||
      ' readmission_30d_rate_pct=' || printf('%.2f', rate), 'readmission_model_dataset.csv'
      FROM (SELECT Condition, avg(readmitted_under_30_days)*100e0 AS rate FROM model GROUP BY Condition
        ORDER BY rate DESC, Condition LIMIT 40))"""


def _chunks(spark, sf_dir):
    model = stored(V.model(spark, sf_dir))  # read once for each kind of chunk
    return R.render_chunks(
        spark,
        reason=rounded(final.reason_summary(model), 6),
        driver=rounded(final.driver_summary(model), 6),
        model=model,
    )


@query("evidence_chunks", f"{_CHUNKS} SELECT * FROM chunks")
def evidence_chunks(spark, sf_dir):
    return _chunks(spark, sf_dir)


@query(
    "metrics_chunk",
    f"""SELECT 400001::BIGINT AS chunk_id, 'readmission_model_metrics.json' AS source, 'model_metrics' || ' roc_auc=' || round(roc_auc, 6)
      || ' pr_auc=' || round(average_precision, 6) || ' accuracy=' || round(accuracy, 6) || ' precision=' || round(precision, 6)
      || ' recall=' || round(recall, 6) || ' f1=' || round(f1, 6) || ' selected_model=score tn=' || tn || ' fp=' || fp
      || ' fn=' || fn || ' tp=' || tp AS text FROM ({SQL["ranking_quality"]}), ({SQL["classification_metrics"]})""",
)
def metrics_chunk(spark, sf_dir):
    """The chunk on metrics, of the derived score at 0.45 over all visits."""
    scored = V.scored(spark, sf_dir)
    ranking = rounded(E.ranking_quality(E.score_curve(scored)), 6)
    at = rounded(E.classification_metrics(scored, 0.45), 6)
    one = ranking.withColumn("one", F.lit(1)).join(at.withColumn("one", F.lit(1)), "one")
    named = one.withColumns({"pr_auc": F.col("average_precision"), "selected_model": F.lit("score")})
    return R.render_chunks(spark, metrics=named)


_ASK = "Which lace_band has the highest readmission_30d_rate_pct for Brand#11 patients"


def _top_chunks(spark, sf_dir):
    # A few hundred chunks, read several times: written once.
    return R.retrieve(materialise(_chunks(spark, sf_dir)), "chunk_id", "text", _ASK, 6, STOP, VOCABULARY)


_RANKED = f"{_CHUNKS}, {_tokens_sql('chunks', 'chunk_id', 'text')}, {_vocabulary_sql('chunks')}"


@query("retrieve_chunks", _RANKED + _retrieve_sql("chunks", "chunk_id", _ASK, 6, "chunk_id, source, text, score"))
def retrieve_chunks(spark, sf_dir):
    return _top_chunks(spark, sf_dir)


@query(
    "evidence_context",
    _RANKED
    + _retrieve_sql(
        "chunks", "chunk_id", _ASK, 6,
        "string_agg('[' || n || '] source=' || source || ' | ' || text, chr(10) ORDER BY n) AS context",
    ),
)
def evidence_context(spark, sf_dir):
    return R.context(_top_chunks(spark, sf_dir), "chunk_id")
