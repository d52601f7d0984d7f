"""The stored index against retrieval question by question, and statistics after changes against fresh ones."""

import re

import pytest
from pyspark.sql import functions as F

from visitmart.operators import retrieval as R
from visitmart.operators import text_index as X

TEXTS = [
    (1, "alpha beta gamma"), (2, "beta beta delta"), (3, None), (4, ""), (5, "alpha beta gamma"), (6, "the"),
    (7, "delta epsilon zeta eta theta"), (8, "Alpha, ALPHA; über_1"), (9, "zeta"), (None, "alpha"),
]
QUESTIONS = [(1, "alpha beta"), (2, "unknown words"), (3, ""), (4, None), (5, "zeta delta delta"), (6, "über_1 gamma"), (7, "alpha beta")]
SCHEMA = "id long, text string"


def asked(spark):
    return spark.createDataFrame(QUESTIONS, "question_id int, question string")


def answers(df):
    return {(r["question_id"], r["rank"]): (r["id"], round(r["score"], 9)) for r in df.collect()}


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_frequencies_equal_counted_tokens(spark):
    df = spark.createDataFrame(TEXTS, SCHEMA).where("id IS NOT NULL")
    want = R.term_counts(R.tokenize(df, "id", "text", ["the"]), "id").where("term IS NOT NULL")
    got = X.term_frequencies(df, "id", "text", ["the"])
    assert sorted(map(tuple, got.select("id", "term", "tf").collect())) == sorted(map(tuple, want.select("id", "term", "tf").collect()))


@pytest.fixture(scope="module")
def one_by_one(spark):
    """All texts by every question, asked singly."""
    known = spark.createDataFrame(TEXTS, SCHEMA).where("id IS NOT NULL")
    return {
        number: [(r["id"], round(r["score"], 9)) for r in R.retrieve(known, "id", "text", question or "", 20, ["the"]).collect()]
        for number, question in QUESTIONS
    }


@pytest.mark.parametrize("k, block_texts", [(1, 1), (3, 3), (20, 128)])
def test_index_answers_like_single_questions(spark, tmp_path, one_by_one, k, block_texts):
    X.build_index(spark.createDataFrame(TEXTS, SCHEMA), "id", "text", str(tmp_path), ["the"], block_texts=block_texts, buckets=4)
    got = answers(X.retrieve_many(spark, str(tmp_path), asked(spark), k))
    assert got == {(q, n + 1): row for q, ranked in one_by_one.items() for n, row in enumerate(ranked[:k])}


def test_empty_and_unfinished_index(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="index"):
        X.retrieve_many(spark, str(tmp_path), asked(spark))
    X.build_index(spark.createDataFrame([], SCHEMA), "id", "text", str(tmp_path))
    assert X.retrieve_many(spark, str(tmp_path), asked(spark)).count() == 0
    X.build_index(spark.createDataFrame(TEXTS, SCHEMA), "id", "text", str(tmp_path))  # building again replaces it
    assert X.retrieve_many(spark, str(tmp_path), asked(spark), 2).count() == 14


def test_far_blocks_are_not_scored(spark, tmp_path):
    rows = [(i, f"common word{i % 50}") for i in range(400)] + [(1000, "rare rare rare")]
    X.build_index(spark.createDataFrame(rows, SCHEMA), "id", "text", str(tmp_path), [], block_texts=4, buckets=4)
    questions = spark.createDataFrame([(1, "rare common")], "question_id int, question string")
    bounds = X.block_bounds(spark, str(tmp_path), X.question_terms(spark, str(tmp_path), questions))
    top = X.retrieve_many(spark, str(tmp_path), questions, 1).first()
    assert top["id"] == 1000
    assert bounds.where(F.col("bound") + 1e-9 >= top["score"]).count() < bounds.count() / 10


def test_statistics_follow_changes(spark):
    before = spark.createDataFrame([(1, "alpha beta"), (2, "beta"), (3, "gamma gamma")], SCHEMA)
    after = spark.createDataFrame([(1, "alpha delta"), (2, "beta"), (4, None), (5, "beta eta")], SCHEMA)

    def counted(df):
        return X.term_frequencies(df, "id", "text", [])

    stored = X.corpus_statistics(counted(before))
    got = X.changed_statistics(stored, counted(before.where("id <> 2")), counted(after.where("id <> 2")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, X.corpus_statistics(counted(after)).collect()))


def test_no_exchange_carries_a_text_and_retrieval_reads_none(spark, sf, tmp_path):
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    plan = physical(X.corpus_statistics(X.term_frequencies(documents, "doc_id", "text")))
    below = plan[plan.index("Exchange") :]
    assert plan.count("Exchange") == 1 and "partial_sum" in below and "regexp_extract_all" in below
    X.build_index(documents, "doc_id", "text", str(tmp_path))
    answer = X.retrieve_many(spark, str(tmp_path), documents.limit(8).selectExpr("doc_id AS question_id", "text AS question"))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", physical(answer))
    assert schemas and not any("text:" in s for s in schemas if "key" in s or "weight" in s or "greatest" in s)
    assert not re.search("Python|Cartesian|NestedLoop", physical(answer))


def test_texts_are_dealt_by_their_length(spark, monkeypatch):
    from visitmart.operators import retrieval as R

    rows = [(k, "one two three " * 40, k) for k in (1, 2, 3, 4, None, 4)] + [(5, None, 5)]
    df = spark.createDataFrame(rows, "id long, text string, more long")
    whole = R.term_counts(R.tokenize(df, "id", "text", []), "id")
    monkeypatch.setattr(R, "TASK_LETTERS", 300)
    assert R.text_tasks(df, "text") == 12 and R.tokenize(df, "id", "text", []).rdd.getNumPartitions() == 12
    parts = R.term_counts(R.tokenize(df, "id", "text", []), "id")
    assert sorted(map(str, whole.collect())) == sorted(map(str, parts.collect()))
    assert {r.tf for r in parts.where("id = 4 AND term = 'one two'").collect()} == {80}
    assert R.text_tasks(df.limit(0), "text") == 1
