"""A stored inverted index over texts, and corpus statistics that follow changes of the texts.

The words of a text are counted inside its row, so no exchange carries a text. A key must be unique;
rows without a key are left out. A text that is null or holds no term has no postings; it can still be named
where a question finds fewer than ``k`` texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from visitmart.operators.retrieval import MAX_FEATURES, TOKEN, default_stop_words
from visitmart.session import materialise
from visitmart.sources.paths import exists

BLOCK_TEXTS = 128  # texts of one block, about
BUCKETS = 32  # folders of postings


def term_frequencies(df: DataFrame, key: str, text: str, stop_words: list[str] | None = None) -> DataFrame:
    """Rows (key, term, tf): every token and pair of neighbouring tokens of a text, stop words taken out first.

    The terms of a row are sorted and the lengths of their runs taken, without a shuffle.
    """
    stop = default_stop_words() if stop_words is None else stop_words
    listed = ", ".join("'" + word.replace("'", "\\'") + "'" for word in stop)
    kept = f"filter(_all, w -> w NOT IN ({listed}))" if stop else "_all"
    pairs = (
        "zip_with(slice(_w, 1, greatest(size(_w) - 1, 0)), slice(_w, 2, greatest(size(_w) - 1, 0)), "
        "(a, b) -> concat(a, ' ', b))"
    )
    return (
        df.where(F.col(key).isNotNull())
        .select(key, F.expr(f"regexp_extract_all(lower({text}), r'{TOKEN}', 0)").alias("_all"))
        .select(key, F.expr(kept).alias("_w"))
        .where("size(_w) > 0")
        .select(key, F.expr(f"sort_array(concat(_w, {pairs}))").alias("_s"))
        .select(key, "_s", F.expr("filter(sequence(0, size(_s) - 1), i -> i = 0 OR _s[i] != get(_s, i - 1))").alias("_b"))
        .select(
            key,
            F.expr(
                "inline(zip_with(_b, concat(slice(_b, 2, size(_b)), array(size(_s))), "
                "(a, b) -> named_struct('term', _s[a], 'tf', CAST(b - a AS BIGINT))))"
            ),
        )
    )


# ---------------------------------------------------------------- corpus statistics


def corpus_statistics(frequencies: DataFrame) -> DataFrame:
    """Rows (term, corpus_tf, df): occurrences in all texts, and texts holding the term."""
    return frequencies.groupBy("term").agg(F.sum("tf").alias("corpus_tf"), F.count(F.lit(1)).alias("df"))


def changed_statistics(stored: DataFrame, removed: DataFrame, added: DataFrame) -> DataFrame:
    """Stored statistics after a change, from the term frequencies of the texts taken out and put in.

    An altered text is in both, in its old and its new form. Only the changed texts are read.
    """
    leaving = corpus_statistics(removed).select("term", (-F.col("corpus_tf")).alias("corpus_tf"), (-F.col("df")).alias("df"))
    every = stored.unionByName(leaving).unionByName(corpus_statistics(added))
    sums = every.groupBy("term").agg(F.sum("corpus_tf").alias("corpus_tf"), F.sum("df").alias("df"))
    return sums.where("df > 0")


def top_terms(statistics: DataFrame, n_texts: int, max_features: int = MAX_FEATURES) -> DataFrame:
    """The most frequent terms with their smoothed inverse document frequency. At most ``max_features`` rows."""
    top = statistics.orderBy(F.col("corpus_tf").desc(), F.col("term").asc()).limit(max_features)
    return top.withColumn("idf", F.log(F.lit(1.0 + n_texts) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0))


# ---------------------------------------------------------------- index


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int")


def build_index(
    df: DataFrame,
    key: str,
    text: str,
    folder: str,
    stop_words: list[str] | None = None,
    max_features: int = MAX_FEATURES,
    block_texts: int = BLOCK_TEXTS,
    buckets: int = BUCKETS,
) -> None:
    """Write the index of ``df`` below ``folder``: ``frequencies``, ``texts``, ``terms``, ``postings``, ``blocks``, ``about``.

    Postings lie in folders by hash of their term and hold the weight of the term in the text, each text scaled
    to length 1. Texts are spread over blocks by hash of the key, and ``blocks`` holds the greatest weight of every term in
    every block. ``about`` is written last: a folder without it is no index, and building again replaces what is there.
    """
    spark = df.sparkSession
    stop = default_stop_words() if stop_words is None else stop_words

    def put(rows: DataFrame, name: str, *parts: str) -> DataFrame:
        writer = rows.write.mode("overwrite")
        (writer.partitionBy(*parts) if parts else writer).parquet(f"{folder}/{name}")
        # An empty table in folders of partitions holds no file to take the schema from.
        return spark.read.schema(rows.schema).parquet(f"{folder}/{name}")

    frequencies = put(term_frequencies(df, key, text, stop), "frequencies")
    n_texts = put(df.where(F.col(key).isNotNull()).select(key), "texts").count()
    terms = put(top_terms(corpus_statistics(frequencies), n_texts, max_features), "terms")
    n_blocks = max(1, -(-n_texts // block_texts))

    # At most max_features rows of one word or pair and a number.
    known = F.broadcast(terms.select("term", "idf"))
    weighted = frequencies.join(known, "term").select(key, "term", (F.col("tf") * F.col("idf")).alias("_w"))
    lengths = weighted.groupBy(key).agg(F.sqrt(F.sum(F.col("_w") * F.col("_w"))).alias("_len"))
    rows = weighted.join(lengths, key).select(
        _bucket(buckets).alias("bucket"),
        "term",
        F.pmod(F.xxhash64(key), F.lit(n_blocks)).alias("block"),
        key,
        (F.col("_w") / F.col("_len")).alias("weight"),
    )
    # The hint splits a bucket of frequent terms over several tasks and files.
    postings = put(rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", "term", "block"), "postings", "bucket")
    greatest = postings.groupBy("bucket", "term", "block").agg(F.max("weight").alias("greatest"))
    put(greatest.hint("rebalance", "bucket").sortWithinPartitions("bucket", "term", "block"), "blocks", "bucket")
    about = [(key, n_texts, buckets, stop)]
    put(spark.createDataFrame(about, "key string, n_texts long, buckets int, stop_words array<string>").coalesce(1), "about")


def question_terms(spark: SparkSession, folder: str, questions: DataFrame) -> DataFrame:
    """Rows (question_id, bucket, term, share): the indexed terms of the questions, each question scaled to length 1."""
    about = spark.read.parquet(f"{folder}/about").first()
    found = term_frequencies(questions, "question_id", "question", about["stop_words"])
    weighted = found.join(spark.read.parquet(f"{folder}/terms").select("term", "idf"), "term").withColumn(
        "_q", F.col("tf") * F.col("idf")
    )
    # One question has at most max_features rows here.
    length = F.sqrt(F.sum(F.col("_q") * F.col("_q")).over(Window.partitionBy("question_id")))
    return weighted.select("question_id", _bucket(about["buckets"]).alias("bucket"), "term", (F.col("_q") / length).alias("share"))


def block_bounds(spark: SparkSession, folder: str, asked: DataFrame) -> DataFrame:
    """Rows (question_id, block, bound): no text of the block is closer to the question than the bound."""
    blocks = spark.read.schema("bucket int, term string, block long, greatest double").parquet(f"{folder}/blocks")
    return (
        asked.join(blocks, ["bucket", "term"])
        .groupBy("question_id", "block")
        .agg(F.sum(F.col("share") * F.col("greatest")).alias("bound"))
    )


def score_blocks(spark: SparkSession, folder: str, asked: DataFrame, chosen: DataFrame, key: str, digits: int) -> DataFrame:
    """Rows (question_id, key, score) of the texts in the chosen (question_id, block) that share a term."""
    kind = spark.read.parquet(f"{folder}/texts").schema[key].dataType.simpleString()
    schema = f"bucket int, term string, block long, `{key}` {kind}, weight double"
    postings = spark.read.schema(schema).parquet(f"{folder}/postings")
    return (
        asked.join(postings, ["bucket", "term"])
        .join(chosen.select("question_id", "block"), ["question_id", "block"])
        .groupBy("question_id", key)
        .agg(F.round(F.sum(F.col("share") * F.col("weight")), digits).alias("score"))
        .where("score > 0")
    )


def retrieve_many(spark: SparkSession, folder: str, questions: DataFrame, k: int = 8, digits: int = 9) -> DataFrame:
    """For every question of (question_id, question) its ``k`` closest texts: question_id, rank, key, score.

    Scores are cosines rounded to ``digits``; ties go to the smaller key, and texts of score 0 follow by key, as
    :func:`visitmart.operators.retrieval.retrieve` gives them question by question. All questions are answered by the same joins,
    which read no text: the ``k`` blocks of greatest bound give the k-th best score so far, and only blocks whose bound
    reaches it are scored. Question ids must be unique; without texts there are no rows.
    """
    if not exists(spark, f"{folder}/about"):
        raise FileNotFoundError(f"no complete index: {folder}")
    key = spark.read.parquet(f"{folder}/about").first()["key"]
    # Read several times below, so each is worked out once.
    asked = materialise(question_terms(spark, folder, questions))
    bounds = materialise(block_bounds(spark, folder, asked))

    def best(rows: DataFrame, n: int, *order: Column) -> DataFrame:
        ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("question_id").orderBy(*order)))
        return ranked.where(F.col("rank") <= n)

    by_score = (F.col("score").desc(), F.col(key).asc())
    first_blocks = best(bounds, k, F.col("bound").desc(), F.col("block").asc())
    seen = best(score_blocks(spark, folder, asked, first_blocks, key, digits), k, *by_score)
    least = seen.where(F.col("rank") == k).select("question_id", F.col("score").alias("_least"))
    slack = F.lit(10.0**-digits)  # more than rounding can lift a score
    open_blocks = bounds.join(least, "question_id", "left").where(F.expr("_least IS NULL") | (F.col("bound") + slack >= F.col("_least")))
    found = best(score_blocks(spark, folder, asked, open_blocks, key, digits), k, *by_score).drop("rank")

    # Of the 2 k smallest keys at least k are none of the k found ones.
    smallest = [row[0] for row in spark.read.parquet(f"{folder}/texts").orderBy(key).limit(2 * k).collect()]
    if not smallest:
        return best(found, k, *by_score).select("question_id", "rank", key, "score")
    listed = F.explode(F.array(*[F.lit(value) for value in smallest])).alias(key)
    others = questions.select("question_id", listed).join(found, ["question_id", key], "left_anti")
    every = found.unionByName(others.withColumn("score", F.lit(0.0)))
    return best(every, k, *by_score).select("question_id", "rank", key, "score")
