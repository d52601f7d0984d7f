"""From raw ``documents`` to token ids, by operators of visitmart.llm.

``STAGES`` lists the stages in order. Each takes (spark, docs, sf_dir) and works on all rows its
predecessor kept; all but the last return the columns of ``documents``. ``run`` writes each stage's
rows as Parquet to the folder that all executors share and gives them to the next.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitmart.llm import bpe, decontaminate, fm, jaccard, pii
from visitmart.llm.shared import importable, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine scores at 0.3 or more; empty and null texts are scored like others."""
    labels = importable(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return fm.good_documents(docs, fm.train(docs, labels), threshold=0.3)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a Jaccard similarity of 0.8 or more; texts without words stay."""
    importable(spark)
    return jaccard.one_of_each_group(docs, n=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a verified overlap with a benchmark item; null and empty texts have none."""
    return decontaminate.clean_documents(docs, importable(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; null and empty texts stay as they are."""
    importable(spark)
    return pii.mask(docs, pii.train(docs))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids and whether the ids decode to the text's bytes (null text: empty)."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    importable(spark)
    coded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), path, public_tokenizers.PATTERN, offsets=False)
    coded = stored(coded, "coded")  # so that a task has one Python worker at a time, to encode or to decode
    back = bpe.decode(coded.withColumn("coded", F.col("ids")), path, "coded", "decoded")
    whole = F.col("decoded") == F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return back.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", whole.alias("whole"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("token_ids", token_ids),
]

#: No SQL: the first stage is a fitted model and the fourth a fitted field. tests/llm compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = importable(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
