"""Corpus pipeline: from raw documents to packed training sequences.

``STAGES`` lists the stages in order. Each takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the
last return the columns of ``documents``. :func:`run` writes each stage's result as Parquet under the
session's shared checkpoint folder and the next stage reads it from there, so a lost executor never
costs more than the stage at hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txnscope.llm import jaccard, packing, pii, rules, suffix
from txnscope.llm.text import read_table, ship_code
from txnscope.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current rule policy keeps."""
    return rules.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates (five-word shingles, Jaccard similarity 0.8 or more)."""
    ship_code(spark)
    return jaccard.one_per_class(spark, docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that lie in 100 bytes seen earlier."""
    ship_code(spark)
    return suffix.without_repeats(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with their personal data replaced by the kind's name."""
    return pii.redacted(spark, docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenised texts and their places in training sequences."""
    import public_tokenizers

    ship_code(spark)
    return packing.pack(spark, docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("personal_data", personal_data),
    ("packed", packed),
]

#: SQL cannot express the stages (near-duplicate classes, tokenizers). Tests compare each stage's operator by brute
#: force; the chain itself is tested for its columns and rows only.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents`` after all stages."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
