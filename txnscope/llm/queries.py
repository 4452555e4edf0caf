"""The registered queries of the text operators, one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from txnscope.llm import (
    ballcodes,
    bpe,
    centroids,
    contamination,
    credentials,
    jaccard,
    neighbours,
    packing,
    pii,
    quality,
    rules,
    suffix,
    wordpiece,
)
from txnscope.llm.text import read_table


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(spark, read_table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = wordpiece.sentencepiece_vocabulary(_vocabulary("piece_bpe_32k.model"))
    return wordpiece.token_counts(spark, read_table(spark, sf_dir, "documents"), *pieces)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.secrets(spark, read_table(spark, sf_dir, "documents"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(spark, read_table(spark, sf_dir, "documents"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(spark, read_table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.verdicts(read_table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.repeated_bytes(read_table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, read_table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"))


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(spark, read_table(spark, sf_dir, "embeddings"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(spark, read_table(spark, sf_dir, "embeddings"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contamination(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ballcodes.codes(spark, read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_bpe,
        op2_token_counts,
        op3_secrets,
        op4_ngram_jaccard,
        op5_personal_data,
        op6_quality_rules,
        op7_quality_classifier,
        op8_suffix_dedup,
        op9_packing,
        op10_nearest_neighbours,
        op11_centroids,
        op12_decontamination,
        op13_vector_codes,
    )
}
