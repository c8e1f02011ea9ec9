"""The operators on the test tables, by name."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sharelens.llm import (
    chat_format,
    embedding_dups,
    exact_dedup,
    html_extract,
    jaccard_join,
    merkle,
    nbest_pieces,
    packing,
    quality,
    ranked_search,
    sharding,
    token_counts,
    toxicity,
)
from sharelens.session import scratch_path

BYTE_TOKENIZER = [public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken")]
CHAT_SCHEMA = "conv_id long, turn long, role string, text string"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(_table(spark, sf_dir, "documents"), k=4, percent=85)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    cache = scratch_path(spark, "token_counts")
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), path, cache)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), *BYTE_TOKENIZER)


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_articles(_table(spark, sf_dir, "pages"))


def op7_sentencepiece_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return nbest_pieces.n_best_pieces(_table(spark, sf_dir, "documents"), path)


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dups.embedding_near_duplicates(_table(spark, sf_dir, "embeddings"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "</s>[INST] ok [/INST]"
    marks = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], CHAT_SCHEMA)
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.read_back(
        *chat_format.prefix_tree(rows.unionByName(marks), *BYTE_TOKENIZER), BYTE_TOKENIZER[0]
    )


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_manifest(_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_exact_dedup,
        op2_sharding,
        op3_ngram_jaccard_join,
        op4_token_counts,
        op5_best_fit_packing,
        op6_html_extraction,
        op7_sentencepiece_nbest,
        op8_embedding_near_dedup,
        op9_toxicity,
        op10_chat_format,
        op11_quality_classifier,
        op12_ranked_search,
        op13_merkle_manifest,
    )
}
