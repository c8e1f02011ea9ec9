"""From raw documents to packed training sequences, stage by stage.

Each stage reads the documents that the one before kept and writes its own, so a
failure costs one stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sharelens.llm.common import stored
from sharelens.llm.exact_dedup import drop_exact_duplicates
from sharelens.llm.jaccard_join import drop_near_duplicates
from sharelens.llm.packing import pack
from sharelens.llm.toxicity import drop_toxic

SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 80


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are not predicted to be toxic."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return drop_exact_duplicates(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by near equality, the one with the smallest id."""
    return drop_near_duplicates(docs, SHINGLE_WORDS, SIMILARITY_PERCENT)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, with their places in sequences."""
    tokenizer, ranks = (public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken"))
    return pack(docs, tokenizer, ranks)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("best_fit_packing", best_fit_packing),
]

ORACLE_SQL = None  # SQL can't train the toxicity classifier


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
