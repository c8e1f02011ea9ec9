"""Token counts through a cache keyed by content and tokenizer version."""

from __future__ import annotations

import os

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sharelens.llm import pieces

LIMIT = 2048
CACHE_SCHEMA = "text_digest string, tokenizer_digest string, n_tokens long"


def read_cache(spark, cache_path: str) -> DataFrame:
    """The stored counts; an empty table if nothing is stored yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(cache_path)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return spark.createDataFrame([], CACHE_SCHEMA)
    return spark.read.schema(CACHE_SCHEMA).parquet(cache_path)


def encode_misses(misses: DataFrame, tokenizer_path: str, version: str) -> DataFrame:
    """``misses`` (``text_digest, _text``) counted, as rows of the cache."""

    def run(batches):
        count = pieces.counter(tokenizer_path)
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            counts = []
            for a, b in pieces.text_groups(texts):
                counts += count(texts[a:b])
            yield pa.RecordBatch.from_arrays(
                [batch.column("text_digest"), pa.array([version] * len(texts)), pa.array(counts, pa.int64())],
                names=["text_digest", "tokenizer_digest", "n_tokens"],
            )

    return misses.mapInArrow(run, CACHE_SCHEMA)


def token_counts(
    docs: DataFrame,
    tokenizer_path: str,
    cache_path: str,
    limit: int = LIMIT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Each row of ``docs`` with the number of its tokens.

    Returns ``doc_id, n_bytes, n_tokens, over_limit``.  The cache at ``cache_path``
    holds counts by digest of the content and of the tokenizer's file; texts that it
    lacks are encoded once each, however many rows have them, and appended.  A call
    that is repeated after a failure finds what was appended.  Content is taken as it
    is: the normal form of a text is the text itself, with NULL as empty, because the
    tokenizer may tell any two texts apart.

    The tokenizer must drop white space between words, as ``word_bpe_49k.json`` does.
    No special tokens are added, nothing is cut; special strings inside a text count
    as the library takes them.  Repeated rows and NULL ids are rows like others;
    other columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    version = pieces.file_digest(os.fspath(tokenizer_path))
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.sha2(text, 256).alias("text_digest"), text.alias("_text"))
    known = read_cache(spark, cache_path).where(F.col("tokenizer_digest") == version)
    distinct = keyed.groupBy("text_digest").agg(F.first("_text").alias("_text"))
    misses = distinct.join(known.select("text_digest"), "text_digest", "left_anti")
    encode_misses(misses, tokenizer_path, version).write.mode("append").parquet(cache_path)

    counts = (
        read_cache(spark, cache_path)
        .where(F.col("tokenizer_digest") == version)
        .groupBy("text_digest")
        .agg(F.max("n_tokens").alias("n_tokens"))
    )
    slim = docs.select(
        F.col(id_col).alias("doc_id"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.sha2(text, 256).alias("text_digest"),
    )
    return slim.join(counts, "text_digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


