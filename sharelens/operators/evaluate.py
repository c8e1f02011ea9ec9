"""Ranking metrics over candidate lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _rank_of_truth(candidates: DataFrame, truth: DataFrame, k: int) -> DataFrame:
    """``rank`` of each query's true voter in its list, 0 if not among the first ``k``."""
    joined = truth.select("triple_id", "voter_id").join(candidates, "triple_id", "left")
    listed = F.slice("candidate_voter_list", 1, k)
    place = F.array_position(listed, F.col("voter_id").cast("string"))
    return joined.select(F.coalesce(place, F.lit(0)).alias("rank"))


def _reciprocal() -> Column:
    return F.when(F.col("rank") > 0, 1.0 / F.col("rank")).otherwise(0.0)


def mrr_at_k(candidates: DataFrame, truth: DataFrame, k: int = 5) -> DataFrame:
    """Mean over the queries of 1 / rank of the true voter, 0 where it is not listed."""
    ranks = _rank_of_truth(candidates, truth, k)
    return ranks.agg(F.avg(_reciprocal()).alias("mrr"), F.count(F.lit(1)).alias("queries"))


def hits_at_k(candidates: DataFrame, truth: DataFrame, k: int = 5) -> DataFrame:
    """Share of the queries whose true voter is listed."""
    ranks = _rank_of_truth(candidates, truth, k)
    hit = (F.col("rank") > 0).cast("double")
    return ranks.agg(F.avg(hit).alias("hits"), F.count(F.lit(1)).alias("queries"))
