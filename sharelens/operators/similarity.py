"""Similarities of the most active inviters over the items they share.

All pairs are formed only among the ``n_users`` chosen inviters, so an item
gives at most ``n_users`` squared rows however popular it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sharelens.operators.joins import topn_filter
from sharelens.operators.profile import user_item_counts
from sharelens.session import checkpointed


def _selected_counts(shares: DataFrame, n_users: int, n_items: int) -> DataFrame:
    """Share counts of the most active inviters on the most shared items.

    At most ``n_users * n_items`` rows, read several times: checkpointed.
    """
    return checkpointed(user_item_counts(topn_filter(shares, n_users, n_items), "_n"))


def _pairs(counts: DataFrame, value: str) -> DataFrame:
    """Rows ``(user_a, user_b, x, y)`` per item that both users have, ``user_a < user_b``."""
    a = counts.select("item_id", F.col("inviter_id").alias("user_a"), F.col(value).alias("x"))
    b = counts.select("item_id", F.col("inviter_id").alias("user_b"), F.col(value).alias("y"))
    return a.join(b, "item_id").where(F.col("user_a") < F.col("user_b"))


def _cosines(counts: DataFrame, threshold: float) -> DataFrame:
    norms = counts.groupBy("inviter_id").agg(F.sqrt(F.sum(F.col("_n") * F.col("_n"))).alias("_norm"))
    dots = _pairs(counts, "_n").groupBy("user_a", "user_b").agg(F.sum(F.col("x") * F.col("y")).alias("_dot"))
    a = norms.select(F.col("inviter_id").alias("user_a"), F.col("_norm").alias("_na"))
    b = norms.select(F.col("inviter_id").alias("user_b"), F.col("_norm").alias("_nb"))
    cosine = F.col("_dot") / (F.col("_na") * F.col("_nb"))
    pairs = dots.join(a, "user_a").join(b, "user_b").select("user_a", "user_b", cosine.alias("weight"))
    return pairs.where(F.col("weight") > threshold)


def user_similarity(
    shares: DataFrame, n_users: int = 50, n_items: int = 100, threshold: float = 0.3
) -> DataFrame:
    """Cosine of the count vectors of two inviters, where above ``threshold``."""
    return _cosines(_selected_counts(shares, n_users, n_items), threshold)


def similarity_degrees(
    shares: DataFrame, n_users: int = 50, n_items: int = 100, threshold: float = 0.3
) -> DataFrame:
    """Edges per user of the similarity graph; users without edges have 0."""
    selected = _selected_counts(shares, n_users, n_items)
    pairs = _cosines(selected, threshold)
    ends = pairs.select(F.explode(F.array("user_a", "user_b")).alias("user_id"))
    counts = ends.groupBy("user_id").agg(F.count(F.lit(1)).alias("_d"))
    users = selected.select(F.col("inviter_id").alias("user_id")).distinct()
    return users.join(counts, "user_id", "left").select("user_id", F.coalesce("_d", F.lit(0)).alias("degree"))


def log_count_matrix(shares: DataFrame, n_users: int = 30, n_items: int = 30) -> DataFrame:
    """ln(1 + count) for the most active inviters by the most shared items, zero-filled.

    Long form: one row per cell, at most ``n_users * n_items``.  Users and items
    with no share inside the selection have no cells.
    """
    counts = _selected_counts(shares, n_users, n_items)
    columns = counts.agg(F.collect_set("item_id").alias("items")).scalar()
    cells = counts.select("inviter_id").distinct().select("inviter_id", F.explode(columns).alias("item_id"))
    filled = cells.join(counts, ["inviter_id", "item_id"], "left")
    value = F.log1p(F.coalesce("_n", F.lit(0)).cast("double"))
    return filled.select("inviter_id", "item_id", value.alias("log_count"))


def user_distance_pairs(shares: DataFrame, n_users: int = 30, n_items: int = 30) -> DataFrame:
    """Euclidean distance of two inviters' rows of the log-count matrix."""
    rows = _pairs(log_count_matrix(shares, n_users, n_items), "log_count")
    gap = F.col("x") - F.col("y")
    return rows.groupBy("user_a", "user_b").agg(F.sqrt(F.sum(gap * gap)).alias("distance"))
