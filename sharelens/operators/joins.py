"""Joins of shares and queries with users, items and history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sharelens.functions.skew import lookup_join, skew_join
from sharelens.operators.profile import (
    invite_counts,
    item_popularity,
    top_inviters,
    top_items,
    vote_counts,
)


def join_share_user_item(shares: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Shares with the inviter's and the item's attributes; rows without a match stay."""
    with_user = lookup_join(shares, users.withColumnRenamed("user_id", "inviter_id"), ["inviter_id"])
    return lookup_join(with_user, items, ["item_id"], source=shares)


def _activity(shares: DataFrame) -> DataFrame:
    return invite_counts(shares).join(vote_counts(shares), "user_id", "full")


def user_activity(shares: DataFrame) -> DataFrame:
    """Invites and votes per user; a user seen on one side only has 0 on the other."""
    return _activity(shares).na.fill(0, ["invite_count", "voted_count"])


def test_feature_join(
    queries: DataFrame, train: DataFrame, users: DataFrame, items: DataFrame
) -> DataFrame:
    """Queries with inviter and item attributes, the inviter's counts, item popularity.

    What is unknown stays null.  A user's attributes and counts are joined together
    first, an item's too, so the queries are joined once by inviter and once by item.
    """
    inviters = users.join(_activity(train), "user_id", "full").withColumnRenamed("user_id", "inviter_id")
    goods = items.join(item_popularity(train), "item_id", "full")
    rows = skew_join(queries, inviters, ["inviter_id"])
    return skew_join(rows, goods, ["item_id"], source=queries)


def has_interaction(
    queries: DataFrame, train: DataFrame, source: DataFrame | None = None
) -> DataFrame:
    """Add 0/1: did the query's inviter share its item in ``train``?

    ``source`` names the plain queries where ``queries`` has joined columns.
    """
    seen = train.select("inviter_id", "item_id").distinct().withColumn("_seen", F.lit(1))
    return (
        skew_join(queries, seen, ["inviter_id", "item_id"], source=source)
        .withColumn("has_interaction", F.coalesce("_seen", F.lit(0)))
        .drop("_seen")
    )


def count_with_user_attr(shares: DataFrame, users: DataFrame) -> DataFrame:
    """Invites per inviter with gender, age and level."""
    return lookup_join(invite_counts(shares), users, ["user_id"])


def count_with_item_attr(shares: DataFrame, items: DataFrame) -> DataFrame:
    """Shares per shared item with category, level-1 category, brand and shop."""
    return lookup_join(item_popularity(shares, "share_count"), items, ["item_id"])


def topn_filter(
    shares: DataFrame, n_inviters: int | None = 50, n_items: int | None = 100
) -> DataFrame:
    """Shares whose inviter is among the most active and item among the most shared."""
    kept = shares
    if n_inviters is not None:
        best = top_inviters(shares, n_inviters).select("inviter_id")
        kept = kept.join(F.broadcast(best), "inviter_id", "left_semi")
    if n_items is not None:
        best = top_items(shares, n_items).select("item_id")
        kept = kept.join(F.broadcast(best), "item_id", "left_semi")
    return kept


def remaining_users(users: DataFrame, candidates: DataFrame) -> DataFrame:
    """Users that no candidate list names."""
    named = candidates.select(F.explode("candidate_voter_list").alias("_id")).distinct()
    return users.join(named, users["user_id"].cast("string") == named["_id"], "left_anti")
