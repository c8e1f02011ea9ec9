"""Candidate voters per query: history, padding, scoring, features, row numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sharelens.functions.columns import hash_text
from sharelens.functions.ranks import row_index
from sharelens.functions.skew import skew_join
from sharelens.operators.profile import (
    count_by,
    invite_counts,
    item_popularity,
    user_user_counts,
    vote_counts,
)
from sharelens.operators.trends import top_voters_of, topk_voters_per_inviter
from sharelens.session import checkpointed


def assign_query_id(queries: DataFrame, order: Sequence[str]) -> DataFrame:
    """Replace ``triple_id`` by the zero-based row position, as text."""
    numbered = row_index(queries.drop("triple_id"), order, "triple_id")
    return numbered.withColumn("triple_id", F.col("triple_id").cast("string"))


def node_index(shares: DataFrame) -> DataFrame:
    """A dense zero-based index of all users in the log, in id order."""
    ids = shares.select(F.explode(F.array("inviter_id", "voter_id")).alias("user_id"))
    return row_index(ids.dropna().distinct(), ["user_id"], "idx")


def _voter_lists(top: DataFrame, key: str, element: Column, name: str) -> DataFrame:
    """One row per key holding its few top voters, best first."""
    entries = F.sort_array(F.collect_list(F.struct("rank", element.alias("_e"))))
    return top.groupBy(key).agg(F.transform(entries, lambda e: e["_e"]).alias(name))


def history_candidates(queries: DataFrame, train: DataFrame, k: int = 5) -> DataFrame:
    """The inviter's ``k`` commonest past voters per query; empty for an unseen inviter."""
    top = topk_voters_per_inviter(train, k)
    lists = _voter_lists(top, "inviter_id", F.col("voter_id").cast("string"), "_list")
    found = skew_join(queries.select("triple_id", "inviter_id"), lists, ["inviter_id"])
    empty = F.array().cast("array<string>")
    return found.select("triple_id", F.coalesce("_list", empty).alias("candidate_voter_list"))


def pad_candidates(candidates: DataFrame, users: DataFrame, k: int = 5, seed: int = 42) -> DataFrame:
    """Fill each list up to ``k`` with users not in it, then cut it to ``k``.

    Fillers come in hash order.  The first ``k`` users always suffice, as a list
    shorter than ``k`` cannot hold more of them than it has entries.
    """
    ids = users.select(F.col("user_id").cast("string").alias("user_id"))
    first = ids.withColumn("_h", hash_text(seed, "user_id")).orderBy("_h", "user_id").limit(k)
    entries = F.sort_array(F.collect_list(F.struct("_h", "user_id")))
    pool = first.agg(F.transform(entries, lambda e: e["user_id"]).alias("pool")).scalar()
    found = F.col("candidate_voter_list")
    filled = F.slice(F.concat(found, F.array_except(pool, found)), 1, k)
    return candidates.withColumn("candidate_voter_list", filled)


def score_all_candidates(
    queries: DataFrame,
    train: DataFrame,
    users: DataFrame,
    k: int = 5,
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0),
) -> DataFrame:
    """The ``k`` best of *all* users per query, as ranked rows with ``voter_id`` and ``score``.

    A user's score is the largest of three weighted shares: of the inviter's past
    voters, of the item's past voters, and of all votes.  A user among the ``k``
    best by the largest of three numbers is among the ``k`` best by one of them,
    so ``k`` candidates per inviter, per item and overall give the exact answer;
    no query meets the whole user table.  Ties go to the smaller id.  Voters that are not
    among ``users`` count in the totals and are never candidates.  Weights must not be
    negative, or the three lists would not suffice.
    """
    if min(weights) < 0:
        raise ValueError("weights must not be negative")
    w_inviter, w_item, w_all = weights
    entry = "array<struct<voter:{0},minus:double>>".format(users.schema["user_id"].dataType.simpleString())

    ids = users.select(F.col("user_id").alias("voter_id")).distinct().withColumn("_user", F.lit(True))

    def element(voter: str, share: Column, weight: float) -> Column:
        return F.struct(F.col(voter).alias("voter"), (share * -weight).alias("minus"))

    def lists(key: str, weight: float, name: str) -> DataFrame:
        counts = count_by(train, [key, "voter_id"], "_n")
        totals = count_by(train, [key], "_total")
        # Any voter may hold a third of the counts.
        known = skew_join(counts, ids, ["voter_id"]).where("_user")
        top = top_voters_of(known, key, "voter_id", "_n", k).join(totals, key)
        return _voter_lists(top, key, element("voter_id", F.col("_n") / F.col("_total"), weight), name)

    votes = vote_counts(train)
    total = votes.agg(F.sum("voted_count").alias("t")).scalar()
    popular = (
        users.select("user_id")
        .join(votes, "user_id", "left")
        .select("user_id", F.coalesce("voted_count", F.lit(0)).alias("_n"))
        .orderBy(F.col("_n").desc(), "user_id")
        .limit(k)
        .select(element("user_id", F.col("_n") / total, w_all).alias("_e"))
        .agg(F.collect_list("_e").alias("e"))
        .scalar()
    )

    asked = ["triple_id", "inviter_id", "item_id"]
    queries = queries.select(*asked)
    rows = skew_join(queries, lists("inviter_id", w_inviter, "_a"), ["inviter_id"])
    rows = skew_join(rows, lists("item_id", w_item, "_b"), ["item_id"], source=queries)
    rows = rows.withColumn("_c", popular)
    found = [F.coalesce(F.col(name).cast(entry), F.array().cast(entry)) for name in ("_a", "_b", "_c")]
    by_voter = F.sort_array(F.concat(*found))  # a voter's best entry comes first
    rows = rows.select(*asked, by_voter.alias("_all"))
    once = F.filter("_all", lambda e, i: (i == 0) | (F.get("_all", i - 1)["voter"] != e["voter"]))
    best_first = F.sort_array(F.transform(once, lambda e: F.struct(e["minus"], e["voter"])))
    return rows.select(*asked, F.posexplode(F.slice(best_first, 1, k)).alias("_pos", "_e")).select(
        *asked,
        (F.col("_pos") + 1).alias("rank"),
        F.col("_e.voter").alias("voter_id"),
        (-F.col("_e.minus")).alias("score"),
    )


def to_lists(scored: DataFrame) -> DataFrame:
    """Ranked rows to one candidate list per query; ranks are few by construction."""
    return _voter_lists(
        scored, "triple_id", F.col("voter_id").cast("string"), "candidate_voter_list"
    )


def pair_features(pairs: DataFrame, history: DataFrame, users: DataFrame) -> DataFrame:
    """Feature columns for (inviter, item, candidate voter) rows, from ``history`` alone.

    Counts that the history lacks are 0; unknown user attributes stay null.  What is
    known of a user is joined together first, so each key is joined once.  The pairs
    feed every join, so they are checkpointed.
    """
    pairs = checkpointed(pairs)
    n = pairs.count()
    rows = skew_join(
        pairs,
        user_user_counts(history).withColumnRenamed("interaction_count", "pair_count"),
        ["inviter_id", "voter_id"],
        rows=n,
    )
    item_votes = count_by(history, ["item_id", "voter_id"], "item_voter_count")
    rows = skew_join(rows, item_votes, ["item_id", "voter_id"], source=pairs, rows=n)
    for side, counts, name in (
        ("voter", vote_counts(history).withColumnRenamed("voted_count", "voter_popularity"), "voter_popularity"),
        ("inviter", invite_counts(history).withColumnRenamed("invite_count", "inviter_activity"), "inviter_activity"),
    ):
        both = users.join(counts, "user_id", "full").select(
            F.col("user_id").alias(f"{side}_id"),
            name,
            *[F.col(f"user_{c}").alias(f"{side}_{c}") for c in ("gender", "age", "level")],
        )
        rows = skew_join(rows, both, [f"{side}_id"], source=pairs, rows=n)
    rows = skew_join(rows, item_popularity(history), ["item_id"], source=pairs, rows=n)
    return rows.na.fill(
        0,
        ["pair_count", "item_voter_count", "voter_popularity", "inviter_activity", "item_popularity"],
    )
