"""Trees of clusters by average linkage, and the order of a clustered heat map.

Merging goes by rounds: every two clusters that are each other's nearest merge, all such
pairs at once.  Of two clusters the mean distance to a third is never below the smaller
of theirs, so nearest pairs stay nearest whatever else merges, and the tree is the one
that merging a single closest pair at a time gives.  A round is a few joins and counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sharelens.operators.similarity import log_count_matrix
from sharelens.session import checkpointed

DISTANCE_UNIT = 1_000_000  # distances are whole millionths, so sums and ties are exact


def distances(matrix: DataFrame, key: str, other: str, value: str) -> DataFrame:
    """``a, b, distance``: Euclidean, for each pair of ``key`` of a full long-form matrix."""
    a = matrix.select(other, F.col(key).alias("a"), F.col(value).alias("_x"))
    b = matrix.select(other, F.col(key).alias("b"), F.col(value).alias("_y"))
    gap = F.col("_x") - F.col("_y")
    pairs = a.join(b, other).where("a < b").groupBy("a", "b")
    return pairs.agg(F.sqrt(F.sum(gap * gap)).alias("distance"))


def _renamed(name: str, merging: DataFrame) -> DataFrame:
    """``merging`` as a lookup of the clusters that end: their new name."""
    return merging.select(F.col("b").alias(name), F.col("a").alias(f"_{name}"))


def _mutual(pairs: DataFrame) -> DataFrame:
    """``a, b, mean`` of the pairs that are nearest to each other, ties by ``a`` and ``b``."""
    means = pairs.withColumn("mean", F.col("total") / F.col("n"))
    ends = means.select(F.struct("mean", "a", "b").alias("near"), F.explode(F.array("a", "b")).alias("end"))
    nearest = ends.groupBy("end").agg(F.min("near").alias("near"))
    both = nearest.groupBy("near").agg(F.count(F.lit(1)).alias("ends")).where("ends = 2")
    return both.select("near.*")


def average_linkage(pairs: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The merges of ``members`` (``member``) by mean ``distance`` of all ``pairs`` (``a, b``, ``a < b``).

    Returns the tree, ``cluster_a, cluster_b, height, n_members``, a row for each merge, and the
    order of its leaves, ``member, cluster, place``.  A cluster has the name of its smallest
    member, and ``cluster_a < cluster_b``; the leaves of ``cluster_a`` come first.  Distances
    are rounded to whole millionths; equal means merge the smaller names first.  NULL distances
    and pairs count as absent: clusters without a pair between them never merge.  ``place``
    counts from 0 within the top cluster ``cluster``.  One member gives no merge.

    Rounds are some log of the members, but one a merge if clusters lie inside each other like
    shells.  What a round leaves is written, so a lost executor costs no earlier round.
    """
    total = F.round(F.col("distance") * DISTANCE_UNIT).cast("bigint")
    one = F.lit(1).cast("bigint")
    pairs = checkpointed(pairs.select("a", "b", total.alias("total"), one.alias("n")).dropna())
    none = F.lit(0).cast("bigint")
    leaves = checkpointed(
        members.select("member").distinct().select("member", F.col("member").alias("cluster"), none.alias("place"))
    )
    merges: list[DataFrame] = []
    while not pairs.isEmpty():
        sizes = leaves.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
        merging = checkpointed(
            _mutual(pairs)
            .join(sizes.select(F.col("cluster").alias("a"), F.col("size").alias("size_a")), "a")
            .join(sizes.select(F.col("cluster").alias("b"), F.col("size").alias("size_b")), "b")
        )
        merges.append(merging)
        moved = leaves.join(merging.select(F.col("b").alias("cluster"), "a", "size_a"), "cluster", "left")
        leaves = checkpointed(
            moved.select(
                "member",
                F.coalesce("a", "cluster").alias("cluster"),
                (F.col("place") + F.coalesce("size_a", none)).alias("place"),
            )
        )
        named = pairs.join(_renamed("a", merging), "a", "left").join(_renamed("b", merging), "b", "left")
        a, b = F.coalesce("_a", "a"), F.coalesce("_b", "b")
        ends = [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]
        apart = named.select(*ends, "total", "n").where("a <> b").groupBy("a", "b")
        pairs = checkpointed(apart.agg(F.sum("total").alias("total"), F.sum("n").alias("n")))
    tree = pairs.select("a", "b", F.lit(0.0).alias("mean"), none.alias("size_a"), none.alias("size_b")).limit(0)
    for merging in merges:
        tree = tree.unionByName(merging)
    return tree.select(
        F.col("a").alias("cluster_a"),
        F.col("b").alias("cluster_b"),
        (F.col("mean") / DISTANCE_UNIT).alias("height"),
        (F.col("size_a") + F.col("size_b")).alias("n_members"),
    ), leaves


def _linkage_of(matrix: DataFrame, key: str, other: str) -> tuple[DataFrame, DataFrame]:
    return average_linkage(
        distances(matrix, key, other, "log_count"), matrix.select(F.col(key).alias("member"))
    )


def user_cluster_tree(shares: DataFrame, n_users: int = 30, n_items: int = 30) -> DataFrame:
    """Merges of the most active inviters by their rows of the log-count matrix."""
    return _linkage_of(log_count_matrix(shares, n_users, n_items), "inviter_id", "item_id")[0]


def item_cluster_tree(shares: DataFrame, n_users: int = 30, n_items: int = 30) -> DataFrame:
    """Merges of the most shared items by their columns of the log-count matrix."""
    return _linkage_of(log_count_matrix(shares, n_users, n_items), "item_id", "inviter_id")[0]


def _placed(leaves: DataFrame, key: str, out: str) -> DataFrame:
    return leaves.select(F.col("member").alias(key), F.col("place").alias(out))


def clustered_matrix(shares: DataFrame, n_users: int = 30, n_items: int = 30) -> DataFrame:
    """The log-count matrix with each row's and column's place in the order of its tree."""
    matrix = checkpointed(log_count_matrix(shares, n_users, n_items))
    users = _linkage_of(matrix, "inviter_id", "item_id")[1]
    items = _linkage_of(matrix, "item_id", "inviter_id")[1]
    return matrix.join(_placed(users, "inviter_id", "user_place"), "inviter_id").join(
        _placed(items, "item_id", "item_place"), "item_id"
    )
