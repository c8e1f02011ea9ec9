"""User and item vectors by message passing over the log, and the best users by inner product.

Vectors are computed once, layer by layer, as joins of the edges with the vectors of the
other side.  The search orders users by the length of their vectors and cuts them into
blocks: no user of a block can score more than the query's length times the block's
largest length, so blocks are opened in that order and only while they can still win.  A
run of blocks goes to each part of the queries and is gone through there, so no pair of a
query and a block is ever a row.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sharelens.functions.columns import hash_fraction
from sharelens.functions.ranks import row_index
from sharelens.functions.skew import skew_join
from sharelens.session import checkpointed

DIMENSIONS = 8
LAYERS = 2
UNIT = 1_000_000
BLOCK_USERS = 1024
RUN_USERS = 65_536
QUERY_ROWS = 8192
SCORED_ROWS = 1024
EXACT = 2.0**52


def user_item_edges(shares: DataFrame) -> DataFrame:
    """Distinct ``user_id, item_id``: who shared the item or voted on it."""
    ends = shares.select(F.explode(F.array("inviter_id", "voter_id")).alias("user_id"), "item_id")
    return ends.dropna().distinct()


def _first_vector(seed: int, kind: str, key: str, dimensions: int) -> Column:
    """Numbers from -0.5 to 0.5 that follow from the node's id."""
    return F.array(*[
        hash_fraction(seed, F.concat(F.lit(kind), F.col(key).cast("string")), F.lit(d)) - 0.5 for d in range(dimensions)
    ])


def _passed(edges: DataFrame, vectors: DataFrame, from_key: str, to_key: str, dimensions: int, n: int) -> DataFrame:
    """Each node's weighted sum of its neighbours' vectors; hot neighbours are split, sums combined."""
    met = skew_join(edges, vectors.withColumnRenamed("vector", "_v"), [from_key], rows=n)
    sums = [F.sum(F.col("_v")[d] * F.col("weight")).alias(f"_{d}") for d in range(dimensions)]
    return met.groupBy(to_key).agg(*sums).select(to_key, F.array(*[f"_{d}" for d in range(dimensions)]).alias("vector"))


def _mean(layers: list[DataFrame], key: str, dimensions: int) -> DataFrame:
    rows = layers[0]
    for layer in layers[1:]:
        rows = rows.unionByName(layer)
    means = [(F.sum(F.col("vector")[d]) / len(layers)).alias(f"_{d}") for d in range(dimensions)]
    return rows.groupBy(key).agg(*means).select(key, F.array(*[f"_{d}" for d in range(dimensions)]).alias("vector"))


def user_item_embeddings(
    shares: DataFrame, dimensions: int = DIMENSIONS, layers: int = LAYERS, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """``user_id, vector`` and ``item_id, vector``, stored.

    In a layer a node takes the sum of its neighbours' vectors of the layer before, each
    divided by the root of the product of both nodes' numbers of neighbours.  A node's vector
    is the mean over its first vector and all layers.  Repeated shares are one edge; shares
    without an id give none; a node is in the result if it has an edge.
    """
    edges = checkpointed(user_item_edges(shares))
    n = edges.count()
    users = checkpointed(edges.groupBy("user_id").agg(F.count(F.lit(1)).alias("_nu")))
    items = checkpointed(edges.groupBy("item_id").agg(F.count(F.lit(1)).alias("_ni")))
    weighed = skew_join(edges, users, ["user_id"], rows=n)
    weighed = skew_join(weighed, items, ["item_id"], source=edges, rows=n)
    weighed = checkpointed(weighed.select("user_id", "item_id", (1 / F.sqrt(F.col("_nu") * F.col("_ni"))).alias("weight")))
    user_layers = [checkpointed(users.select("user_id", _first_vector(seed, "u", "user_id", dimensions).alias("vector")))]
    item_layers = [checkpointed(items.select("item_id", _first_vector(seed, "i", "item_id", dimensions).alias("vector")))]
    for _ in range(layers):
        of_items = _passed(weighed, user_layers[-1], "user_id", "item_id", dimensions, n)
        of_users = _passed(weighed, item_layers[-1], "item_id", "user_id", dimensions, n)
        item_layers.append(checkpointed(of_items))
        user_layers.append(checkpointed(of_users))
    return checkpointed(_mean(user_layers, "user_id", dimensions)), checkpointed(_mean(item_layers, "item_id", dimensions))


def in_units(vectors: DataFrame) -> DataFrame:
    """Vectors as whole millionths, so that inner products are exact and ties are ties."""
    return vectors.withColumn("vector", F.transform("vector", lambda x: F.round(x * UNIT).cast("long")))


def _norm(vector: str) -> Column:
    squares = F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return F.sqrt(squares)


def _first_k(rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best entries of each row number, row by row; equal scores by id."""
    order = np.lexsort((ids, -scores, rows))
    starts = np.flatnonzero(np.r_[True, np.diff(rows[order]) != 0]) if len(order) else np.empty(0, np.int64)
    nth = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    return order[nth < k]


def _best_of_run(vectors: np.ndarray, lows: np.ndarray, blocks: list[tuple], k: int) -> tuple:
    """Row number, user and score of the ``k`` best users of ``blocks`` (largest length, ids, vectors) per row.

    A row leaves at the first block that can't reach its ``k``-th best score, and takes no
    user below it.  Products of whole numbers are exact as doubles up to ``EXACT``.
    """
    lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
    exact = blocks[0][0] * lengths.max(initial=0.0) < EXACT
    vectors = vectors.astype(np.float64) if exact else vectors
    rows, users, scores = np.empty(0, np.int64), blocks[0][1][:0], np.empty(0, np.int64)
    lows = lows.copy()
    for top, ids, matrix in blocks:
        open_ones = np.flatnonzero(lengths * top * (1 + 1e-9) + 1 >= lows)
        if not len(open_ones):
            break
        found = vectors[open_ones] @ (matrix.astype(np.float64) if exact else matrix).T
        unknown = np.flatnonzero(np.isneginf(lows[open_ones]))
        taken = found >= lows[open_ones, None]
        if len(unknown) and len(ids) > k:
            # No bound yet: only what reaches the block's own k-th best.
            kth = np.partition(found[unknown], len(ids) - k, axis=1)[:, len(ids) - k]
            taken[unknown] = found[unknown] >= kth[:, None]
        at, user = np.nonzero(taken)
        rows = np.r_[rows, open_ones[at]]
        users = np.concatenate([users, ids[user]])
        scores = np.r_[scores, found[at, user].astype(np.int64)]
        few = _first_k(rows, scores, users, k)
        rows, users, scores = rows[few], users[few], scores[few]
        many, least = np.unique(rows, return_counts=True)
        ends = np.cumsum(least) - 1
        full = least >= k
        lows[many[full]] = np.maximum(lows[many[full]], scores[ends[full]])
    return rows, users, scores


def _scored(asked: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """The ``k`` best users of the blocks for each query (``_query, vector``, its ``_low`` if known).

    Queries are dealt into parts of about ``QUERY_ROWS``, and each part meets the blocks, of
    ``RUN_USERS`` users at most, in one task.
    """
    parts = max(1, -(-asked.count() // QUERY_ROWS))
    dealt = asked.withColumn("_part", F.pmod(F.xxhash64("_query"), F.lit(parts)))
    if "_low" not in asked.columns:
        dealt = dealt.withColumn("_low", F.lit(None).cast("long"))
    copies = blocks.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))

    def run(queries: pd.DataFrame, users: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(users):
            users = users.sort_values(["_block", "user_id"])
            runs = [
                (block["_norm"].max(), block["user_id"].to_numpy(), np.stack(block["vector"]))
                for _, block in users.groupby("_block", sort=True)
            ]
            ids, vectors = queries["_query"].to_numpy(), np.stack(queries["vector"])
            lows = queries["_low"].astype("float64").fillna(-np.inf).to_numpy()
            for first in range(0, len(ids), SCORED_ROWS):
                some = slice(first, first + SCORED_ROWS)
                rows, best, scores = _best_of_run(vectors[some], lows[some], runs, k)
                found.append(pd.DataFrame({"_query": ids[some][rows], "user_id": best, "_score": scores}))
        return pd.concat(found) if found else pd.DataFrame(columns=["_query", "user_id", "_score"])

    left = dealt.select("_part", "_query", "vector", "_low").groupBy("_part")
    right = copies.select("_part", "_block", "_norm", "user_id", "vector").groupBy("_part")
    kind = blocks.schema["user_id"].dataType.simpleString()
    return left.cogroup(right).applyInPandas(run, f"_query long, user_id {kind}, _score long")


def _best(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("_query").orderBy(F.col("_score").desc(), "user_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_users_by_inner_product(
    queries: DataFrame, users: DataFrame, keys: Sequence[str], k: int = 5, block_users: int = BLOCK_USERS
) -> DataFrame:
    """The ``k`` users with the largest inner product for each query, best first.

    ``queries``: ``keys`` and ``vector``; ``users``: ``user_id, vector``; both in whole units
    (:func:`in_units`).  Returns ``keys, rank, user_id, score``.  Exact: a round opens the
    next run of blocks, about ``RUN_USERS`` users, to each query until the bound of the next
    block is below its ``k``-th best score.  Equal scores go to the smaller id.
    """
    placed = row_index(users.select("user_id", "vector", (-_norm("vector")).alias("_minus")), ["_minus", "user_id"], "_place")
    blocks = checkpointed(
        placed.select("user_id", "vector", (-F.col("_minus")).alias("_norm"), F.floor(F.col("_place") / block_users).alias("_block"))
    )
    # The largest length of each block; a query's open blocks are a run of these.
    tops = checkpointed(blocks.groupBy("_block").agg(F.max("_norm").alias("_top")))
    n_blocks = tops.count()
    rows = row_index(queries.select(*keys, "vector").withColumn("_norm", _norm("vector")), list(keys), "_query")
    rows = checkpointed(rows)
    left, best, opened, width = rows.select("_query", "vector", "_norm"), None, 0, max(1, RUN_USERS // block_users)
    while opened < n_blocks and not left.isEmpty():
        last = min(n_blocks, opened + width)
        fresh = _scored(left, blocks.where((F.col("_block") >= opened) & (F.col("_block") < last)), k)
        best = checkpointed(_best(fresh if best is None else fresh.unionByName(best), k).drop("rank"))
        opened = last
        if opened < n_blocks:
            lows = best.groupBy("_query").agg(F.when(F.count(F.lit(1)) >= k, F.min("_score")).alias("_low"))
            following = tops.where(F.col("_block") == opened).agg(F.max("_top").alias("t")).scalar()
            alive = rows.select("_query", "vector", "_norm").join(lows, "_query", "left")
            reach = F.col("_norm") * following * (1 + 1e-9) + 1
            left = checkpointed(alive.where(F.col("_low").isNull() | (reach >= F.col("_low"))))
    if best is None:
        none = f"_query long, user_id {users.schema['user_id'].dataType.simpleString()}, _score long"
        best = users.sparkSession.createDataFrame([], none)
    named = _best(best, k).join(rows.select("_query", *keys), "_query")
    return named.select(*keys, "rank", "user_id", F.col("_score").alias("score"))


def query_vectors(queries: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Each query's ``vector``, in units: its inviter's and its item's, nothing for one unknown."""
    slim = checkpointed(queries.select("triple_id", "inviter_id", "item_id"))
    n = slim.count()
    own = in_units(users).select(F.col("user_id").alias("inviter_id"), F.col("vector").alias("_a"))
    rows = skew_join(slim, own, ["inviter_id"], rows=n)
    rows = skew_join(rows, in_units(items).withColumnRenamed("vector", "_b"), ["item_id"], source=slim, rows=n)
    size = F.coalesce(F.size("_a"), F.size("_b"), F.lit(0))
    none = F.array_repeat(F.lit(0).cast("long"), F.greatest(size, F.lit(0)))
    both = F.zip_with(F.coalesce("_a", none), F.coalesce("_b", none), lambda a, b: a + b)
    return rows.select("triple_id", both.alias("vector"))


def recommend_by_embedding(queries: DataFrame, shares: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` users whose vectors go best with a query's inviter and item.

    Returns ``triple_id, rank, voter_id, score``; a query of which neither is in the log has
    no rows.
    """
    users, items = user_item_embeddings(shares)
    asked = query_vectors(queries, users, items).where(F.size("vector") > 0)
    found = top_users_by_inner_product(asked, in_units(users), ["triple_id"], k)
    return found.select("triple_id", "rank", F.col("user_id").alias("voter_id"), (F.col("score") / float(UNIT) ** 2).alias("score"))
