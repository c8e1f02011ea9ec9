"""A fitted model over all features that ranks all users exactly for every query.

A user's score for a query (inviter, item) is a weighted sum of six features, none with
a weight below 0:

- the user's share of the inviter's past votes, and of the item's;
- the user's share of all votes;
- for gender, age and level: how much oftener inviters like this one reach users with
  the user's value than such users are among all.

For a user the inviter never reached, only the item and the inviter's three values count,
so the k best of all users by those, worked out once per item and such class, do for them.
The inviter's own past voters come sorted by all but the item's share, in parts.  The
threshold algorithm goes down these: a voter not seen yet can score no more than the next
part's first with the item's largest share, and a query is done when its k-th best score
is above that.  Scores are integers (billionths), so that ties are ties whatever the order
of summing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sharelens.functions.skew import lookup_join, skew_join
from sharelens.operators.profile import count_by, vote_counts
from sharelens.session import checkpointed

TRAITS = ("gender", "age", "level")
FEATURES = ["pair_share", "item_share", "vote_share", *[f"{t}_affinity" for t in TRAITS]]
MODEL_SCHEMA = ", ".join(f"{f} double" for f in FEATURES)
UNKNOWN = -1
UNIT = 1_000_000_000
SWEEPS = 200
FIRST_DEPTH, PART_GROWTH = 16, 8
CLASS_ROWS = 256


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, 0 if there is no whole."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


@dataclass
class Known:
    """What the features are worked out from, each table stored and counted once.

    ``users``: user_id, gender, age, level, votes; ``pairs``: inviter_id, voter_id, n;
    ``items``: item_id, voter_id, n; ``inviters``: inviter_id, total and the three values;
    ``popularity``: item_id, total; ``affinity[t]``: own, other, ratio.
    """

    users: DataFrame
    pairs: DataFrame
    items: DataFrame
    inviters: DataFrame
    popularity: DataFrame
    affinity: dict[str, DataFrame]
    votes: int
    user_count: int


def known_from(history: DataFrame, users: DataFrame) -> Known:
    """All tables from two counts over the log, of (inviter, voter) and (item, voter)."""
    pairs = checkpointed(count_by(history, ["inviter_id", "voter_id"]))
    items = checkpointed(count_by(history, ["item_id", "voter_id"]))
    total = F.sum("n").alias("total")
    votes = pairs.groupBy(F.col("voter_id").alias("user_id")).agg(F.sum("n").alias("votes"))
    traits = [F.coalesce(F.col(f"user_{t}"), F.lit(UNKNOWN)).cast("int").alias(t) for t in TRAITS]
    own = users.dropDuplicates(["user_id"]).where(F.col("user_id").isNotNull()).select("user_id", *traits)
    people = checkpointed(own.join(votes, "user_id", "left").withColumn("votes", F.coalesce("votes", F.lit(0))))
    slim = people.select("user_id", *TRAITS)
    inviters = pairs.groupBy("inviter_id").agg(total).join(slim.withColumnRenamed("user_id", "inviter_id"), "inviter_id", "left")
    inviters = checkpointed(inviters.na.fill(UNKNOWN, list(TRAITS)))
    user_count = people.count()

    # (inviter's value, voter's value) -> votes: one pass over the pairs for all three.
    dim = inviters.drop("total")
    told = lookup_join(pairs, dim, ["inviter_id"])
    others = slim.select(F.col("user_id").alias("voter_id"), *[F.col(t).alias(f"voter_{t}") for t in TRAITS])
    told = lookup_join(told, others, ["voter_id"])
    met = told.select("n", F.explode(F.array(*[
        F.struct(F.lit(t).alias("trait"), F.col(t).alias("own"), F.col(f"voter_{t}").alias("other")) for t in TRAITS
    ])).alias("_t")).groupBy("_t.trait", "_t.own", "_t.other").agg(F.sum("n").alias("n"))
    met = checkpointed(met)
    wholes = met.groupBy("trait", "own").agg(F.sum("n").alias("own_total"))
    sizes = slim.select(F.explode(F.array(*[
        F.struct(F.lit(t).alias("trait"), F.col(t).alias("other")) for t in TRAITS
    ])).alias("_t")).groupBy("_t.trait", "_t.other").agg(F.count(F.lit(1)).alias("size"))
    expected = ratio(F.col("size"), F.lit(user_count))
    rates = met.where("other IS NOT NULL").join(wholes, ["trait", "own"]).join(sizes, ["trait", "other"])
    rates = checkpointed(rates.select("trait", "own", "other", ratio(ratio(F.col("n"), F.col("own_total")), expected).alias("rate")))
    return Known(
        people, pairs, items, inviters,
        checkpointed(items.groupBy("item_id").agg(total)),
        {t: rates.where(F.col("trait") == t).drop("trait") for t in TRAITS},
        pairs.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0],
        user_count,
    )


def _affinities(rows: DataFrame, known: Known, own: str, other: str) -> DataFrame:
    """Add the three affinities; ``own`` and ``other`` are name patterns of the values."""
    for t in TRAITS:
        # A row for each pair of codes of one attribute: some hundred.
        rates = F.broadcast(known.affinity[t].withColumnsRenamed({"own": "_own", "other": "_other", "rate": f"{t}_affinity"}))
        same = (F.col(own.format(t)) == F.col("_own")) & (F.col(other.format(t)) == F.col("_other"))
        rows = rows.join(rates, same, "left").drop("_own", "_other")
    return rows.na.fill(0.0, [f"{t}_affinity" for t in TRAITS])


def features(rows: DataFrame, known: Known) -> DataFrame:
    """``rows`` (stored; inviter_id, item_id, voter_id and more) with the six features."""
    n = rows.count()
    found = skew_join(rows, known.pairs.withColumnRenamed("n", "_pair"), ["inviter_id", "voter_id"], rows=n)
    found = skew_join(found, known.items.withColumnRenamed("n", "_item"), ["item_id", "voter_id"], source=rows, rows=n)
    inviters = known.inviters.withColumnsRenamed({"total": "_inviter_total", **{t: f"_own_{t}" for t in TRAITS}})
    found = skew_join(found, inviters, ["inviter_id"], source=rows, rows=n)
    found = skew_join(found, known.popularity.withColumnRenamed("total", "_item_total"), ["item_id"], source=rows, rows=n)
    voters = known.users.select(F.col("user_id").alias("voter_id"), "votes", *[F.col(t).alias(f"_voter_{t}") for t in TRAITS])
    found = skew_join(found, voters, ["voter_id"], source=rows, rows=n)
    # An inviter that the history lacks reaches nobody in particular.
    found = _affinities(found, known, "_own_{}", "_voter_{}")
    shares = {
        "pair_share": ratio(F.col("_pair"), F.col("_inviter_total")),
        "item_share": ratio(F.col("_item"), F.col("_item_total")),
        "vote_share": ratio(F.col("votes"), F.lit(known.votes)),
    }
    return found.withColumns(shares).select(*rows.columns, *FEATURES)


def fit(rows: DataFrame) -> tuple[float, ...]:
    """Least-squares weights of the features for ``label``, none below 0, to 6 places.

    One aggregate over all rows gives the covariances; with those, one weight after the
    other is set to its best, ``SWEEPS`` times over.  If nothing goes with the label,
    all weights are 1.
    """
    names = [*FEATURES, "label"]
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    found = rows.agg(*[F.covar_pop(a, b).alias(f"_{i}") for i, (a, b) in enumerate(pairs)]).first()
    cov = np.zeros((len(names), len(names)))
    for (a, b), value in zip(pairs, found):
        i, j = names.index(a), names.index(b)
        cov[i, j] = cov[j, i] = value or 0.0
    weights = np.zeros(len(FEATURES))
    for _ in range(SWEEPS):
        for j in range(len(FEATURES)):
            if cov[j, j] > 1e-15:
                others = sum(cov[j, k] * weights[k] for k in range(len(FEATURES)) if k != j)
                weights[j] = max(0.0, (cov[j, -1] - others) / cov[j, j])
    weights = tuple(round(float(w), 6) for w in weights)
    return weights if any(weights) else (1.0,) * len(FEATURES)


def save_model(spark: SparkSession, weights: Sequence[float], path: str) -> None:
    spark.createDataFrame([tuple(weights)], MODEL_SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)


def load_model(spark: SparkSession, path: str) -> tuple[float, ...]:
    """Load saved weights; missing ones are an error, never untrained stand-ins."""
    return tuple(spark.read.schema(MODEL_SCHEMA).parquet(path).first())


def units(weight: float, feature: Column) -> Column:
    """A term of the score in billionths."""
    return F.round(F.lit(weight) * feature * F.lit(float(UNIT))).cast("long")


def _static_lists(asked: DataFrame, known: Known, weights: dict[str, float], k: int) -> DataFrame:
    """Per class of inviters: the ``k`` best users by what does not depend on the two lists.

    Among users with the same three values the commoner comes first, so ``k`` of each such
    group suffice, and the groups are as few as the codes of the attributes allow.
    """
    own = [f"own_{t}" for t in TRAITS]
    order = Window.partitionBy(*TRAITS).orderBy(F.col("votes").desc(), "user_id")
    few = known.users.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") <= k).drop("_nth")
    few = checkpointed(few)
    groups = few.select(*TRAITS).distinct().agg(F.collect_list(F.struct(*TRAITS)).alias("g")).scalar()
    classes = asked.select(*own).distinct().select(*own, F.explode(groups).alias("_g")).select(*own, "_g.*")
    met = _affinities(classes, known, "own_{}", "{}")
    rows = few.join(met, list(TRAITS))
    score = units(weights["vote_share"], ratio(F.col("votes"), F.lit(known.votes)))
    for t in TRAITS:
        score = score + units(weights[f"{t}_affinity"], F.col(f"{t}_affinity"))
    best = Window.partitionBy(*own).orderBy(F.col("static").desc(), "user_id")
    rows = rows.withColumn("static", score).withColumn("place", F.row_number().over(best))
    return rows.where(F.col("place") <= k).select(*own, "place", F.col("user_id").alias("voter_id"), "static")


def _item_lists(asked: DataFrame, by_item: DataFrame, static: DataFrame, known: Known, w: dict[str, float], k: int) -> DataFrame:
    """Per item and class of ``asked``: the ``k`` best users by all but the pair's share, best first.

    Among an item's voters with the same three values the order is the same for each class,
    so the ``k`` first of each such group suffice, with the class's ``k`` best of all users
    for those who never voted for the item.  A user who did may come in there with too
    little, but then the ``k`` of the user's group come before.
    """
    own = [f"own_{t}" for t in TRAITS]
    n = by_item.count()
    people = known.users.withColumnRenamed("user_id", "voter_id")
    rows = skew_join(by_item, people, ["voter_id"], rows=n)
    rows = skew_join(rows, known.popularity, ["item_id"], source=by_item, rows=n)
    fixed = units(w["item_share"], ratio(F.col("n"), F.col("total"))) + units(w["vote_share"], ratio(F.col("votes"), F.lit(known.votes)))
    order = Window.partitionBy("item_id", *TRAITS).orderBy(F.col("fixed").desc(), "voter_id")
    rows = rows.select("item_id", "voter_id", *TRAITS, fixed.alias("fixed")).withColumn("_nth", F.row_number().over(order))
    rows = rows.where(F.col("_nth") <= k).drop("_nth")
    # A number for each pair of codes of one attribute: some hundred.
    rates = [
        {(r.own, r.other): r.u for r in known.affinity[t].select("own", "other", units(w[f"{t}_affinity"], F.col("rate")).alias("u")).collect()}
        for t in TRAITS
    ]

    def run(classes: pd.DataFrame, voters: pd.DataFrame) -> pd.DataFrame:
        found = []
        voters = voters.sort_values("voter_id")
        ids, fixed = voters["voter_id"].to_numpy(), voters["fixed"].to_numpy()
        for first in range(0, len(classes) if len(voters) else 0, CLASS_ROWS):
            some = classes.iloc[first : first + CLASS_ROWS]
            scores = np.repeat(fixed[None, :], len(some), axis=0)
            for t, table in zip(TRAITS, rates):
                mine, at = np.unique(some[f"own_{t}"], return_inverse=True)
                others, to = np.unique(voters[t], return_inverse=True)
                scores += np.array([[table.get((a, b), 0) for b in others] for a in mine], np.int64)[at][:, to]
            best = np.argsort(-scores, axis=1, kind="stable")[:, :k]  # ids ascend among equals
            rows = some.loc[some.index.repeat(best.shape[1])].reset_index(drop=True)
            found.append(rows.assign(voter_id=ids[best.ravel()], score=np.take_along_axis(scores, best, 1).ravel()))
        columns = ["item_id", *own, "voter_id", "score"]
        return pd.concat(found)[columns] if found else pd.DataFrame(columns=columns)

    kinds = {"item_id": by_item, "voter_id": by_item}
    item, voter = (frame.schema[name].dataType.simpleString() for name, frame in kinds.items())
    schema = f"item_id {item}, {', '.join(f'{c} int' for c in own)}, voter_id {voter}, score long"
    asked = asked.select("item_id", *own).dropna(subset=["item_id"]).distinct()
    voted = asked.groupBy("item_id").cogroup(rows.groupBy("item_id")).applyInPandas(run, schema)
    others = asked.join(F.broadcast(static), own).select("item_id", *own, "voter_id", F.col("static").alias("score"))
    once = voted.unionByName(others).groupBy("item_id", *own, "voter_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("item_id", *own).orderBy(F.col("score").desc(), "voter_id")
    once = once.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)
    entries = F.sort_array(F.collect_list(F.struct("place", "voter_id", "score")))
    return once.groupBy("item_id", *own).agg(entries.alias("item_list"))


def _voter_parts(asked: DataFrame, by_inviter: DataFrame, known: Known, w: dict[str, float], depth: int) -> DataFrame:
    """``inviter_id, part, last, first, most_pair, entries``: each inviter's past voters in parts of ``depth``.

    They are sorted by all but the item's share, ``first`` is the part's largest such score,
    ``most_pair`` the largest pair's share from this part on, and ``last`` the last part.
    """
    few = checkpointed(by_inviter.join(asked, "inviter_id", "left_semi"))
    n = few.count()
    inviters = known.inviters.withColumnsRenamed({"total": "_total", **{t: f"own_{t}" for t in TRAITS}})
    rows = skew_join(few, inviters, ["inviter_id"], rows=n)
    rows = skew_join(rows, known.users.withColumnRenamed("user_id", "voter_id"), ["voter_id"], source=few, rows=n)
    rows = _affinities(rows, known, "own_{}", "{}")
    pair = units(w["pair_share"], ratio(F.col("n"), F.col("_total")))
    score = pair + units(w["vote_share"], ratio(F.col("votes"), F.lit(known.votes)))
    for t in TRAITS:
        score = score + units(w[f"{t}_affinity"], F.col(f"{t}_affinity"))
    rows = rows.select("inviter_id", "voter_id", pair.alias("pair"), score.alias("score"))
    order = Window.partitionBy("inviter_id").orderBy(F.col("score").desc(), "voter_id")
    part = F.floor((F.row_number().over(order) - 1) / depth).alias("part")
    rows = rows.select("*", part)
    parts = rows.groupBy("inviter_id", "part").agg(
        F.max("score").alias("first"),
        F.max("pair").alias("most_pair"),
        F.collect_list(F.struct("voter_id", "score")).alias("entries"),
    )
    rest = Window.partitionBy("inviter_id").orderBy("part").rowsBetween(0, Window.unboundedFollowing)
    return parts.withColumn("most_pair", F.max("most_pair").over(rest)).withColumn("last", F.max("part").over(rest))


def _best(rows: DataFrame, k: int) -> DataFrame:
    """The ``k`` best users per query, of rows that hold a user twice at most."""
    order = Window.partitionBy("_q").orderBy(F.col("_score").desc(), "voter_id")
    few = rows.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") <= 2 * k)
    once = few.withColumn("_same", F.lag("voter_id").over(order) == F.col("voter_id")).where("_same IS NULL OR NOT _same")
    return once.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") <= k).drop("_nth", "_same")


def rank_all_users(
    queries: DataFrame,
    history: DataFrame,
    users: DataFrame,
    weights: Sequence[float],
    k: int = 5,
    first_depth: int = FIRST_DEPTH,
) -> DataFrame:
    """The ``k`` best of all ``users`` per query by the model, as ``triple_id, rank, voter_id, score``.

    Exact: a query starts with the ``k`` best for its item and class.  Then rounds open
    its inviter's past voters in parts of ``first_depth``, ``PART_GROWTH`` times as many
    parts as before, each part only if it can reach the query's k-th best, and the query
    leaves when no later part can.  Equal scores go to the smaller id.  Users that have
    no id are never candidates; voters who are not among ``users`` count in the
    totals only.
    """
    if min(weights) < 0:
        raise ValueError("weights must not be negative")
    w = dict(zip(FEATURES, weights))
    known = known_from(history, users)
    ids = known.users.select(F.col("user_id").alias("voter_id"))
    by_inviter = checkpointed(known.pairs.join(ids, "voter_id", "left_semi"))
    by_item = checkpointed(known.items.join(ids, "voter_id", "left_semi"))
    own = {t: f"own_{t}" for t in TRAITS}

    slim = checkpointed(queries.select("triple_id", "inviter_id", "item_id", F.monotonically_increasing_id().alias("_q")))
    n = slim.count()
    most = by_item.groupBy("item_id").agg(F.max("n").alias("_most"))
    items = known.popularity.withColumnRenamed("total", "item_total").join(most, "item_id", "left")
    share = units(w["item_share"], ratio(F.col("_most"), F.col("item_total"))).alias("most_item")
    items = checkpointed(items.select("item_id", "item_total", share))
    left = skew_join(slim, known.inviters.withColumnsRenamed({"total": "inviter_total", **own}), ["inviter_id"], rows=n)
    left = skew_join(left, items, ["item_id"], source=slim, rows=n)
    # A code that no inviter of the history has, for those it lacks: without affinities.
    left = checkpointed(left.na.fill(UNKNOWN - 1, list(own.values())).na.fill(0, ["most_item"]))
    static = checkpointed(_static_lists(left, known, w, k))
    entry = F.struct("place", "voter_id", F.col("static").alias("score"))
    classes = checkpointed(static.groupBy(*own.values()).agg(F.sort_array(F.collect_list(entry)).alias("class_list")))
    lists = checkpointed(_item_lists(left, by_item, static, known, w, k))
    started = lookup_join(left, classes, list(own.values()))
    started = skew_join(started, lists, ["item_id", *own.values()], source=left, rows=n)
    started = started.withColumn("_list", F.coalesce("item_list", "class_list"))
    fields = ["_q", "triple_id", "inviter_id", "item_id", "inviter_total", "item_total", "most_item"]
    started = checkpointed(started.select(*fields, F.get("_list", F.lit(k - 1))["score"].alias("most_other"), "_list"))
    met = started.select("_q", "triple_id", "inviter_id", "inviter_total", F.explode("_list").alias("_e"))
    met = checkpointed(met.select("_q", "triple_id", "inviter_id", "inviter_total", F.col("_e.voter_id").alias("voter_id"), "_e.score"))
    found = skew_join(met, by_inviter, ["inviter_id", "voter_id"], rows=met.count())
    pair = units(w["pair_share"], ratio(F.col("n"), F.col("inviter_total")))
    best = checkpointed(found.select("_q", "triple_id", "voter_id", (F.col("score") + pair).alias("_score")))

    parts = checkpointed(_voter_parts(left.select("inviter_id").distinct(), by_inviter, known, w, first_depth))
    tops = parts.select("inviter_id", "part", "last", "first", "most_pair")
    # No voter of a part or of a later one, but for those of the item's list, has more.
    bound = F.least(F.col("first") + F.col("most_item"), F.col("most_pair") + F.col("most_other"))
    reaches = F.col("first").isNotNull() & F.coalesce(bound >= F.col("_low"), F.lit(True))

    def alive(rows: DataFrame, part: int) -> DataFrame:
        """Of ``rows``, the queries that the inviter's voters from ``part`` on can still change."""
        lows = best.groupBy("_q").agg(F.when(F.count(F.lit(1)) >= k, F.min("_score")).alias("_low"))
        following = tops.where(F.col("part") == part).drop("part")
        rows = checkpointed(rows.select(*fields, "most_other").join(lows, "_q", "left"))
        return checkpointed(skew_join(rows, following, ["inviter_id"], rows=n).where(reaches).drop("first", "most_pair"))

    opened, width = 0, 1
    left = alive(started, opened)
    while not left.isEmpty():
        n = left.count()
        some = parts.where((F.col("part") >= opened) & (F.col("part") < opened + width))
        run = F.sequence(F.lit(opened).cast("long"), F.least(F.lit(opened + width - 1).cast("long"), F.col("last")))
        asked = checkpointed(left.withColumn("part", F.explode(run)).drop("last"))
        met = skew_join(asked, some, ["inviter_id", "part"], rows=asked.count()).where(reaches)
        met = met.select("_q", "triple_id", "item_id", "item_total", F.explode("entries").alias("_e"))
        met = checkpointed(met.select("_q", "triple_id", "item_id", "item_total", "_e.*"))
        rows = skew_join(met, by_item, ["item_id", "voter_id"], rows=met.count())
        share = units(w["item_share"], ratio(F.col("n"), F.col("item_total")))
        rows = rows.select("_q", "triple_id", "voter_id", (F.col("score") + share).alias("_score"))
        best = checkpointed(_best(best.unionByName(rows), k))
        opened, width = opened + width, width * PART_GROWTH
        left = alive(left, opened)
    # Queries that share an id are ranked together.
    order = Window.partitionBy("triple_id").orderBy(F.col("_score").desc(), "voter_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("triple_id", "rank", "voter_id", (F.col("_score") / F.lit(float(UNIT))).alias("score"))
