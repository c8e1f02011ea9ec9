"""Sampled negatives, and MLlib rankers for the pairs that the caller gives.

:mod:`sharelens.operators.ranking` has the model that ranks all users.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sharelens.functions.columns import hash_fraction
from sharelens.functions.skew import lookup_join
from sharelens.operators.recommend import pair_features, row_index
from sharelens.session import checkpointed

COUNT_FEATURES = [
    "pair_count",
    "item_voter_count",
    "voter_popularity",
    "inviter_activity",
    "item_popularity",
]
USER_FEATURES = [f"{side}_{part}" for side in ("inviter", "voter") for part in ("gender", "age", "level")]


def _model_input(features: DataFrame) -> DataFrame:
    logs = {f"log_{c}": F.log1p(F.col(c).cast("double")) for c in COUNT_FEATURES}
    return features.withColumns(logs).na.fill(-1, USER_FEATURES)


def negative_pairs(positives: DataFrame, users: DataFrame, per_row: int = 4, seed: int = 42) -> DataFrame:
    """``per_row`` users drawn for each positive row, other than its true voter.

    The draw follows the hash of the row, so it repeats.
    """
    numbered = row_index(users.select("user_id"), ["user_id"], "_idx")
    size = numbered.agg(F.count(F.lit(1)).alias("n")).scalar()
    drawn = positives.withColumn("_draw", F.explode(F.sequence(F.lit(1), F.lit(per_row))))
    place = F.floor(hash_fraction(seed, *positives.columns, "_draw") * size)
    joined = lookup_join(drawn.withColumn("_idx", place), numbered, ["_idx"])
    other = joined.where(F.col("user_id") != F.col("voter_id"))
    return other.withColumn("voter_id", F.col("user_id")).select(*positives.columns)


def training_rows(
    history: DataFrame, positives: DataFrame, users: DataFrame, per_row: int = 4, seed: int = 42
) -> DataFrame:
    """Labelled feature rows; ``history`` must end before the positives begin."""
    return pair_features(labelled_pairs(positives, users, per_row, seed), history, users)


def labelled_pairs(positives: DataFrame, users: DataFrame, per_row: int = 4, seed: int = 42) -> DataFrame:
    """The positives with ``label`` 1 and users drawn for them with ``label`` 0."""
    pairs = positives.select("inviter_id", "item_id", "voter_id", "ts")
    return pairs.withColumn("label", F.lit(1.0)).unionByName(
        negative_pairs(pairs, users, per_row, seed).withColumn("label", F.lit(0.0))
    )


def train_ranker(rows: DataFrame, trees: bool = False, seed: int = 42) -> PipelineModel:
    """Fit a logistic ranker, or boosted trees if ``trees``."""
    names = [f"log_{c}" for c in COUNT_FEATURES] + USER_FEATURES
    vector = VectorAssembler(inputCols=names, outputCol="features")
    if trees:
        learner = GBTClassifier(maxIter=20, maxDepth=4, seed=seed)
    else:
        learner = LogisticRegression(maxIter=30, regParam=0.01)
    ready = checkpointed(_model_input(rows).select("label", *names))
    return Pipeline(stages=[vector, learner]).fit(ready)


def save_ranker(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_ranker(path: str) -> PipelineModel:
    """Load a saved ranker; a missing one is an error, never an untrained stand-in."""
    return PipelineModel.load(path)


def score_pairs(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Add ``score``, the probability that the candidate is the voter."""
    scored = model.transform(_model_input(features))
    return scored.withColumn("score", vector_to_array("probability")[1]).select(*features.columns, "score")


def rank_candidates(scored: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` best-scored candidates per query, as rows with ``rank``."""
    order = Window.partitionBy("triple_id").orderBy(F.col("score").desc(), "voter_id")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("triple_id", "rank", "voter_id", "score")
