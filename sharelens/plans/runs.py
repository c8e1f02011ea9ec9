"""Whole runs over a share log: profile it, build feature tables, train and predict."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sharelens.functions.columns import calendar_features, limit_range
from sharelens.operators import distribution as dist
from sharelens.operators import clusters, evaluate, graph, joins, profile, ranker, ranking, recommend
from sharelens.operators import sampling, similarity, trends
from sharelens.session import checkpointed
from sharelens.sources import sinks


def profile_tables(
    train: DataFrame,
    queries: DataFrame,
    users: DataFrame,
    items: DataFrame,
    keep: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> dict[str, DataFrame]:
    """Every descriptive analysis of the log, by name.

    ``keep`` gets each table that several analyses read, and may store it: counts per
    user and item, edges, degrees and intervals.
    """
    invites = keep(joins.count_with_user_attr(train, users))
    shared = keep(joins.count_with_item_attr(train, items))
    votes = keep(profile.vote_counts(train))
    edges = keep(graph.graph_edges(train))
    nodes = keep(graph.degrees(edges))
    intervals = keep(trends.share_intervals(train))
    short = intervals.where(F.col("interval_hours") <= 72)
    limited = limit_range(invites)
    found = {
        "gender_distribution": profile.gender_distribution(users),
        "age_distribution": profile.age_distribution(users),
        "level_distribution": profile.level_distribution(users),
        "top_categories": profile.top_values(items, "cate_id"),
        "top_level1_categories": profile.top_values(items, "cate_level1_id"),
        "top_brands": profile.top_values(items, "brand_id"),
        "daily_counts": profile.daily_counts(train),
        "hourly_counts": profile.hourly_counts(train),
        "weekday_counts": profile.weekday_counts(train),
        "weekend_effect": profile.weekend_effect(train),
        "activity_stats": profile.activity_stats(train),
        "dataset_stats": profile.dataset_stats(train, queries, users, items),
        "top_inviters": profile.top_inviters(train),
        "top_voters": profile.top_voters(train),
        "top_items": profile.top_items(train),
        "hour_weekday_matrix": profile.hour_weekday_matrix(train),
        "hour_weekday_hotspot": profile.hour_weekday_hotspot(train),
        "date_hour_matrix": profile.date_hour_matrix(train),
        "date_hour_hotspot": profile.date_hour_hotspot(train),
        "gender_age_crosstab": profile.gender_age_crosstab(users),
        "gender_age_percent": profile.gender_age_percent(users),
        "daily_trend": trends.daily_trend(train),
        "daily_extremes": trends.daily_extremes(train),
        "category_trend": profile.category_trend(train, items),
        "box_by_category": dist.box_stats(profile.largest_categories(shared), "cate_id", "share_count"),
        "avg_shares_by_category": profile.average_shares_by(shared, "cate_id"),
        "avg_shares_by_level1": profile.average_shares_by(shared, "cate_level1_id"),
        "avg_shares_by_brand": profile.average_shares_by(shared, "brand_id"),
        "return_rate_by_activity": profile.return_rate_by_activity(train),
        "item_return_rate": profile.item_return_rate(train),
        "share_voter_regression": profile.share_voter_regression(train),
        "share_voter_regression_log": profile.share_voter_regression(train, log=True),
        "degree_stats": graph.degree_stats(edges),
        "node_roles": graph.node_roles(edges),
        "graph_hubs": graph.graph_hubs(edges),
        "graph_size": graph.graph_size(edges),
        "bipartite_degrees": graph.bipartite_degrees(train),
        "bipartite_size": graph.bipartite_size(train),
        "user_similarity": similarity.user_similarity(train),
        "similarity_degrees": similarity.similarity_degrees(train),
        "log_count_matrix": similarity.log_count_matrix(train),
        "user_distance_pairs": similarity.user_distance_pairs(train),
        "user_cluster_tree": clusters.user_cluster_tree(train),
        "item_cluster_tree": clusters.item_cluster_tree(train),
        "clustered_matrix": clusters.clustered_matrix(train),
    }
    for suffix, counts in (("", invites), ("_limited", limited)):
        found[f"gender_activity_stats{suffix}"] = profile.gender_activity_stats(counts)
        for part in ("gender", "age", "level"):
            found[f"box_by_{part}{suffix}"] = dist.box_stats(counts, f"user_{part}", "invite_count")
        found[f"kde_by_gender{suffix}"] = dist.kde_by_group(counts, "user_gender", "invite_count")
    found["kde_by_level"] = dist.kde_by_group(invites, "user_level", "invite_count")
    for name, values, column, bins, weight, log in (
        ("invites", invites, "invite_count", 50, None, False),
        ("invites_log", invites, "invite_count", 50, None, True),
        ("votes", votes, "voted_count", 50, None, False),
        ("votes_log", votes, "voted_count", 50, None, True),
        ("in_degree", nodes, "in_degree", 30, None, False),
        ("in_degree_log", nodes.where("in_degree > 0"), "in_degree", 30, None, True),
        ("out_degree", nodes, "out_degree", 30, None, False),
        ("out_degree_log", nodes.where("out_degree > 0"), "out_degree", 30, None, True),
        ("intervals", short, "interval_hours", 50, "n", False),
        ("intervals_log", intervals, "interval_hours", 50, "n", True),
    ):
        found[f"hist_{name}"] = dist.histogram(values, column, bins, weight, log)
        found[f"kde_{name}"] = dist.kde_curve(values, column, weight, log)
    return found


def profile_log(
    train: DataFrame, queries: DataFrame, users: DataFrame, items: DataFrame, out: str
) -> dict[str, str]:
    """Write every analysis to ``out`` as Parquet and the summary as JSON; return the paths."""
    paths = {}
    for name, table in profile_tables(train, queries, users, items, checkpointed).items():
        paths[name] = f"{out}/{name}"
        if name == "dataset_stats":
            sinks.write_stats_json(table, paths[name])
        else:
            table.write.mode("overwrite").parquet(paths[name])
    return paths


def build_features(
    train: DataFrame,
    queries: DataFrame,
    users: DataFrame,
    items: DataFrame,
    out: str,
    n_central: int = 1000,
) -> dict[str, str]:
    """Write the nine feature tables as CSV and the history candidates as JSON lines."""
    edges = checkpointed(graph.graph_edges(train))
    pairs = checkpointed(profile.user_item_counts(train, "_n"))
    features = joins.test_feature_join(calendar_features(queries), train, users, items)
    found = {
        "user_item_matrix": pairs.withColumnRenamed("_n", "count"),
        "user_user_matrix": profile.user_user_counts(train),
        "user_activity": joins.user_activity(train),
        "item_popularity": profile.item_popularity(train),
        "network_features": graph.network_features(edges, graph.betweenness(edges, n_central)),
        "user_item_freq": pairs.withColumnRenamed("_n", "interaction_freq"),
        "user_cate_freq": profile.grouped_counts(pairs, items, "cate_id", "cate_interaction_freq"),
        "user_cate1_freq": profile.grouped_counts(pairs, items, "cate_level1_id", "cate1_interaction_freq"),
        "test_features": joins.has_interaction(features, train, queries),
    }
    paths = {name: f"{out}/{name}.csv" for name in found}
    for name, table in found.items():
        sinks.write_feature_csv(table, paths[name])
    paths["test_candidates"] = f"{out}/test_candidates.json"
    sinks.write_candidates_jsonl(recommend.history_candidates(queries, train), paths["test_candidates"])
    return paths


def train_model(train: DataFrame, users: DataFrame, label_start: str, model_path: str) -> None:
    """Fit the model on shares from ``label_start`` on, with features from earlier ones, and save it."""
    start = F.lit(label_start).cast("timestamp")
    known = ranking.known_from(train.where(F.col("ts") < start), users)
    rows = checkpointed(ranker.labelled_pairs(train.where(F.col("ts") >= start), users))
    ranking.save_model(train.sparkSession, ranking.fit(ranking.features(rows, known)), model_path)


def train_and_validate(
    train: DataFrame,
    users: DataFrame,
    label_start: str,
    model_path: str,
    keys: list[str],
    rate: float = 1.0,
    seed: int = 42,
    k: int = 5,
) -> DataFrame:
    """Fit on a sample of the log and return MRR@k and HITS@k on its held-out parts.

    ``keys`` tell the log's rows apart.  The sample of ``rate`` is split into train, val
    and test rows by :func:`sampling.train_val_test_split`; the model sees the train rows
    only, and the labelled rows of the other parts are its queries.
    """
    sample = sampling.sample_rate(train, rate, keys, seed)
    # Another seed: the sample's hashes are all below the rate.
    rows = checkpointed(sampling.train_val_test_split(sample, keys, seed=seed + 1))
    known = rows.where(F.col("split") == "train").drop("split")
    train_model(known, users, label_start, model_path)
    asked = rows.where((F.col("split") != "train") & (F.col("ts") >= F.lit(label_start).cast("timestamp")))
    asked = asked.withColumn("triple_id", F.concat_ws("|", *[F.col(c).cast("string") for c in keys]))
    lists = checkpointed(recommend.to_lists(predict(known, asked, users, model_path, k)))
    found = []
    for part in ("val", "test"):
        truth = asked.where(F.col("split") == part)
        own = lists.join(truth.select("triple_id"), "triple_id", "left_semi")
        hits = evaluate.hits_at_k(own, truth, k).select("hits")
        scores = evaluate.mrr_at_k(own, truth, k).select(F.lit(part).alias("split"), "mrr", "queries")
        found.append(scores.withColumn("hits", hits.scalar()))
    return found[0].unionByName(found[1])


def predict(train: DataFrame, queries: DataFrame, users: DataFrame, model_path: str, k: int = 5) -> DataFrame:
    """The ``k`` best of all users per query by the saved model, as ranked rows."""
    weights = ranking.load_model(train.sparkSession, model_path)
    return ranking.rank_all_users(queries, train, users, weights, k)


def rank_with_model(
    train: DataFrame, queries: DataFrame, users: DataFrame, label_start: str, model_path: str, k: int = 5
) -> DataFrame:
    train_model(train, users, label_start, model_path)
    return predict(train, queries, users, model_path, k)


def predict_and_write(
    train: DataFrame, queries: DataFrame, users: DataFrame, model_path: str, out: str, k: int = 5
) -> None:
    """Predict, fill short lists from the user table, and write JSON lines."""
    lists = recommend.to_lists(predict(train, queries, users, model_path, k))
    sinks.write_predictions(recommend.pad_candidates(lists, users, k), out)
