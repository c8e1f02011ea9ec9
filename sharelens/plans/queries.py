"""Named queries: each operator applied to the share-log views of the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sharelens.functions import columns as c
from sharelens.operators import distribution as dist
from sharelens.operators import clusters, embedding, evaluate, graph, joins, profile, recommend, sampling
from sharelens.operators import similarity, trends
from sharelens.plans import runs
from sharelens.session import checkpointed, scratch_path
from sharelens.sources import jsonl, sinks, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Bounds that bite on the test tables; the operators default to the usual ones.
INVITE_LIMIT = 60
MIN_SHARES = 25
COSINE = 0.45
TRAIN_START = "2024-01-19 00:00:00"


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to ``digits`` places, so that summation order does not show."""
    doubles = [name for name, kind in df.dtypes if kind == "double"]
    return df.withColumns({d: F.round(d, digits) for d in doubles})


def listed(df: DataFrame) -> DataFrame:
    """Candidate lists as comma-separated text."""
    return df.withColumn("candidate_voter_list", F.array_join("candidate_voter_list", ","))


def _stored(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Train shares and queries written out once, for runs that read them many times."""
    shares = checkpointed(tables.event_shares(spark, sf))
    return tables.before_queries(shares), tables.from_queries(shares)


# --- sources and sinks -----------------------------------------------------


def _share_text(spark: SparkSession, sf: str) -> DataFrame:
    return tables.event_shares(spark, sf).select(
        *[F.col(k).cast("string").alias(k) for k in ("inviter_id", "item_id", "voter_id")],
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        "ts",
        "event_id",
    )


MIXED_SCHEMA = f"{jsonl.SHARE_SCHEMA}, n int"


def _mixed_lines(spark: SparkSession, sf: str) -> str:
    """Write the event shares as JSON lines, a file a day; some hours hold irregular lines."""
    fields = [F.col(k) for k in jsonl.SHARE_COLUMNS]
    back = [F.col("voter_id").alias("inviter_id"), F.col("item_id"), F.col("inviter_id").alias("voter_id"), F.col("timestamp")]

    def record(n, columns=fields):
        return F.to_json(F.struct(*columns, n.alias("n")))

    n = F.col("event_id") % 100
    one = record(n)
    hour = F.hour("ts")
    line = (
        F.when(hour == 0, F.rtrim(one, F.lit("}")))
        .when(hour == 1, "  ")
        .when(hour == 2, F.concat_ws(",", F.concat(F.lit("["), one), F.concat(record(n, back), F.lit("]"))))
        .when(hour == 3, "[]")
        .when(hour == 4, F.col("event_id").cast("string"))
        .when(hour == 5, record(n.cast("string")))
        .when(hour == 6, record(F.lit("x")))
        .when(hour == 7, record(F.lit(3.5)))
        .when(hour == 8, F.concat(F.lit("["), one, F.lit(", 5, "), record(F.lit("x"), back), F.lit("]")))
        .otherwise(one)
    )
    path = scratch_path(spark, "shares.jsonl")
    days = _share_text(spark, sf).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    rows = days.repartition("day").sortWithinPartitions("day", "event_id").select("day", line.alias("value"))
    rows.write.partitionBy("day").text(path)
    return path


def _day_of(file: str):
    return F.regexp_extract(file, "day=([0-9-]+)", 1).alias("day")


@query("read_jsonl")
def _(spark, sf):
    return jsonl.read_jsonl(spark, _mixed_lines(spark, sf), MIXED_SCHEMA)


@query("jsonl_rejects")
def _(spark, sf):
    lost = jsonl.jsonl_rejects(spark, _mixed_lines(spark, sf), MIXED_SCHEMA)
    return lost.select(_day_of("file"), "field", "text")


@query("jsonl_reject_counts")
def _(spark, sf):
    counts = jsonl.jsonl_reject_counts(spark, _mixed_lines(spark, sf), MIXED_SCHEMA)
    return counts.select(_day_of("file"), "records", "fields")


@query("jsonl_peek")
def _(spark, sf):
    return jsonl.peek(spark, _mixed_lines(spark, sf)).select(_day_of("file"), "line_no", "value")


@query("repair_columns")
def _(spark, sf):
    named = _share_text(spark, sf).select(*jsonl.SHARE_COLUMNS)
    return jsonl.repair_columns(named.toDF("0", "1", "2", "3"), jsonl.SHARE_COLUMNS)


@query("read_query_array")
def _(spark, sf):
    rows = tables.query_shares(spark, sf).select(
        "triple_id",
        F.to_json(
            F.struct(
                "triple_id",
                F.col("inviter_id").cast("string").alias("inviter_id"),
                F.col("item_id").cast("string").alias("item_id"),
                F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
            )
        ).alias("value")
    )
    path = scratch_path(spark, "queries.json")
    sinks.write_record_arrays(rows, "triple_id", path, separator=" ")  # one line a file
    return jsonl.read_query_array(spark, path)


@query("assign_query_id")
def _(spark, sf):
    queries = tables.query_shares(spark, sf).select("inviter_id", "item_id", "ts", "event_id")
    return recommend.assign_query_id(queries, ["ts", "event_id"]).drop("ts")


@query("write_feature_csv")
def _(spark, sf):
    path = scratch_path(spark, "user_activity.csv")
    sinks.write_feature_csv(joins.user_activity(tables.event_shares(spark, sf)), path)
    schema = "user_id bigint, invite_count bigint, voted_count bigint"
    return spark.read.option("header", True).schema(schema).csv(path)


@query("feature_tables")
def _(spark, sf):
    path = scratch_path(spark, "features")
    train, queries = _stored(spark, sf)
    written = runs.build_features(
        train,
        queries.select("triple_id", "inviter_id", "item_id", "ts"),
        tables.users(spark, sf),
        tables.items(spark, sf),
        path,
    )
    counts = [
        spark.read.option("header", True).csv(place).agg(
            F.lit(name).alias("feature_table"), F.count(F.lit(1)).alias("n")
        )
        for name, place in written.items()
        if name != "test_candidates"
    ]
    union = counts[0]
    for other in counts[1:]:
        union = union.unionByName(other)
    return union


def _history(spark: SparkSession, sf: str, k: int = 5) -> DataFrame:
    return recommend.history_candidates(tables.query_shares(spark, sf), tables.train_shares(spark, sf), k)


ANSWER_SCHEMA = "triple_id string, candidate_voter_list array<string>"


@query("write_candidates_jsonl")
def _(spark, sf):
    path = scratch_path(spark, "test_candidates.json")
    sinks.write_candidates_jsonl(_history(spark, sf), path)
    return listed(jsonl.read_jsonl(spark, path, ANSWER_SCHEMA))


@query("write_predictions")
def _(spark, sf):
    path = scratch_path(spark, "predictions.json")
    sinks.write_predictions(recommend.to_lists(_scored(spark, sf)), path)
    return listed(jsonl.read_jsonl(spark, path, ANSWER_SCHEMA))


def _stats(spark: SparkSession, sf: str) -> DataFrame:
    train, queries = _stored(spark, sf)
    return profile.dataset_stats(train, queries, tables.users(spark, sf), tables.items(spark, sf))


@query("write_stats_json")
def _(spark, sf):
    path = scratch_path(spark, "data_stats.json")
    stats = _stats(spark, sf)
    sinks.write_stats_json(stats, path)
    return rounded(spark.read.schema(stats.schema).json(path))


# --- projections, scalar functions, filters --------------------------------


@query("parse_timestamp")
def _(spark, sf):
    return _share_text(spark, sf).select("event_id", c.parse_timestamp(F.col("timestamp")).alias("ts"))


@query("calendar_features")
def _(spark, sf):
    return c.calendar_features(tables.event_shares(spark, sf)).select(
        "event_id", "date", "hour", "day_of_week", "month", "day"
    )


@query("month_day_label")
def _(spark, sf):
    return tables.event_shares(spark, sf).select("event_id", c.month_day_label(F.col("ts")).alias("date_label"))


@query("label_gender")
def _(spark, sf):
    return tables.users(spark, sf).select("user_id", c.label_gender(F.col("user_gender")).alias("gender"))


@query("label_age")
def _(spark, sf):
    return tables.users(spark, sf).select("user_id", c.label_age(F.col("user_age")).alias("age"))


@query("label_weekday")
def _(spark, sf):
    shares = tables.event_shares(spark, sf)
    return shares.select("event_id", c.label_weekday(F.weekday("ts")).alias("weekday"))


@query("share_count_bucket")
def _(spark, sf):
    counts = profile.invite_counts(tables.order_shares(spark, sf))
    labelled = counts.withColumn("share_group", c.share_count_bucket(F.col("invite_count")))
    return labelled.withColumn("bucket_rank", c.share_bucket_rank(F.col("share_group")))


@query("log1p_counts")
def _(spark, sf):
    activity = joins.user_activity(tables.event_shares(spark, sf))
    return rounded(c.log1p_counts(activity, "invite_count", "voted_count"))


@query("limit_range_filter")
def _(spark, sf):
    return c.limit_range(profile.invite_counts(tables.event_shares(spark, sf)), upper=INVITE_LIMIT)


# --- joins -----------------------------------------------------------------


@query("join_share_user_item")
def _(spark, sf):
    shares = tables.event_shares(spark, sf).drop("ts")
    return joins.join_share_user_item(shares, tables.users(spark, sf), tables.items(spark, sf))


@query("user_activity")
def _(spark, sf):
    return joins.user_activity(tables.event_shares(spark, sf))


@query("test_feature_join")
def _(spark, sf):
    train, queries = _stored(spark, sf)
    return joins.test_feature_join(
        queries.select("triple_id", "inviter_id", "item_id"),
        train,
        tables.users(spark, sf),
        tables.items(spark, sf),
    )


@query("has_interaction")
def _(spark, sf):
    queries = tables.query_shares(spark, sf).select("triple_id", "inviter_id", "item_id")
    return joins.has_interaction(queries, tables.train_shares(spark, sf))


@query("count_with_user_attr")
def _(spark, sf):
    return joins.count_with_user_attr(tables.event_shares(spark, sf), tables.users(spark, sf))


@query("count_with_item_attr")
def _(spark, sf):
    return joins.count_with_item_attr(tables.order_shares(spark, sf), tables.items(spark, sf))


@query("topn_filter")
def _(spark, sf):
    return joins.topn_filter(tables.event_shares(spark, sf).drop("ts"), 30, 30)


@query("remaining_users")
def _(spark, sf):
    return joins.remaining_users(tables.users(spark, sf), _history(spark, sf))


# --- aggregations ----------------------------------------------------------


@query("gender_distribution")
def _(spark, sf):
    return rounded(profile.gender_distribution(tables.users(spark, sf)))


@query("age_distribution")
def _(spark, sf):
    return profile.age_distribution(tables.users(spark, sf))


@query("level_distribution")
def _(spark, sf):
    return profile.level_distribution(tables.users(spark, sf))


for _name, _column in (
    ("top_categories", "cate_id"),
    ("top_level1_categories", "cate_level1_id"),
    ("top_brands", "brand_id"),
):
    QUERIES[_name] = lambda spark, sf, _column=_column: profile.top_values(tables.items(spark, sf), _column)

for _name, _operator in (
    ("daily_counts", profile.daily_counts),
    ("hourly_counts", profile.hourly_counts),
    ("weekday_counts", profile.weekday_counts),
    ("weekend_effect", profile.weekend_effect),
    ("activity_stats", profile.activity_stats),
    ("top_inviters", profile.top_inviters),
    ("top_voters", profile.top_voters),
    ("hour_weekday_matrix", profile.hour_weekday_matrix),
    ("hour_weekday_hotspot", profile.hour_weekday_hotspot),
    ("date_hour_matrix", profile.date_hour_matrix),
    ("date_hour_hotspot", profile.date_hour_hotspot),
    ("daily_trend_ma7", trends.daily_trend),
    ("daily_extremes", trends.daily_extremes),
    ("user_user_counts", profile.user_user_counts),
    ("topk_voters_per_inviter", trends.topk_voters_per_inviter),
    ("graph_edges", graph.graph_edges),
    ("bipartite_degrees", graph.bipartite_degrees),
    ("bipartite_size", graph.bipartite_size),
    ("log_count_matrix", similarity.log_count_matrix),
    ("user_distance_pairs", similarity.user_distance_pairs),
    ("user_cluster_tree", clusters.user_cluster_tree),
    ("item_cluster_tree", clusters.item_cluster_tree),
    ("clustered_matrix", clusters.clustered_matrix),
    ("node_index", recommend.node_index),
):
    QUERIES[_name] = lambda spark, sf, _operator=_operator: rounded(_operator(tables.event_shares(spark, sf)))

for _name, _operator in (
    ("top_items", profile.top_items),
    ("inviter_return_rate", profile.inviter_return_rate),
    ("return_rate_by_activity", profile.return_rate_by_activity),
    ("item_return_rate", lambda s: profile.item_return_rate(s, MIN_SHARES)),
    ("share_voter_regression", lambda s: profile.share_voter_regression(s, MIN_SHARES)),
    ("share_voter_regression_log", lambda s: profile.share_voter_regression(s, MIN_SHARES, log=True)),
    ("user_item_counts", profile.user_item_counts),
    ("item_popularity", profile.item_popularity),
    ("user_item_pivot", profile.user_item_pivot),
):
    QUERIES[_name] = lambda spark, sf, _operator=_operator: rounded(_operator(tables.order_shares(spark, sf)))


@query("dataset_stats")
def _(spark, sf):
    return rounded(_stats(spark, sf))


def _invites_with_users(spark: SparkSession, sf: str, limited: bool = False) -> DataFrame:
    counts = joins.count_with_user_attr(tables.event_shares(spark, sf), tables.users(spark, sf))
    return c.limit_range(counts, upper=INVITE_LIMIT) if limited else counts


for _suffix, _limited in (("", False), ("_limited", True)):
    QUERIES[f"gender_activity_stats{_suffix}"] = lambda spark, sf, _limited=_limited: rounded(
        profile.gender_activity_stats(_invites_with_users(spark, sf, _limited))
    )
    for _part in ("gender", "age", "level"):
        QUERIES[f"box_by_{_part}{_suffix}"] = lambda spark, sf, _limited=_limited, _part=_part: rounded(
            dist.box_stats(_invites_with_users(spark, sf, _limited), f"user_{_part}", "invite_count")
        )
    QUERIES[f"kde_by_group{_suffix}"] = lambda spark, sf, _limited=_limited: rounded(
        dist.kde_by_group(_invites_with_users(spark, sf, _limited), "user_gender", "invite_count")
    )


@query("kde_by_level")
def _(spark, sf):
    return rounded(dist.kde_by_group(_invites_with_users(spark, sf), "user_level", "invite_count"))


def _items_with_counts(spark: SparkSession, sf: str) -> DataFrame:
    return joins.count_with_item_attr(tables.order_shares(spark, sf), tables.items(spark, sf))


@query("box_by_category")
def _(spark, sf):
    return rounded(
        dist.box_stats(profile.largest_categories(_items_with_counts(spark, sf)), "cate_id", "share_count")
    )


for _name, _column in (
    ("avg_shares_by_category", "cate_id"),
    ("avg_shares_by_level1", "cate_level1_id"),
    ("avg_shares_by_brand", "brand_id"),
):
    QUERIES[_name] = lambda spark, sf, _column=_column: rounded(
        profile.average_shares_by(_items_with_counts(spark, sf), _column)
    )


@query("category_trend")
def _(spark, sf):
    return profile.category_trend(tables.order_shares(spark, sf), tables.items(spark, sf))


@query("user_category_counts")
def _(spark, sf):
    return profile.user_group_counts(
        tables.order_shares(spark, sf), tables.items(spark, sf), "cate_id", "cate_interaction_freq"
    )


@query("user_level1_counts")
def _(spark, sf):
    return profile.user_group_counts(
        tables.order_shares(spark, sf), tables.items(spark, sf), "cate_level1_id", "cate1_interaction_freq"
    )


@query("user_item_preference")
def _(spark, sf):
    entries = F.sort_array(F.map_entries("preference"))
    text = F.transform(entries, lambda e: F.concat_ws(":", e["key"].cast("string"), e["value"].cast("string")))
    return profile.user_item_preference(tables.order_shares(spark, sf)).select(
        "inviter_id", "part", F.array_join(text, ",").alias("preference")
    )


@query("gender_age_crosstab")
def _(spark, sf):
    return profile.gender_age_crosstab(tables.users(spark, sf))


@query("gender_age_percent")
def _(spark, sf):
    return rounded(profile.gender_age_percent(tables.users(spark, sf)))


# --- distributions ---------------------------------------------------------


def _invites(spark: SparkSession, sf: str) -> DataFrame:
    return profile.invite_counts(tables.event_shares(spark, sf)).select(F.col("invite_count").alias("v"))


def _votes(spark: SparkSession, sf: str) -> DataFrame:
    return profile.vote_counts(tables.event_shares(spark, sf)).select(F.col("voted_count").alias("v"))


def _edges(spark: SparkSession, sf: str) -> DataFrame:
    return graph.graph_edges(tables.event_shares(spark, sf))


def _in_degree(spark: SparkSession, sf: str) -> DataFrame:
    return graph.degrees(_edges(spark, sf)).select(F.col("in_degree").alias("v"))


def _out_degree(spark: SparkSession, sf: str) -> DataFrame:
    return graph.degrees(_edges(spark, sf)).select(F.col("out_degree").alias("v"))


for _what, _values, _bins in (
    ("invites", _invites, 50),
    ("votes", _votes, 50),
    ("in_degree", _in_degree, 30),
    ("out_degree", _out_degree, 30),
):
    for _log in (False, True):
        _end = "_log" if _log else ""

        def _input(spark, sf, _values=_values, _log=_log):
            values = _values(spark, sf)
            return values.where(F.col("v") > 0) if _log else values

        QUERIES[f"hist_{_what}{_end}"] = lambda spark, sf, _input=_input, _bins=_bins, _log=_log: rounded(
            dist.histogram(_input(spark, sf), "v", _bins, log=_log)
        )
        QUERIES["kde_curve" if _what + _end == "invites" else f"kde_{_what}{_end}"] = (
            lambda spark, sf, _input=_input, _log=_log: rounded(dist.kde_curve(_input(spark, sf), "v", log=_log))
        )


@query("share_intervals")
def _(spark, sf):
    return rounded(
        trends.share_intervals(tables.event_shares(spark, sf)).select(
            "inviter_id", F.unix_micros("ts").alias("ts_micros"), "interval_hours", "n"
        )
    )


def _intervals(spark: SparkSession, sf: str, log: bool) -> DataFrame:
    intervals = trends.share_intervals(tables.event_shares(spark, sf))
    return intervals if log else intervals.where(F.col("interval_hours") <= 24)


for _log in (False, True):
    _end = "_log" if _log else ""
    QUERIES[f"hist_intervals{_end}"] = lambda spark, sf, _log=_log: rounded(
        dist.histogram(_intervals(spark, sf, _log), "interval_hours", 50, "n", log=_log)
    )
    QUERIES[f"kde_intervals{_end}"] = lambda spark, sf, _log=_log: rounded(
        dist.kde_curve(_intervals(spark, sf, _log), "interval_hours", "n", log=_log)
    )


# --- graph and similarity --------------------------------------------------

for _name, _operator in (
    ("degree_stats", graph.degree_stats),
    ("node_roles", graph.node_roles),
    ("graph_hubs", graph.graph_hubs),
    ("graph_size", graph.graph_size),
):
    QUERIES[_name] = lambda spark, sf, _operator=_operator: rounded(_operator(_edges(spark, sf)))


@query("betweenness")
def _(spark, sf):
    return rounded(graph.betweenness(_edges(spark, sf)))


@query("network_features")
def _(spark, sf):
    edges = _edges(spark, sf)
    return rounded(graph.network_features(edges, graph.betweenness(edges)))


@query("user_similarity")
def _(spark, sf):
    return rounded(similarity.user_similarity(tables.event_shares(spark, sf), threshold=COSINE))


@query("similarity_degrees")
def _(spark, sf):
    return similarity.similarity_degrees(tables.event_shares(spark, sf), threshold=COSINE)


# --- sampling and splits ---------------------------------------------------


@query("sample_n")
def _(spark, sf):
    return sampling.sample_n(tables.event_shares(spark, sf).drop("ts"), 1000, ["event_id"])


@query("sample_nodes_subgraph")
def _(spark, sf):
    edges = _edges(spark, sf)
    return graph.induced_subgraph(edges, sampling.sample_nodes(graph.graph_nodes(edges), 100))


@query("sample_rate")
def _(spark, sf):
    return sampling.sample_rate(tables.event_shares(spark, sf).drop("ts"), 0.3, ["event_id"])


@query("train_val_test_split")
def _(spark, sf):
    split = sampling.train_val_test_split(tables.event_shares(spark, sf), ["event_id"])
    return split.select("event_id", "split")


# --- recommendation and evaluation -----------------------------------------


@query("history_candidates")
def _(spark, sf):
    return listed(_history(spark, sf))


@query("pad_candidates")
def _(spark, sf):
    return listed(recommend.pad_candidates(_history(spark, sf), tables.users(spark, sf), 8))


def _scored(spark: SparkSession, sf: str, k: int = 5) -> DataFrame:
    train, queries = _stored(spark, sf)
    return recommend.score_all_candidates(queries, train, tables.users(spark, sf), k)


@query("score_all_candidates")
def _(spark, sf):
    return rounded(_scored(spark, sf).drop("inviter_id", "item_id"))


@query("pair_features")
def _(spark, sf):
    train, queries = _stored(spark, sf)
    users = tables.users(spark, sf)
    pairs = recommend.score_all_candidates(queries, train, users).drop("rank", "score")
    return recommend.pair_features(pairs, train, users)


@query("train_ranker")
def _(spark, sf):
    train, queries = _stored(spark, sf)
    path = scratch_path(spark, "ranker")
    return rounded(runs.rank_with_model(train, queries, tables.users(spark, sf), TRAIN_START, path))


@query("user_item_embeddings")
def _(spark, sf):
    users, items = embedding.user_item_embeddings(tables.event_shares(spark, sf))
    rows = users.select(F.lit("user").alias("kind"), F.col("user_id").alias("node"), "vector").unionByName(
        items.select(F.lit("item").alias("kind"), F.col("item_id").alias("node"), "vector")
    )
    # Adding 0 makes -0.0 the same as 0.0.
    parts = [(F.round(F.col("vector")[d], 6) + 0.0).alias(f"e{d}") for d in range(embedding.DIMENSIONS)]
    return rows.select("kind", "node", *parts)


@query("recommend_by_embedding")
def _(spark, sf):
    train, queries = _stored(spark, sf)
    return rounded(embedding.recommend_by_embedding(queries, train))


@query("mrr_at_k")
def _(spark, sf):
    return rounded(evaluate.mrr_at_k(_history(spark, sf), tables.query_shares(spark, sf)))


@query("hits_at_k")
def _(spark, sf):
    return rounded(evaluate.hits_at_k(_history(spark, sf), tables.query_shares(spark, sf)))
