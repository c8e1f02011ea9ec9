import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sharelens.operators import evaluate, profile, ranker, ranking, recommend
from sharelens.plans import runs
from sharelens.sources import jsonl, tables

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def users(spark):
    return spark.createDataFrame([(i, i % 3 - 1, 1, 1) for i in range(1, 31)], "user_id long, user_gender int, user_age int, user_level int")


@pytest.fixture(scope="module")
def log():
    random.seed(4)
    return [(random.randrange(1, 12), random.randrange(1, 9), random.randrange(1, 20), s) for s in range(300)]


@pytest.fixture(scope="module")
def queries(spark):
    rows = [(str(i), i % 14 + 1, i % 11 + 1) for i in range(60)]
    return spark.createDataFrame(rows, "triple_id string, inviter_id long, item_id long")


def test_history(shares_of, queries):
    train = shares_of([(1, 1, v, s) for s, v in enumerate([7, 7, 9, 8, 8, 8, 3, 2, 1, 9])] + [(2, 1, 4, 99), (2, 1, 5, 98)])
    found = {r.triple_id: r.candidate_voter_list for r in recommend.history_candidates(queries, train).collect()}
    assert found["0"] == ["8", "7", "9", "1", "2"]  # ties: the smaller id first
    assert found["1"] == ["4", "5"]
    assert found["2"] == []
    assert len(found) == 60


def test_padding(spark, users):
    rows = [("a", []), ("b", ["3", "4"]), ("c", [str(i) for i in range(1, 9)])]
    lists = spark.createDataFrame(rows, "triple_id string, candidate_voter_list array<string>")
    found = {r.triple_id: r.candidate_voter_list for r in recommend.pad_candidates(lists, users, 5).collect()}
    assert all(len(v) == len(set(v)) == 5 for v in found.values())
    assert found["b"][:2] == ["3", "4"] and found["c"] == ["1", "2", "3", "4", "5"]
    few = recommend.pad_candidates(lists, users.limit(3), 5).where("triple_id = 'a'").first()
    assert len(few.candidate_voter_list) == 3


@pytest.mark.parametrize("weights", [(1.0, 1.0, 1.0), (0.2, 1.0, 3.0)])
def test_scores_equal_scoring_everyone(shares_of, users, queries, log, weights):
    train = shares_of(log)
    k = 4
    by_inviter, by_item = Counter((a, v) for a, _, v, _ in log), Counter((i, v) for _, i, v, _ in log)
    inviters, items = Counter(r[0] for r in log), Counter(r[1] for r in log)
    votes = Counter(r[2] for r in log)
    expected = {}
    for q in queries.collect():
        scored = []
        for u in range(1, 31):
            score = max(
                by_inviter[q.inviter_id, u] / max(inviters[q.inviter_id], 1) * weights[0],
                by_item[q.item_id, u] / max(items[q.item_id], 1) * weights[1],
                votes[u] / len(log) * weights[2],
            )
            scored.append((-score, u))
        expected[q.triple_id] = [u for _, u in sorted(scored)[:k]]
    scored = recommend.score_all_candidates(queries, train, users, k, weights)
    found = {}
    for r in scored.orderBy("triple_id", "rank").collect():
        found.setdefault(r.triple_id, []).append(r.voter_id)
    assert found == expected


def test_row_index_is_dense(spark):
    frame = spark.range(1000).select((F.col("id") * 37 % 1000).alias("x")).repartition(7)
    rows = recommend.row_index(frame, ["x"], "place").collect()
    assert all(r.x == r.place for r in rows) and len(rows) == 1000


def test_metrics(spark):
    lists = spark.createDataFrame([("a", ["1", "2"]), ("b", ["3", "9"]), ("c", [])], "triple_id string, candidate_voter_list array<string>")
    truth = spark.createDataFrame([("a", 1), ("b", 9), ("c", 4), ("d", 5)], "triple_id string, voter_id long")
    assert tuple(evaluate.mrr_at_k(lists, truth).first()) == (0.375, 4)
    assert tuple(evaluate.hits_at_k(lists, truth).first()) == (0.5, 4)
    assert evaluate.mrr_at_k(lists, truth, 1).first().mrr == 0.25


def test_ranker_repeats_and_beats_random(spark, shares_of, users, tmp_path):
    random.seed(9)
    favourite = {i: random.sample(range(1, 31), 2) for i in range(1, 16)}
    log = []
    for s in range(900):
        a = random.randrange(1, 16)
        log.append((a, random.randrange(1, 9), random.choice(favourite[a]), s))
    shares = shares_of(log)
    cut = F.lit("2024-01-01 00:12:00").cast("timestamp")
    train, held = shares.where(F.col("ts") < cut), shares.where(F.col("ts") >= cut)
    held = held.withColumn("triple_id", F.unix_seconds("ts").cast("string"))
    path = str(tmp_path / "model")
    first = runs.rank_with_model(train, held, users, "2024-01-01 00:08:00", path)
    rows = sorted(tuple(r) for r in first.collect())
    again = runs.predict(train, held, users, path)
    assert rows == sorted(tuple(r) for r in again.collect())
    mrr = evaluate.mrr_at_k(recommend.to_lists(first), held).first().mrr
    assert mrr > 3 * (1 + 1 / 2 + 1 / 3 + 1 / 4 + 1 / 5) / 30
    out = str(tmp_path / "predictions")
    runs.predict_and_write(train, held, users, path, out)
    lists = spark.read.json(out)
    assert lists.count() == held.count()
    assert lists.where(F.size("candidate_voter_list") != 5).count() == 0
    trees = ranker.train_ranker(ranker.training_rows(train, held, users), trees=True)
    assert trees.stages[-1].featureImportances.size == 11


def plain_terms(users, log, weights):
    """The model's score of (inviter, item, user) in billionths, from the rows themselves."""
    traits = {u.user_id: tuple(-1 if v is None else v for v in (u.user_gender, u.user_age, u.user_level)) for u in users}
    pairs, items = Counter((a, v) for a, _, v, _ in log), Counter((i, v) for _, i, v, _ in log)
    inviters, popular = Counter(a for a, _, _, _ in log), Counter(i for _, i, _, _ in log)
    votes = Counter(v for _, _, v, _ in log)
    none = (-1, -1, -1)
    met = [Counter() for _ in none]
    own = [Counter() for _ in none]
    for a, _, v, _ in log:
        for t in range(3):
            own[t][traits.get(a, none)[t]] += 1
            if v in traits:
                met[t][traits.get(a, none)[t], traits[v][t]] += 1
    sizes = [Counter(x[t] for x in traits.values()) for t in range(3)]

    def score(a, i, u):
        found = [pairs[a, u] / max(inviters[a], 1), items[i, u] / max(popular[i], 1), votes[u] / max(len(log), 1)]
        for t in range(3):
            mine, other = traits.get(a, none)[t], traits[u][t]
            seen = a in inviters and own[t][mine]
            found.append(met[t][mine, other] / own[t][mine] / (sizes[t][other] / len(traits)) if seen else 0.0)
        return sum(int(math.floor(w * x * 1e9 + 0.5)) for w, x in zip(weights, found))

    return score


@pytest.mark.parametrize("depth", [1, 2, 16])
@pytest.mark.parametrize("weights", [(0.5, 0.5, 0.3, 0.1, 0.1, 0.1), (1.0, 1.0, 0.0, 0.0, 0.0, 0.0), (0.0, 0.0, 1.0, 0.0, 0.01, 0.0)])
def test_threshold_algorithm_equals_scoring_everyone(shares_of, users, queries, log, depth, weights):
    """Rows that only the sum of two lists brings up, ties, unknown inviters, voters who are no users."""
    log = [*log, *[(1, 1, 99, 500 + s) for s in range(20)], *[(77, 2, s % 30 + 1, 600 + s) for s in range(40)]]
    score = plain_terms(users.collect(), log, weights)
    found = {}
    ranked = ranking.rank_all_users(queries, shares_of(log), users, weights, 4, depth)
    for r in ranked.orderBy("triple_id", "rank").collect():
        found.setdefault(r.triple_id, []).append((r.voter_id, round(r.score * 1e9)))
    everyone = [u.user_id for u in users.collect()]
    for q in queries.collect():
        best = sorted(everyone, key=lambda u: (-score(q.inviter_id, q.item_id, u), u))[:4]
        assert found[q.triple_id] == [(u, score(q.inviter_id, q.item_id, u)) for u in best]


def test_trained_model_is_fitted_to_all_features(spark, shares_of, users, queries, log, tmp_path):
    train, path = shares_of(log), str(tmp_path / "model")
    runs.train_model(train, users, "2024-01-01 00:03:00", path)
    weights = ranking.load_model(spark, path)
    assert len(weights) == 6 and min(weights) >= 0 < max(weights)
    score = plain_terms(users.collect(), log, weights)
    found = {}
    for r in runs.predict(train, queries, users, path, 25).orderBy("triple_id", "rank").collect():
        found.setdefault(r.triple_id, []).append(r.voter_id)
    for q in queries.collect():
        assert found[q.triple_id] == sorted(range(1, 31), key=lambda u: (-score(q.inviter_id, q.item_id, u), u))[:25]
    with pytest.raises(Exception):
        runs.predict(train, queries, users, str(tmp_path / "none"))
    with pytest.raises(ValueError):
        ranking.rank_all_users(queries, train, users, (1, 1, 1, 1, 1, -1))


def test_weights_are_the_least_squares_ones(spark):
    draw = np.random.default_rng(1)
    x = draw.random((400, 6))
    y = x @ [0.5, 0.0, 0.3, 0.2, 0.0, 0.1] + draw.normal(0, 0.01, 400)
    rows = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)], ", ".join(f"{f} double" for f in [*ranking.FEATURES, "label"]))
    assert np.allclose(ranking.fit(rows), [0.5, 0.0, 0.3, 0.2, 0.0, 0.1], atol=0.01)
    assert ranking.fit(rows.limit(0)) == (1.0,) * 6
    assert min(ranking.fit(rows.withColumn("label", -F.col("label")))) >= 0


def test_few_users_and_no_rows(spark, shares_of, users, queries, log):
    few = users.where("user_id <= 3")
    ranked = ranking.rank_all_users(queries, shares_of(log), few, (1.0,) * 6)
    assert {r["count"] for r in ranked.groupBy("triple_id").count().collect()} == {3}
    assert ranking.rank_all_users(queries.limit(0), shares_of(log), users, (1.0,) * 6).collect() == []
    none = ranking.rank_all_users(queries, shares_of(log).limit(0), users, (1.0,) * 6)
    assert {(r.rank, r.voter_id, r.score) for r in none.collect()} == {(i, i, 0.0) for i in range(1, 6)}


def test_long_lists_of_an_item_are_not_gone_through_per_query(spark, shares_of, monkeypatch):
    """600 voters of one item, all with the same share: a query scores its inviter's own and the item's best."""
    users = spark.range(1, 601).selectExpr("id AS user_id", "0 AS user_gender", "1 AS user_age", "1 AS user_level")
    log = [(v % 200 + 1, 1, v, v) for v in range(1, 601)]
    asked = spark.range(1, 11).selectExpr("string(id) AS triple_id", "id AS inviter_id", "1L AS item_id")
    sizes, kept = [], ranking.checkpointed

    def counted(frame):
        stored = kept(frame)
        if {"triple_id", "voter_id"} <= set(stored.columns):
            sizes.append(stored.count())
        return stored

    monkeypatch.setattr(ranking, "checkpointed", counted)
    ranked = ranking.rank_all_users(asked, shares_of(log), users, (1.0, 1.0, 0.0, 0.0, 0.0, 0.0))
    found = {(r.triple_id, r["rank"]): r.voter_id for r in ranked.collect()}
    for i in range(1, 11):
        own = [v for v in range(1, 601) if v % 200 + 1 == i]
        assert [found[str(i), n] for n in range(1, 6)] == [*own, *[v for v in range(1, 9) if v not in own]][:5]
    assert max(sizes) <= 10 * (ranking.FIRST_DEPTH + 5)


def test_missing_model_is_an_error(tmp_path, spark):
    with pytest.raises(Exception):
        ranker.load_ranker(str(tmp_path / "none"))


def test_negatives_are_never_the_voter(shares_of, users, log):
    pairs = shares_of(log).select("inviter_id", "item_id", "voter_id", "ts")
    drawn = ranker.negative_pairs(pairs, users, per_row=3)
    assert drawn.join(pairs, pairs.columns, "left_semi").count() == 0
    assert 700 < drawn.count() <= 900
    again = ranker.negative_pairs(pairs.repartition(5), users, per_row=3)
    assert sorted(map(tuple, drawn.collect())) == sorted(map(tuple, again.collect()))


def test_whole_run_from_json_lines(spark, tmp_path):
    """Text ids, straight from the four input files to written predictions."""
    for name, frame in (
        ("shares", tables.train_shares(spark, SF_DIR).withColumnRenamed("ts", "timestamp").drop("event_id")),
        ("queries", tables.query_shares(spark, SF_DIR).withColumnRenamed("ts", "timestamp").drop("event_id", "voter_id")),
        ("users", tables.users(spark, SF_DIR)),
        ("items", tables.items(spark, SF_DIR)),
    ):
        if "timestamp" in frame.columns:
            frame = frame.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
        ids = [c for c in frame.columns if c.endswith("_id")]
        frame.withColumns({c: F.col(c).cast("string") for c in ids}).write.json(str(tmp_path / name))
    shares = jsonl.read_shares(spark, str(tmp_path / "shares"))
    queries = jsonl.read_queries(spark, str(tmp_path / "queries"))
    users = jsonl.read_users(spark, str(tmp_path / "users"))
    items = jsonl.read_items(spark, str(tmp_path / "items"))
    assert dict(shares.dtypes) == {"inviter_id": "string", "item_id": "string", "voter_id": "string", "ts": "timestamp"}

    found = runs.build_features(shares, queries, users, items, str(tmp_path / "features"), 20)
    assert spark.read.option("header", True).csv(found["test_features"]).count() == queries.count()
    names = runs.profile_log(shares, queries, users, items, str(tmp_path / "profile"))
    assert len(names) >= 70
    n = shares.count()
    assert spark.read.parquet(names["bipartite_size"]).first().connections == n
    assert spark.read.parquet(names["daily_counts"]).agg(F.sum("n")).first()[0] == n
    assert spark.read.json(names["dataset_stats"]).first().train_rows == n
    votes = profile.vote_counts(shares).count()
    assert spark.read.parquet(names["hist_votes"]).agg(F.sum("n")).first()[0] == votes
    runs.train_model(shares, users, "2024-01-19 00:00:00", str(tmp_path / "model"))
    runs.predict_and_write(shares, queries, users, str(tmp_path / "model"), str(tmp_path / "out"))
    lists = jsonl.read_jsonl(spark, str(tmp_path / "out"), "triple_id string, candidate_voter_list array<string>")
    assert lists.count() == queries.count()
    assert lists.where(F.size(F.array_distinct("candidate_voter_list")) != 5).count() == 0


def test_features_are_written(spark, tmp_path):
    train, queries = tables.train_shares(spark, SF_DIR), tables.query_shares(spark, SF_DIR)
    users, items = tables.users(spark, SF_DIR), tables.items(spark, SF_DIR)
    found = runs.build_features(train, queries, users, items, str(tmp_path / "features"), 50)
    assert len(found) == 10
    counts = spark.read.option("header", True).option("inferSchema", True).csv(found["user_user_matrix"])
    assert counts.agg(F.sum("interaction_count")).first()[0] == train.count()
    features = spark.read.option("header", True).csv(found["test_features"])
    assert features.count() == queries.count() and "has_interaction" in features.columns
    assert spark.read.json(found["test_candidates"]).count() == queries.count()


def test_candidates_are_users(spark, shares_of):
    users = spark.createDataFrame([(i, 0, 1, 1) for i in range(1, 8)], "user_id long, user_gender int, user_age int, user_level int")
    train = shares_of([(1, 5, 99, s) for s in range(4)] + [(1, 5, 2, 9)])
    queries = spark.createDataFrame([("q", 1, 5)], "triple_id string, inviter_id long, item_id long")
    rows = recommend.score_all_candidates(queries, train, users).collect()
    assert [r.voter_id for r in sorted(rows, key=lambda r: r.rank)] == [2, 1, 3, 4, 5]
    assert min(rows, key=lambda r: r.rank).score == pytest.approx(0.2)
    with pytest.raises(ValueError):
        recommend.score_all_candidates(queries, train, users, weights=(1.0, -1.0, 1.0))


def test_validation_on_held_out_rows(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    shares = tables.event_shares(spark, sf)
    scores = runs.train_and_validate(
        shares, tables.users(spark, sf), "2024-01-15 00:00:00", str(tmp_path / "model"), ["event_id"], rate=0.8
    )
    found = {r.split: r for r in scores.collect()}
    assert set(found) == {"val", "test"}
    assert all(r.queries > 0 and 0 <= r.mrr <= r.hits <= 1 for r in found.values())
    assert found["test"].queries > found["val"].queries
