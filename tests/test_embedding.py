"""Vectors against plain message passing; the block search against scoring everyone."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest

from sharelens.operators import embedding


def plain_vectors(log, first_user, first_item, layers):
    users, items = defaultdict(set), defaultdict(set)
    for a, i, v, _ in log:
        for u in (a, v):
            users[u].add(i)
            items[i].add(u)
    u_layers, i_layers = [first_user], [first_item]
    for _ in range(layers):
        u, i = u_layers[-1], i_layers[-1]
        weight = {(a, b): 1 / math.sqrt(len(users[a]) * len(items[b])) for a in users for b in users[a]}
        u_layers.append({a: sum(weight[a, b] * i[b] for b in users[a]) for a in users})
        i_layers.append({b: sum(weight[a, b] * u[a] for a in items[b]) for b in items})
    return [{n: sum(layer[n] for layer in all_) / len(all_) for n in all_[0]} for all_ in (u_layers, i_layers)]


@pytest.fixture(scope="module")
def log():
    draw = random.Random(5)
    # One item holds a third of all shares.
    return [(draw.randrange(1, 25), draw.choice([1, draw.randrange(1, 12)]), draw.randrange(1, 40), s) for s in range(250)]


def vectors(frame, key):
    return {r[key]: np.array(r["vector"]) for r in frame.collect()}


@pytest.mark.parametrize("layers", [0, 1, 3])
def test_layers_equal_plain_message_passing(shares_of, log, layers):
    shares = shares_of([*log, (None, 3, 1, 900), (1, 3, None, 901)])
    first = embedding.user_item_embeddings(shares, 4, 0)
    users, items = embedding.user_item_embeddings(shares, 4, layers)
    start = vectors(first[0], "user_id"), vectors(first[1], "item_id")
    assert all(abs(x) <= 0.5 for v in start[0].values() for x in v)
    log = [*log, (1, 3, 1, 0)]
    expected = plain_vectors(log, *start, layers)
    for found, want in zip((vectors(users, "user_id"), vectors(items, "item_id")), expected):
        assert found.keys() == want.keys()
        assert all(np.allclose(found[n], want[n], atol=1e-12) for n in want)


def search(spark, queries, users, k, block):
    q = spark.createDataFrame([(i, v) for i, v in queries], "triple_id long, vector array<long>")
    u = spark.createDataFrame(users, "user_id long, vector array<long>")
    found = defaultdict(list)
    for r in embedding.top_users_by_inner_product(q, u, ["triple_id"], k, block).orderBy("triple_id", "rank").collect():
        found[r.triple_id].append((r.user_id, r.score))
    return dict(found)


def plain_search(queries, users, k):
    return {
        i: sorted(((u, sum(a * b for a, b in zip(q, v))) for u, v in users), key=lambda x: (-x[1], x[0]))[:k]
        for i, q in queries
        if users
    }


@pytest.mark.parametrize("block", [1, 7, 1000])
def test_blocks_equal_scoring_everyone(spark, block):
    draw = random.Random(6)
    users = [(u, [draw.randrange(-50, 50) * draw.choice([1, 1, 1, 20]) for _ in range(3)]) for u in range(1, 61)]
    users += [(u, [5, 5, 5]) for u in range(100, 110)]  # ties
    queries = [(i, [draw.randrange(-9, 10) for _ in range(3)]) for i in range(25)] + [(99, [0, 0, 0]), (98, [-1, -1, -1])]
    assert search(spark, queries, users, 4, block) == plain_search(queries, users, 4)


def test_blocks_that_cannot_win_stay_closed(spark, monkeypatch):
    users = [(u, [1000 if u < 5 else 1, 0]) for u in range(80)]
    seen = []
    scored = embedding._scored
    monkeypatch.setattr(embedding, "_scored", lambda met, blocks, k: seen.append(met.count()) or scored(met, blocks, k))
    assert search(spark, [(0, [3, 0])], users, 3, 5) == plain_search([(0, [3, 0])], users, 3)
    assert seen == [1]


def test_no_row_for_a_query_and_a_block(spark, monkeypatch):
    """Vectors of one length keep every block open; still a round holds each query once."""
    users = [(u, [1000 - u % 7, u % 7]) for u in range(80)]
    queries = [(i, [3, i]) for i in range(10)]
    seen = []
    scored = embedding._scored
    monkeypatch.setattr(embedding, "_scored", lambda met, blocks, k: seen.append(met.count()) or scored(met, blocks, k))
    assert search(spark, queries, users, 3, 2) == plain_search(queries, users, 3)
    assert max(seen) == 10


def test_runs_of_blocks_equal_scoring_everyone(spark, monkeypatch):
    """Several runs, parts of few queries, and numbers too large for doubles."""
    for name, value in (("RUN_USERS", 9), ("QUERY_ROWS", 4), ("SCORED_ROWS", 3)):
        monkeypatch.setattr(embedding, name, value, raising=False)
    draw = random.Random(8)
    for most in (40, 2**30):
        users = [(u, [draw.randrange(-most, most) for _ in range(3)]) for u in range(1, 50)]
        users += [(u, users[0][1]) for u in range(100, 105)]
        queries = [(i, [draw.randrange(-most, most) for _ in range(3)]) for i in range(14)] + [(99, [0, 0, 0])]
        assert search(spark, queries, users, 4, 3) == plain_search(queries, users, 4)


def test_few_users_and_no_rows(spark):
    assert search(spark, [(0, [1, 1])], [(7, [2, 2])], 5, 10) == {0: [(7, 4)]}
    assert search(spark, [(0, [1, 1])], [], 5, 10) == {}
    assert search(spark, [], [(7, [2, 2])], 5, 10) == {}


def test_unknown_inviters_and_items(spark, shares_of, log):
    rows = [("a", 1, 1), ("b", 999, 2), ("c", 3, 999), ("d", 998, 999)]
    queries = spark.createDataFrame(rows, "triple_id string, inviter_id long, item_id long")
    found = embedding.recommend_by_embedding(queries, shares_of(log), 3)
    assert {r.triple_id: r["count"] for r in found.groupBy("triple_id").count().collect()} == {"a": 3, "b": 3, "c": 3}
