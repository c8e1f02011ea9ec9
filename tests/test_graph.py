import random
from collections import defaultdict, deque

import pytest

from sharelens.operators import graph, sampling, similarity


@pytest.fixture(scope="module")
def edges_of(spark):
    return lambda rows: spark.createDataFrame(rows, "src long, dst long")


def brandes(nodes, edges):
    """Betweenness by one search per source, plain Python."""
    out = defaultdict(set)
    for a, b in edges:
        if a != b:
            out[a].add(b)
    total = dict.fromkeys(nodes, 0.0)
    for s in nodes:
        dist, sigma, before, order = {s: 0}, defaultdict(float, {s: 1.0}), defaultdict(list), []
        queue = deque([s])
        while queue:
            v = queue.popleft()
            order.append(v)
            for w in out[v]:
                if w not in dist:
                    dist[w] = dist[v] + 1
                    queue.append(w)
                if dist[w] == dist[v] + 1:
                    sigma[w] += sigma[v]
                    before[w].append(v)
        delta = defaultdict(float)
        for w in reversed(order):
            for v in before[w]:
                delta[v] += sigma[v] / sigma[w] * (1 + delta[w])
            if w != s:
                total[w] += delta[w]
    n = len(nodes)
    scale = 1 / ((n - 1) * (n - 2)) if n > 2 else 1.0
    return {v: x * scale for v, x in total.items()}


def test_path(edges_of):
    found = {r.user_id: r.betweenness for r in graph.betweenness(edges_of([(1, 2), (2, 3)])).collect()}
    assert found == {1: 0.0, 2: 0.5, 3: 0.0}


@pytest.mark.parametrize("seed", [1, 2])
def test_betweenness_against_search(edges_of, seed):
    random.seed(seed)
    rows = list({(random.randrange(25), random.randrange(25)) for _ in range(60)} | {(30, 30)})
    nodes = {v for e in rows for v in e}
    found = {r.user_id: r.betweenness for r in graph.betweenness(edges_of(rows)).collect()}
    assert found == pytest.approx(brandes(nodes, rows))


def test_betweenness_over_several_packs(spark):
    """A long way through named nodes: more sources than a pack holds, many levels; and no links at all."""
    size = graph.PACK + 3
    chain = [(f"n{i:02}", f"n{i + 1:02}") for i in range(size - 1)]
    frame = spark.createDataFrame([*chain, ("n00", "n02"), ("lone", "lone")], "src string, dst string")
    found = {r.user_id: r.betweenness for r in graph.betweenness(frame).collect()}
    nodes = {v for e in chain for v in e} | {"lone"}
    assert found == pytest.approx(brandes(nodes, [*chain, ("n00", "n02")]))
    alone = graph.betweenness(frame.where("src = 'lone'"))
    assert [tuple(r) for r in alone.collect()] == [("lone", 0.0)]
    assert graph.betweenness(frame.where("false")).count() == 0


def test_betweenness_of_a_sample(edges_of):
    rows = [(i, (i * k + 1) % 40) for i in range(40) for k in (1, 3, 7)]
    frame = edges_of(rows).distinct()
    kept = {r.user_id for r in sampling.sample_nodes(graph.graph_nodes(frame), 15).collect()}
    inside = {(a, b) for a, b in rows if a in kept and b in kept}
    found = {r.user_id: r.betweenness for r in graph.betweenness(frame, 15).collect()}
    assert found == pytest.approx(brandes(kept, inside))
    table = graph.network_features(frame, graph.betweenness(frame, 15))
    assert table.where("betweenness IS NULL").count() == 25


def test_degrees_and_loops(shares_of):
    shares = shares_of([(1, 9, 1, 0), (1, 9, 2, 1), (1, 8, 2, 2), (3, 9, 1, 3)])
    edges = graph.graph_edges(shares)
    found = {r.user_id: (r.in_degree, r.out_degree) for r in graph.degrees(edges).collect()}
    assert found == {1: (2, 2), 2: (1, 0), 3: (0, 1)}
    assert sum(i for i, _ in found.values()) == sum(o for _, o in found.values()) == edges.count()
    assert tuple(graph.graph_size(edges).first()) == (3, 3)
    roles = {r.user_id: r.role for r in graph.node_roles(edges).collect()}
    assert roles == {1: "sender", 2: "receiver", 3: "sender"}


def test_bipartite_sides_stay_apart(shares_of):
    shares = shares_of([(1, 1, 2, 0), (1, 2, 2, 1), (2, 1, 1, 2), (2, 1, 1, 3)])
    found = {(r.side, r.node_id): r.degree for r in graph.bipartite_degrees(shares).collect()}
    assert found == {("inviter", 1): 2, ("inviter", 2): 1, ("item", 1): 2, ("item", 2): 1}
    assert tuple(graph.bipartite_size(shares).first()) == (2, 2, 4)


def test_similarity(shares_of):
    log = [(1, 1, 9, 0), (1, 2, 9, 1), (2, 1, 9, 2), (2, 2, 9, 3), (3, 3, 9, 4)]
    pairs = similarity.user_similarity(shares_of(log)).collect()
    assert [(r.user_a, r.user_b) for r in pairs] == [(1, 2)]
    assert pairs[0].weight == pytest.approx(1.0)
    assert {r.user_id: r.degree for r in similarity.similarity_degrees(shares_of(log)).collect()} == {1: 1, 2: 1, 3: 0}
    assert similarity.log_count_matrix(shares_of(log)).count() == 9


def test_samples_repeat_and_splits_are_whole(spark):
    frame = spark.range(2000).withColumnRenamed("id", "event_id")
    first = {r.event_id for r in sampling.sample_n(frame, 300, ["event_id"]).collect()}
    again = {r.event_id for r in sampling.sample_n(frame.repartition(13), 300, ["event_id"]).collect()}
    assert len(first) == 300 and first == again
    assert sampling.sample_n(frame, 5000, ["event_id"]).count() == 2000
    assert sampling.sample_n(frame, 2000, ["event_id"]).count() == 2000
    other = {r.event_id for r in sampling.sample_n(frame, 300, ["event_id"], seed=7).collect()}
    assert other != first
    split = sampling.train_val_test_split(frame, ["event_id"])
    sizes = {r.split: r["count"] for r in split.groupBy("split").count().collect()}
    assert sum(sizes.values()) == 2000 and set(sizes) == {"train", "val", "test"}
    assert 300 < sizes["test"] < 500
    assert 500 < sampling.sample_rate(frame, 0.3, ["event_id"]).count() < 700
