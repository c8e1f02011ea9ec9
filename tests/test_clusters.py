"""Average linkage against merging a single closest pair at a time."""

import itertools
import random
from fractions import Fraction

import pytest

from sharelens.operators.clusters import DISTANCE_UNIT, average_linkage


def plain(distance):
    """``(a, b, height, n)`` of each merge and the final clusters with their leaves in order."""
    units = {pair: round(d * DISTANCE_UNIT) for pair, d in distance.items()}
    clusters = {m: [m] for pair in distance for m in pair}
    merges = []
    while len(clusters) > 1:
        def mean(a, b):
            found = [units.get((min(x, y), max(x, y))) for x in clusters[a] for y in clusters[b]]
            found = [u for u in found if u is not None]
            return Fraction(sum(found), len(found)) if found else None

        near = [(mean(a, b), a, b) for a, b in itertools.combinations(sorted(clusters), 2)]
        near = [x for x in near if x[0] is not None]
        if not near:
            break
        height, a, b = min(near)
        clusters[a] += clusters.pop(b)
        merges.append((a, b, float(height) / DISTANCE_UNIT, len(clusters[a])))
    return merges, clusters


def build(spark, distance, members):
    pairs = spark.createDataFrame([(a, b, d) for (a, b), d in distance.items()], "a long, b long, distance double")
    return average_linkage(pairs, spark.createDataFrame([(m,) for m in members], "member long"))


def check(spark, distance, members):
    tree, leaves = build(spark, distance, members)
    want, clusters = plain(distance)
    got = sorted(map(tuple, tree.collect()))
    assert [g[:2] + g[3:] for g in got] == [w[:2] + w[3:] for w in sorted(want)]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in sorted(want)])
    order = {}
    for row in leaves.orderBy("cluster", "place").collect():
        order.setdefault(row.cluster, []).append((row.place, row.member))
    assert {c: [m for _, m in found] for c, found in order.items() if len(found) > 1} == {
        c: found for c, found in clusters.items() if len(found) > 1
    }
    assert all([p for p, _ in found] == list(range(len(found))) for found in order.values())


@pytest.mark.parametrize("kind", ["plane", "grid"])
def test_equals_merging_one_pair_at_a_time(spark, kind):
    dice = random.Random(kind)
    # A grid of few places has many equal distances and members at the same place.
    draw = dice.random if kind == "plane" else lambda: float(dice.randint(0, 2))
    points = {m: (draw(), draw()) for m in dice.sample(range(100), 18)}
    distance = {
        (a, b): sum((x - y) ** 2 for x, y in zip(points[a], points[b])) ** 0.5
        for a, b in itertools.combinations(sorted(points), 2)
    }
    check(spark, distance, points)


def test_shells_and_apart(spark):
    # 1 < 2 < 3 ... lie inside each other, one merge a round; 20 and 21 are apart from them; 30 is alone.
    place = {m: 3.0 ** m for m in range(1, 6)}
    distance = {(a, b): abs(place[a] - place[b]) for a, b in itertools.combinations(place, 2)}
    check(spark, distance | {(20, 21): 0.5}, [*place, 20, 21, 30])


def test_empty_one_and_null(spark):
    tree, leaves = build(spark, {}, [])
    assert tree.collect() == [] and leaves.collect() == []
    tree, leaves = build(spark, {(1, 2): None}, [1, 2, 2])
    assert tree.collect() == [] and sorted(map(tuple, leaves.collect())) == [(1, 1, 0), (2, 2, 0)]


def test_members_of_any_type(spark):
    pairs = spark.createDataFrame([("x", "y", 1.0)], "a string, b string, distance double")
    tree, _ = average_linkage(pairs, spark.createDataFrame([("x",), ("y",)], "member string"))
    assert [tuple(r) for r in tree.collect()] == [("x", "y", 1.0, 2)]
    assert dict(tree.dtypes)["n_members"] == "bigint"
