"""Kernel densities against the direct sum over all values."""

import math
import random

import pytest
from pyspark.sql import functions as F

from sharelens.operators.distribution import CELL, kde_by_group, kde_curve


def direct(values, grid):
    n, low, high = len(values), min(values), max(values)
    mean = math.fsum(values) / n
    h = n ** -0.2 * math.sqrt(math.fsum((v - mean) ** 2 for v in values) / (n - 1))
    points = [low + p * (high - low) / (grid - 1) for p in range(grid)]
    sums = [math.fsum(math.exp(-0.5 * ((x - v) / h) ** 2) for v in values) for x in points]
    return [s / (n * h * math.sqrt(2 * math.pi)) for s in sums]


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def random_values(kind, n=400):
    dice = random.Random(kind)
    if kind == "tail":
        return [dice.paretovariate(0.9) for _ in range(n)]
    if kind == "far":
        return [dice.gauss(1e6, 1e-3) for _ in range(n)] + [1e6 + 50.0]
    return [dice.choice([0.0, 1.0, 1.0, 7.5, -3.25]) for _ in range(n)]


@pytest.mark.parametrize("kind", ["tail", "far", "ties"])
def test_curve_equals_the_direct_sum(spark, kind):
    values = random_values(kind)
    got = kde_curve(table(spark, [(v,) for v in values] + [(None,)], "v double"), "v").orderBy("point").collect()
    want = direct(values, 200)
    # The bandwidth itself has some ten digits where values lie far from 0.
    near = 1e-6 if kind == "far" else 1e-10
    assert [r.point for r in got] == list(range(200))
    assert [r.density for r in got] == pytest.approx(want, rel=near, abs=1e-290)


def test_groups_equal_their_direct_sums(spark):
    sets = {g: random_values(g) for g in ("tail", "ties")}
    rows = [(g, v) for g, vs in sets.items() for v in vs] + [("flat", 2.0)] * 5 + [("one", 1.0), (None, 1.0), ("ties", None)]
    got = kde_by_group(table(spark, rows, "g string, v double"), "g", "v").orderBy("g", "point").collect()
    assert {r.g for r in got} == set(sets)
    for group, values in sets.items():
        assert [r.density for r in got if r.g == group] == pytest.approx(direct(values, 100), rel=1e-10, abs=1e-290)


def test_work_follows_cells_not_distinct_values(spark):
    frame = spark.range(200_000).select((F.col("id") / 200_000.0).alias("v"))
    got = kde_curve(frame, "v").orderBy("point").collect()
    h = 200_000 ** -0.2 / math.sqrt(12)
    assert 1 / (CELL * h) < 400  # cells, for 200,000 distinct values
    assert got[100].density == pytest.approx(1.0, rel=1e-4)
    assert got[0].density == pytest.approx(0.5, rel=1e-2)


def test_empty(spark):
    assert kde_curve(table(spark, [], "v double"), "v").collect() == []
    assert kde_curve(table(spark, [(1.0,), (1.0,)], "v double"), "v").collect() == []
