"""Hot keys: the split paths give what the plain ones give."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sharelens.functions import skew
from sharelens.operators import profile, trends


@pytest.fixture(scope="module")
def facts(spark):
    """One key holds a third of the rows; some rows are copies; some keys have no match."""
    random.seed(1)
    rows = [(0 if i % 3 == 0 else random.randrange(1, 60), i // 2) for i in range(900)]
    rows += [(None, i % 4) for i in range(50)]
    return spark.createDataFrame(rows, "k long, v long").repartition(5)


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(k, f"name{k}") for k in range(40)], "k long, name string")


def _rows(frame):
    return sorted(map(str, frame.select("k", "v", "name").collect()))


def test_hot_keys_are_few(facts):
    assert [r.k for r in skew.hot_keys(facts, ["k"], 100).collect()] == [0]
    assert skew.hot_keys(facts, ["k"], 1000).count() == 0


def test_hot_list_is_bounded(facts, monkeypatch):
    monkeypatch.setattr(skew, "MAX_HOT_KEYS", 3)
    assert skew.hot_keys(facts, ["k"], 0).count() == 3


@pytest.mark.parametrize("hot_rows", [0, 10, 100, 10**6])
def test_joins_agree(facts, table, hot_rows):
    plain = _rows(facts.join(table, "k", "left"))
    assert _rows(skew.skew_join(facts, table, ["k"], hot_rows)) == plain
    assert _rows(skew.skew_join(facts, table, ["k"], hot_rows, facts.select("k"))) == plain
    assert _rows(skew.lookup_join(facts, table, ["k"], max_rows=5, hot_rows=hot_rows)) == plain
    assert _rows(skew.lookup_join(facts, table, ["k"])) == plain


def test_hot_and_null_rows_are_spread(spark, monkeypatch):
    """With the salt kept, the rows of the hot key and of no key sit in many parts."""
    facts = spark.createDataFrame([(None if i % 3 else 7, i) for i in range(300)], "k long, v long")
    table = spark.createDataFrame([(7, "seven")], "k long, name string")
    text = skew.skew_join(facts, table, ["k"], 50)._jdf.queryExecution().analyzed().toString()
    assert "_salt" in text
    salt = F.pmod(F.xxhash64(F.spark_partition_id(), "k", "v"), F.lit(16))
    spread = facts.groupBy("k", salt.alias("s")).count().groupBy("k").count().collect()
    assert len(spread) == 2 and all(r["count"] == 16 for r in spread)


def test_hot_list_is_the_same_twice(facts, monkeypatch):
    """Ties at the end of the list must not make its two uses differ."""
    monkeypatch.setattr(skew, "MAX_HOT_KEYS", 5)
    flat = facts.select("k").distinct()
    first = [r.k for r in skew.hot_keys(flat, ["k"], 0).collect()]
    assert first == [r.k for r in skew.hot_keys(flat.repartition(3), ["k"], 0).collect()] == [0, 1, 2, 3, 4]


def test_lookup_join_broadcasts_only_within_the_bound(facts, table):
    def hinted(max_rows):
        joined = skew.lookup_join(facts, table, ["k"], max_rows=max_rows)
        return joined._jdf.queryExecution().analyzed().toString().count("strategy=broadcast")

    assert hinted(40) == 1
    assert hinted(39) == 2  # the hot-key list, on either side; not the table


@pytest.mark.parametrize("step", [1, -1])
@pytest.mark.parametrize("small_rows", [0, 10**6])
def test_neighbour(spark, step, small_rows):
    random.seed(step)
    rows = [(0 if i % 3 == 0 else random.randrange(1, 9), random.randrange(400) * 7, i, i if i % 5 else None) for i in range(600)]
    frame = spark.createDataFrame(rows, "k long, t long, id long, v long")
    out = skew.neighbour(frame, "k", ["t", "id"], "v", "near", step, small_rows, stored=frame)
    expected = {}
    by_key = defaultdict(list)
    for k, t, i, v in rows:
        by_key[k].append((t, i, v))
    for group in by_key.values():
        group.sort(key=lambda r: r[:2])
        for place, (_, i, _) in enumerate(group):
            other = place + step
            expected[i] = group[other][2] if 0 <= other < len(group) else None
    assert {r.id: r.near for r in out.collect()} == expected


@pytest.mark.parametrize("small_rows", [0, 10**6])
def test_share_intervals_merge_equal_times(shares_of, small_rows):
    log = [(1, 9, 2, s) for s in (0, 0, 0, 3600, 5400, 5400)] + [(2, 9, 1, 50)] + [(3, 9, 1, 10), (3, 9, 1, 100)]
    found = trends.share_intervals(shares_of(log), 2, small_rows).collect()
    hours = defaultdict(int)
    for r in found:
        hours[r.inviter_id, round(r.interval_hours, 6)] += r.n
    assert hours == {(1, 0.0): 3, (1, 1.0): 1, (1, 0.5): 1, (3, 0.025): 1}


@pytest.mark.parametrize("most", [1, 7, 50, 51])
def test_preferences_follow_the_rank(shares_of, most):
    log = [(1, 3 * i, 2, i) for i in range(50)] + [(1, 0, 3, 60), (2, 5, 1, 61), (2, 4, 1, 62), (0, 9, 1, 63)]
    log += [(1, None, 2, 70), (None, 1, 2, 71)]
    counts = {1: {0: 2, **{3 * i: 1 for i in range(1, 50)}}, 2: {4: 1, 5: 1}, 0: {9: 1}}
    found = {(r.inviter_id, r.part): r.preference for r in profile.user_item_preference(shares_of(log), most).collect()}
    expected = {}
    for inviter, items in counts.items():
        for rank, item in enumerate(sorted(items)):
            expected.setdefault((inviter, rank // most), {})[item] = items[item]
    assert found == expected


def test_preferences_of_a_hot_inviter(spark):
    """An inviter with a million items: no map is larger than the others may be, none is lost."""
    shares = spark.range(1_050_000).select(
        F.when(F.col("id") < 1_000_000, 7).otherwise(F.col("id") % 500).alias("inviter_id"),
        (F.col("id") * 3).alias("item_id"),
    )
    sizes = profile.user_item_preference(shares).select(
        "inviter_id", "part", F.size("preference").alias("n"), F.array_min(F.map_keys("preference")).alias("least")
    )
    hot = {r.part: (r.n, r.least) for r in sizes.where("inviter_id = 7").collect()}
    assert hot == {**{i: (10_000, 30_000 * i) for i in range(100)}, 100: (100, 3 * 1_000_007)}
    assert sizes.where("inviter_id <> 7").agg(F.sum("n"), F.max("part")).first()[:] == (49_900, 0)


@pytest.mark.parametrize("step", [1, -1])
def test_one_key_with_all_rows_spreads(spark, step):
    """A single key over many partitions: spread evenly, with no neighbour lost at any edge."""
    n = 40_000
    frame = spark.range(n).select(F.lit(7).alias("k"), F.pmod(F.xxhash64("id"), F.lit(n * 50)).alias("t"), "id")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = skew.neighbour(frame, "k", ["t", "id"], "id", "near", step).cache()
        rows = [r.id for r in frame.orderBy("t", "id").collect()]
        assert {r.id: r.near for r in out.collect()} == dict(
            zip(rows, [*rows[1:], None] if step > 0 else [None, *rows[:-1]])
        )
        parts = skew.checkpointed(frame.orderBy("k", "t", "id").withColumn("p", F.spark_partition_id()))
        sizes = [r["count"] for r in parts.groupBy("p").count().collect()]
        assert len(sizes) >= 8 and max(sizes) < 2 * n / len(sizes)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_small_stored_table_needs_no_split(spark):
    frame = spark.createDataFrame([(1, t, t * 10) for t in range(5)], "k long, t long, v long")
    out = skew.neighbour(frame, "k", ["t"], "v", "near", 1, stored=frame)
    assert {r.t: r.near for r in out.collect()} == {0: 10, 1: 20, 2: 30, 3: 40, 4: None}
    assert "_place" not in out._jdf.queryExecution().analyzed().toString()
    split = skew.neighbour(frame, "k", ["t"], "v", "near", 1, small_rows=2, stored=frame)
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, out.collect()))


def test_hot_keys_get_parts_by_size(facts):
    (row,) = skew.hot_keys(facts, ["k"], 100).collect()
    assert row._parts == -(-facts.where("k = 0").count() // 100)


@pytest.mark.parametrize("small_rows", [0, 10**6])
def test_rows_without_a_key_have_no_neighbours(spark, small_rows):
    rows = [(None, t, t) for t in range(6)] + [(1, t, t * 10) for t in range(6)]
    frame = spark.createDataFrame(rows, "k long, t long, v long")
    out = skew.neighbour(frame, "k", ["t"], "v", "near", 1, small_rows, stored=frame).collect()
    assert sorted((r.t, r.near) for r in out if r.k == 1) == [(t, t * 10 + 10 if t < 5 else None) for t in range(6)]
    assert all(r.near is None for r in out if r.k is None) and len(out) == 12


@pytest.mark.parametrize("step", [1, -1])
def test_neighbours_are_found_without_a_second_shuffle(spark, step):
    """Once sorted and written, rows are not moved again; only the columns asked for are written."""
    frame = spark.createDataFrame([(t % 3, t, t * 10, "x") for t in range(60)], "k long, t long, v long, more string")
    out = skew.neighbour(frame, "k", ["t"], "v", "near", step, keep=["t"])
    assert out.columns == ["t", "near"]
    assert {r.t: r.near for r in out.collect()} == {
        t: (t + 3 * step) * 10 if 0 <= t + 3 * step < 60 else None for t in range(60)
    }
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "more" not in plan


def test_nearly_empty_partitions_have_neighbours(spark):
    """Partitions of one row each: every neighbour is carried over an edge."""
    frame = spark.createDataFrame([(1, t, t) for t in range(6)] + [(2, 9, 9)], "k long, t long, v long")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = skew.neighbour(frame, "k", ["t"], "v", "near", 1)
        assert {r.t: r.near for r in out.collect()} == {**{t: t + 1 if t < 5 else None for t in range(6)}, 9: None}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
