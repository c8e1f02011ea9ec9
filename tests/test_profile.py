import math

import pytest
from pyspark.sql import functions as F

from sharelens.functions import columns as c
from sharelens.operators import distribution as dist
from sharelens.operators import joins, profile, trends


def test_bucket_edges(spark):
    counts = [9, 10, 49, 50, 99, 100, 499, 500]
    frame = spark.createDataFrame([(n,) for n in counts], ["n"])
    label = c.share_count_bucket(F.col("n"))
    rows = frame.select("n", label.alias("b"), c.share_bucket_rank(label).alias("r")).orderBy("n").collect()
    assert [r.b for r in rows] == ["<10", "10-50", "10-50", "50-100", "50-100", "100-500", "100-500", ">500"]
    assert [r.r for r in rows] == [0, 1, 1, 2, 2, 3, 3, 4]


def test_labels(spark):
    frame = spark.createDataFrame([(-1,), (0,), (1,), (7,)], ["g"])
    assert [r[0] for r in frame.select(c.label_gender(F.col("g"))).collect()] == ["unknown", "female", "male", None]
    assert [r[0] for r in frame.select(c.label_gender(F.col("g"), "zh")).collect()] == ["未知", "女性", "男性", None]
    assert [r[0] for r in frame.select(c.label_age(F.col("g"))).collect()][::3] == ["unknown", "age group 7"]


def test_weekday_starts_on_monday(spark):
    frame = spark.sql("SELECT timestamp'2024-01-01 05:00:00' AS ts")
    assert c.calendar_features(frame).first().day_of_week == 0


def test_top_ties_take_the_smaller_key(shares_of):
    log = [(5, 1, 2, 0), (3, 1, 2, 1), (9, 1, 2, 2), (9, 1, 2, 3)]
    assert [r.inviter_id for r in profile.top_inviters(shares_of(log), 2).collect()] == [9, 3]


def test_null_keys_are_not_counted(shares_of):
    log = [(1, 1, 2, 0), (1, None, 2, 1), (None, 1, None, 2)]
    shares = shares_of(log)
    assert profile.top_items(shares).collect()[0].n == 2
    assert profile.vote_counts(shares).count() == 1
    assert profile.inviter_return_rate(shares).first().return_rate == 0.5


def test_categories_without_items_drop_out(spark, shares_of):
    items = spark.createDataFrame([(1, "a", "x", "b", 0)], "item_id long, cate_id string, cate_level1_id string, brand_id string, shop_id long")
    shares = shares_of([(1, 1, 2, 0), (1, 7, 2, 1), (2, 1, 1, 2)])
    assert profile.user_group_counts(shares, items, "cate_id", "n").agg(F.sum("n")).first()[0] == 2
    counted = joins.count_with_item_attr(shares, items)
    assert counted.where("cate_id IS NULL").count() == 1
    assert [r.cate_id for r in profile.average_shares_by(counted, "cate_id").collect()] == ["a"]


def _days(shares_of, days):
    return shares_of([(1, 1, 2, d * 86400 + i) for d, n in days for i in range(n)])


def test_moving_average_needs_seven_rows(shares_of):
    six = trends.daily_trend(_days(shares_of, [(d, 1) for d in range(6)]))
    assert [r.moving_avg for r in six.collect()] == [None] * 6
    seven = trends.daily_trend(_days(shares_of, [(d, d + 1) for d in range(7)])).orderBy("date").collect()
    assert [r.moving_avg for r in seven] == [None] * 6 + [4.0]
    gap = trends.daily_trend(_days(shares_of, [(d, 2) for d in (0, 1, 2, 6, 7, 8, 9, 10)])).orderBy("date").collect()
    assert [r.moving_avg for r in gap] == [None] * 6 + [2.0, 2.0]


def test_extremes_take_the_earliest_day(shares_of):
    found = trends.daily_extremes(_days(shares_of, [(0, 2), (1, 3), (2, 3), (3, 2)])).first()
    assert (str(found.max_date), found.max_n, str(found.min_date), found.min_n) == ("2024-01-02", 3, "2024-01-01", 2)


def test_weekdays_are_all_present(shares_of):
    rows = profile.weekday_counts(_days(shares_of, [(0, 2), (5, 3)])).orderBy("day_of_week").collect()
    assert [r.n for r in rows] == [2, 0, 0, 0, 0, 3, 0]
    effect = profile.weekend_effect(_days(shares_of, [(5, 3)])).first()
    assert (effect.workday_mean, effect.weekend_mean, effect.diff_percent) == (0.0, 1.5, None)


def test_histogram_counts_everything(spark):
    frame = spark.createDataFrame([(float(x),) for x in (0, 1, 1, 2, 10)], ["x"])
    rows = dist.histogram(frame, "x", 5).orderBy("bin").collect()
    assert [r.n for r in rows] == [3, 1, 0, 0, 1]
    assert (rows[0].bin_start, rows[-1].bin_end) == (0.0, 10.0)


def test_histogram_of_equal_values(spark):
    rows = dist.histogram(spark.createDataFrame([(4,), (4,)], ["x"]), "x", 4).orderBy("bin").collect()
    assert [r.n for r in rows] == [0, 0, 2, 0]
    assert (rows[0].bin_start, rows[-1].bin_end) == (3.5, 4.5)


def test_histogram_weights(spark):
    frame = spark.createDataFrame([(0.0, 5), (1.0, 2)], "x double, w long")
    assert [r.n for r in dist.histogram(frame, "x", 2, "w").orderBy("bin").collect()] == [5, 2]


def test_empty_input_has_no_bins(spark):
    empty = spark.createDataFrame([], "x double")
    assert dist.histogram(empty, "x", 5).count() == 0
    assert dist.kde_curve(empty, "x").count() == 0


def test_box_whiskers(spark):
    values = [1, 2, 3, 4, 5, 6, 7, 8, 100]
    frame = spark.createDataFrame([("g", v) for v in values] + [("h", 3)], "g string, v long")
    box = {r.g: r for r in dist.box_stats(frame, "g", "v").collect()}
    assert (box["g"].q1, box["g"].median, box["g"].q3) == (3.0, 5.0, 7.0)
    assert (box["g"].whisker_low, box["g"].whisker_high, box["g"].outliers) == (1.0, 8.0, 1)
    assert (box["h"].q1, box["h"].whisker_high, box["h"].n) == (3.0, 3.0, 1)


def _density(values, x):
    n = len(values)
    mean = sum(values) / n
    h = n**-0.2 * math.sqrt(sum((v - mean) ** 2 for v in values) / (n - 1))
    return sum(math.exp(-0.5 * ((x - v) / h) ** 2) for v in values) / (n * h * math.sqrt(2 * math.pi))


def test_kde_against_the_formula(spark):
    values = [1.0, 1.0, 2.0, 5.0, 40.0, 41.0]
    rows = dist.kde_curve(spark.createDataFrame([(v,) for v in values], ["x"]), "x", grid=50).collect()
    assert len(rows) == 50
    for r in rows:
        assert r.density == pytest.approx(_density(values, r.x), abs=1e-12)


def test_kde_skips_flat_groups(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 3), ("b", 2), ("c", 5), ("c", 5)], "g string, v long")
    assert {r.g for r in dist.kde_by_group(frame, "g", "v").collect()} == {"a"}


def test_crosstab_keeps_every_age_code(spark):
    rows = [(i, i % 2, 9 if i % 2 else 1 + i % 3, 1) for i in range(50)] + [(90, None, 1, 1), (91, 0, None, 1)]
    users = spark.createDataFrame(rows, "user_id long, user_gender int, user_age int, user_level int")
    cells = {(r.gender, r.user_age): r.n for r in profile.gender_age_crosstab(users).collect()}
    assert len(cells) == 2 * 4 and sum(cells.values()) == 50
    assert sorted(n for (_, age), n in cells.items() if age == 9) == [0, 25]
    shares = profile.gender_age_percent(users).groupBy("gender").sum("percent").collect()
    assert [round(r[1], 6) for r in shares] == [100.0] * 2


def test_pivot_keeps_every_item(shares_of):
    log = [(1, 1, 2, 0), (1, 1, 2, 1), (2, 5, 1, 2), (3, 1, 1, 3)] + [(4, 100 + i, 1, 4 + i) for i in range(40)]
    cells = {(r.inviter_id, r.item_idx): r.n for r in profile.user_item_pivot(shares_of(log)).collect()}
    assert cells == {(1, 0): 2, (2, 1): 1, (3, 0): 1, **{(4, 2 + i): 1 for i in range(40)}}


def test_kde_of_far_clusters_is_never_zero(spark):
    values = [0.0] * 5 + [0.1] * 5 + [3.0]
    rows = dist.kde_curve(spark.createDataFrame([(v,) for v in values], ["x"]), "x", grid=30).collect()
    assert all(r.density > 0 for r in rows)


def test_variance_of_large_close_values(spark):
    values = [1e9 + v for v in (0.0, 1.0, 2.0, 7.0)]
    rows = dist.kde_curve(spark.createDataFrame([(v,) for v in values], ["x"]), "x", grid=10).collect()
    assert [r.density for r in rows] == pytest.approx([_density(values, r.x) for r in rows], rel=1e-6)
