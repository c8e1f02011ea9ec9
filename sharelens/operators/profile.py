"""Counts, top lists, summary numbers, crosstabs and return rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sharelens.functions.columns import (
    WEEKDAY_LABELS,
    calendar_features,
    label_age,
    label_gender,
    label_weekday,
    month_day_label,
    share_bucket_rank,
    share_count_bucket,
)
from sharelens.functions.ranks import row_index
from sharelens.functions.skew import lookup_join
from sharelens.session import checkpointed

PREFERENCE_ITEMS = 10_000


def count_by(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Rows per key; rows with a null key are not counted."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def top_n(counts: DataFrame, key: str, by: str, n: int) -> DataFrame:
    """The ``n`` largest by ``by``; the smaller key wins a tie."""
    return counts.orderBy(F.col(by).desc(), F.col(key)).limit(n)


def invite_counts(shares: DataFrame) -> DataFrame:
    return count_by(shares, ["inviter_id"], "invite_count").withColumnRenamed("inviter_id", "user_id")


def vote_counts(shares: DataFrame) -> DataFrame:
    return count_by(shares, ["voter_id"], "voted_count").withColumnRenamed("voter_id", "user_id")


def item_popularity(shares: DataFrame, name: str = "item_popularity") -> DataFrame:
    return count_by(shares, ["item_id"], name)


def user_item_counts(shares: DataFrame, name: str = "interaction_count") -> DataFrame:
    return count_by(shares, ["inviter_id", "item_id"], name)


def user_user_counts(shares: DataFrame) -> DataFrame:
    return count_by(shares, ["inviter_id", "voter_id"], "interaction_count")


# --- users and items -------------------------------------------------------


def gender_distribution(users: DataFrame, lang: str = "en") -> DataFrame:
    """Users per gender and their percent of all users with a known code."""
    total = F.sum("n").over(Window.partitionBy())  # one row per gender
    return count_by(users, ["user_gender"]).select(
        "user_gender",
        label_gender(F.col("user_gender"), lang).alias("gender"),
        "n",
        (F.col("n") * 100.0 / total).alias("percent"),
    )


def age_distribution(users: DataFrame, lang: str = "en") -> DataFrame:
    counts = count_by(users, ["user_age"]).orderBy("user_age")
    return counts.select("user_age", label_age(F.col("user_age"), lang).alias("age"), "n")


def level_distribution(users: DataFrame) -> DataFrame:
    return count_by(users, ["user_level"]).orderBy("user_level")


def top_values(items: DataFrame, column: str, n: int = 20) -> DataFrame:
    """The commonest values of an item column (category, level-1 category, brand)."""
    return top_n(count_by(items, [column]), column, "n", n)


def top_inviters(shares: DataFrame, n: int = 20) -> DataFrame:
    return top_n(count_by(shares, ["inviter_id"]), "inviter_id", "n", n)


def top_voters(shares: DataFrame, n: int = 20) -> DataFrame:
    return top_n(count_by(shares, ["voter_id"]), "voter_id", "n", n)


def top_items(shares: DataFrame, n: int = 20) -> DataFrame:
    return top_n(count_by(shares, ["item_id"]), "item_id", "n", n)


# --- time ------------------------------------------------------------------


def date_counts(shares: DataFrame) -> DataFrame:
    return count_by(shares.select(F.to_date("ts").alias("date")), ["date"])


def daily_counts(shares: DataFrame) -> DataFrame:
    """Shares per date, with the mean over the dates."""
    return date_counts(shares).withColumn("mean_n", F.avg("n").over(Window.partitionBy()))


def hourly_counts(shares: DataFrame) -> DataFrame:
    """Shares per hour of day; the busiest hour (the earliest on a tie) is flagged."""
    counts = count_by(shares.select(F.hour("ts").alias("hour")), ["hour"])
    place = F.row_number().over(Window.orderBy(F.col("n").desc(), "hour"))  # one row per hour
    return counts.withColumn("is_peak", place == 1)


def weekday_counts(shares: DataFrame, lang: str = "en") -> DataFrame:
    """Shares per weekday (Monday is 0), all seven present."""
    counts = count_by(shares.select(F.weekday("ts").alias("day_of_week")), ["day_of_week"])
    days = shares.sparkSession.range(7).select(F.col("id").cast("int").alias("day_of_week"))
    return days.join(counts, "day_of_week", "left").select(
        "day_of_week",
        label_weekday(F.col("day_of_week"), lang).alias("weekday"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def weekend_effect(shares: DataFrame) -> DataFrame:
    """Mean total of a workday and of a weekend day, and their difference in percent."""
    weekend = F.col("day_of_week") >= 5
    means = weekday_counts(shares).agg(
        (F.sum(F.when(~weekend, F.col("n"))) / 5).alias("workday_mean"),
        (F.sum(F.when(weekend, F.col("n"))) / 2).alias("weekend_mean"),
    )
    gap = F.try_divide(F.col("weekend_mean") - F.col("workday_mean"), F.col("workday_mean"))
    return means.withColumn("diff_percent", gap * 100)


# --- summary numbers -------------------------------------------------------


def summarize(counts: DataFrame, column: str) -> DataFrame:
    """Mean, median and maximum of a count column.

    Equal counts are merged first: distinct counts over N shares number at most
    the square root of 2 N, so the exact median stays small.
    """
    merged = count_by(counts, [column], "_f")
    return merged.agg(
        (F.sum(F.col(column) * F.col("_f")) / F.sum("_f")).alias("mean"),
        F.percentile(column, 0.5, F.col("_f")).alias("median"),
        F.max(column).alias("max"),
    )


def activity_stats(shares: DataFrame) -> DataFrame:
    invites = summarize(invite_counts(shares), "invite_count")
    votes = summarize(vote_counts(shares), "voted_count")
    return invites.select(F.lit("inviter").alias("role"), "*").unionByName(
        votes.select(F.lit("voter").alias("role"), "*")
    )


def dataset_stats(
    train: DataFrame, queries: DataFrame, users: DataFrame, items: DataFrame
) -> DataFrame:
    """Nine numbers that describe the data, as one row."""

    def rows(df: DataFrame) -> Column:
        return df.agg(F.count(F.lit(1)).alias("n")).scalar()

    def per_key(counts: DataFrame, column: str) -> DataFrame:
        return counts.agg(F.struct(F.count(F.lit(1)).alias("keys"), F.avg(column).alias("mean")))

    inviters = per_key(invite_counts(train), "invite_count").scalar()
    voters = per_key(vote_counts(train), "voted_count").scalar()
    return train.agg(F.count(F.lit(1)).alias("train_rows")).select(
        "train_rows",
        rows(queries).alias("query_rows"),
        rows(users).alias("users"),
        rows(items).alias("items"),
        inviters["keys"].alias("inviters"),
        voters["keys"].alias("voters"),
        inviters["mean"].alias("mean_shares_per_inviter"),
        voters["mean"].alias("mean_votes_per_voter"),
        rows(item_popularity(train)).alias("shared_items"),
    )


def gender_activity_stats(counts: DataFrame, lang: str = "en") -> DataFrame:
    """Mean and median invites per gender, over invite counts with user attributes."""
    merged = count_by(counts, ["user_gender", "invite_count"], "_f")
    labelled = merged.withColumn("gender", label_gender(F.col("user_gender"), lang))
    return labelled.dropna(subset=["gender"]).groupBy("gender").agg(
        (F.sum(F.col("invite_count") * F.col("_f")) / F.sum("_f")).alias("mean"),
        F.percentile("invite_count", 0.5, F.col("_f")).alias("median"),
        F.sum("_f").alias("inviters"),
    )


# --- items and categories --------------------------------------------------


def average_shares_by(item_counts: DataFrame, column: str, n: int = 20) -> DataFrame:
    """Mean share count of the shared items per group, the ``n`` highest."""
    means = item_counts.dropna(subset=[column]).groupBy(column).agg(F.avg("share_count").alias("avg_shares"))
    return top_n(means, column, "avg_shares", n)


def largest_categories(item_counts: DataFrame, n: int = 10, column: str = "cate_id") -> DataFrame:
    """Items in the ``n`` categories that have the most shared items."""
    best = top_n(count_by(item_counts, [column]), column, "n", n).select(column)
    return item_counts.join(F.broadcast(best), column, "left_semi")


def category_trend(shares: DataFrame, items: DataFrame, n: int = 5) -> DataFrame:
    """Shares per date and category for the ``n`` most shared categories.

    Shares are counted per item and date before they meet the item table.
    """
    per_item = count_by(shares.select("item_id", F.to_date("ts").alias("date")), ["item_id", "date"], "_n")
    rows = lookup_join(per_item, items.select("item_id", "cate_id"), ["item_id"])
    daily = rows.dropna(subset=["cate_id"]).groupBy("date", "cate_id").agg(F.sum("_n").alias("count"))
    totals = daily.groupBy("cate_id").agg(F.sum("count").alias("_total"))
    best = F.broadcast(top_n(totals, "cate_id", "_total", n).select("cate_id"))
    return daily.join(best, "cate_id").select("date", "cate_id", "count")


def user_group_counts(shares: DataFrame, items: DataFrame, column: str, name: str) -> DataFrame:
    """Shares per inviter and item group; items without a group are not counted."""
    return grouped_counts(user_item_counts(shares, "_n"), items, column, name)


def grouped_counts(counts: DataFrame, items: DataFrame, column: str, name: str) -> DataFrame:
    """The same from counts ``_n`` per inviter and item."""
    per_item = lookup_join(counts, items.select("item_id", column), ["item_id"])
    return per_item.dropna(subset=[column]).groupBy("inviter_id", column).agg(F.sum("_n").alias(name))


def user_item_preference(shares: DataFrame, most: int = PREFERENCE_ITEMS) -> DataFrame:
    """Per inviter, maps from item to share count, of at most ``most`` items each.

    An inviter's items are ranked by id; map ``part`` holds ranks ``part * most`` up to
    ``(part + 1) * most - 1``.  Only inviters with more items than that are ranked, by
    their places in one sort over ranges of (inviter, item), which an inviter of any
    size spreads over.  The list of those inviters has one row per ``most`` rows at most.
    """
    counts = checkpointed(user_item_counts(shares, "_n"))
    sizes = counts.groupBy("inviter_id").agg(F.count(F.lit(1)).alias("_items"))
    large = checkpointed(sizes.where(F.col("_items") > most).select("inviter_id", F.lit(True).alias("_large")))
    marked = lookup_join(counts, large, ["inviter_id"])
    placed = row_index(marked.where("_large").drop("_large"), ["inviter_id", "item_id"], "_at")
    first = checkpointed(placed.groupBy("inviter_id").agg(F.min("_at").alias("_first")))
    rank = F.col("_at") - F.col("_first")
    ranked = lookup_join(placed, first, ["inviter_id"]).withColumn("part", F.floor(rank / most).cast("int"))
    columns = ["inviter_id", "item_id", "_n", "part"]
    rows = marked.where("_large IS NULL").withColumn("part", F.lit(0)).select(*columns).union(ranked.select(*columns))
    entries = F.collect_list(F.struct("item_id", "_n"))
    return rows.groupBy("inviter_id", "part").agg(F.map_from_entries(entries).alias("preference"))


# --- return rates ----------------------------------------------------------


def _return_rate(shares: DataFrame, key: str, name: str) -> DataFrame:
    """Shares and distinct voters per key, counted per (key, voter) first."""
    pairs = shares.dropna(subset=[key]).groupBy(key, "voter_id").agg(F.count(F.lit(1)).alias("_n"))
    stats = pairs.groupBy(key).agg(F.sum("_n").alias(name), F.count("voter_id").alias("unique_voters"))
    return stats.withColumn("return_rate", F.col("unique_voters") / F.col(name))


def inviter_return_rate(shares: DataFrame) -> DataFrame:
    return _return_rate(shares, "inviter_id", "total_shares")


def return_rate_by_activity(shares: DataFrame) -> DataFrame:
    """Mean return rate and inviters per share-count bucket, in bucket order."""
    label = share_count_bucket(F.col("total_shares"))
    stats = inviter_return_rate(shares).groupBy(label.alias("share_group")).agg(
        F.avg("return_rate").alias("avg_return_rate"), F.count(F.lit(1)).alias("inviters")
    )
    return stats.withColumn("bucket_rank", share_bucket_rank(F.col("share_group"))).orderBy("bucket_rank")


def item_return_rate(shares: DataFrame, min_shares: int = 5) -> DataFrame:
    return _return_rate(shares, "item_id", "shares").where(F.col("shares") >= min_shares)


def share_voter_regression(shares: DataFrame, min_shares: int = 5, log: bool = False) -> DataFrame:
    """Least-squares line of distinct voters on shares, over the items with enough shares."""
    scale = F.log1p if log else (lambda c: c)
    x = scale(F.col("shares").cast("double"))
    y = scale(F.col("unique_voters").cast("double"))
    return item_return_rate(shares, min_shares).agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.count(F.lit(1)).alias("items"),
    )


# --- crosstabs -------------------------------------------------------------


def hour_weekday_matrix(shares: DataFrame, lang: str = "en") -> DataFrame:
    """Hour by weekday counts, with a column for each of the seven days."""
    names = list(WEEKDAY_LABELS[lang].values())
    parts = calendar_features(shares.select("ts"))
    wide = parts.withColumn("_day", label_weekday(F.col("day_of_week"), lang))
    return wide.groupBy("hour").pivot("_day", names).count().na.fill(0, names)


def hour_weekday_hotspot(shares: DataFrame, lang: str = "en") -> DataFrame:
    """The busiest (hour, weekday) cell; the earliest on a tie."""
    cells = count_by(calendar_features(shares.select("ts")), ["hour", "day_of_week"])
    best = cells.orderBy(F.col("n").desc(), "hour", "day_of_week").limit(1)
    return best.withColumn("weekday", label_weekday(F.col("day_of_week"), lang))


def _date_hour_cells(shares: DataFrame, n: int) -> DataFrame:
    parts = shares.select(month_day_label(F.col("ts")).alias("date_label"), F.hour("ts").alias("hour"))
    cells = count_by(parts, ["date_label", "hour"])
    totals = cells.groupBy("date_label").agg(F.sum("n").alias("total"))
    best = F.broadcast(top_n(totals, "date_label", "total", n))
    return cells.join(best, "date_label")


def date_hour_matrix(shares: DataFrame, n: int = 30) -> DataFrame:
    """``MM-dd`` by hour counts for the ``n`` busiest labels, busiest first."""
    hours = list(range(24))
    wide = _date_hour_cells(shares, n).groupBy("date_label", "total").pivot("hour", hours).sum("n")
    filled = wide.select(
        "date_label", "total", *[F.coalesce(F.col(f"`{h}`"), F.lit(0)).alias(f"h{h:02d}") for h in hours]
    )
    return filled.orderBy(F.col("total").desc(), "date_label")


def date_hour_hotspot(shares: DataFrame, n: int = 30) -> DataFrame:
    cells = _date_hour_cells(shares, n).select("date_label", "hour", "n")
    return cells.orderBy(F.col("n").desc(), "date_label", "hour").limit(1)


def gender_age_crosstab(users: DataFrame) -> DataFrame:
    """Users per gender and age group: a row for each pair of the codes that occur, zeros included."""
    known = users.dropna(subset=["user_gender", "user_age"])
    cells = known.groupBy("user_gender", "user_age").agg(F.count(F.lit(1)).alias("n"))
    genders, ages = cells.select("user_gender").distinct(), cells.select("user_age").distinct()
    # Codes, not rows: as many lists as there are genders, as many entries as ages.
    codes = ages.agg(F.collect_list("user_age").alias("ages")).scalar()
    grid = genders.select("user_gender", F.explode(codes).alias("user_age"))
    return grid.join(cells, ["user_gender", "user_age"], "left").select(
        label_gender(F.col("user_gender")).alias("gender"),
        "user_age",
        label_age(F.col("user_age")).alias("age"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def gender_age_percent(users: DataFrame) -> DataFrame:
    """Each cell of the crosstab as percent of its gender's users."""
    counts = gender_age_crosstab(users)
    total = F.sum("n").over(Window.partitionBy("gender"))
    return counts.select("gender", "user_age", "age", (F.col("n") * 100.0 / total).alias("percent"))


def user_item_pivot(shares: DataFrame) -> DataFrame:
    """The whole user by item matrix of counts in sparse form.

    ``item_idx`` numbers the items from 0 in the order of their ids; cells without a
    row are 0.  Every inviter with an item has a row.
    """
    counts = user_item_counts(shares, "n")
    items = checkpointed(row_index(counts.select("item_id").distinct(), ["item_id"], "item_idx"))
    return lookup_join(counts, items, ["item_id"]).select("inviter_id", "item_idx", "n")
