"""Daily trends, time between shares, commonest voters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sharelens.functions.skew import HOT_ROWS, neighbour
from sharelens.operators.joins import topn_filter
from sharelens.operators.profile import date_counts, user_user_counts


def daily_trend(shares: DataFrame, days: int = 7) -> DataFrame:
    """Daily counts with the mean of the last ``days`` rows, null before the window fills.

    The unpartitioned window runs over one row per date.
    """
    rows = Window.orderBy("date").rowsBetween(1 - days, 0)
    full = F.count("n").over(rows) == days
    return date_counts(shares).withColumn("moving_avg", F.when(full, F.avg("n").over(rows)))


def daily_extremes(shares: DataFrame) -> DataFrame:
    """The busiest and the quietest day, the earliest on a tie."""
    n, first = F.col("n"), -F.unix_date("date")
    return date_counts(shares).agg(
        F.max_by("date", F.struct(n, first)).alias("max_date"),
        F.max("n").alias("max_n"),
        F.max_by("date", F.struct(-n, first)).alias("min_date"),
        F.min("n").alias("min_n"),
    )


def share_intervals(shares: DataFrame, n_inviters: int = 100, small_rows: int = HOT_ROWS) -> DataFrame:
    """Hours since the inviter's previous share, for the most active inviters.

    Shares of one inviter at one time are merged: ``n`` counts the shares that
    have this interval, and the second and later shares of a moment have 0 hours.
    """
    active = topn_filter(shares.select("inviter_id", "ts"), n_inviters, None)
    moments = active.groupBy("inviter_id", "ts").agg(F.count(F.lit(1)).alias("_n"))
    linked = neighbour(
        moments.withColumn("_t", F.unix_micros(F.col("ts").cast("timestamp"))),
        "inviter_id", ["ts"], "_t", "_before", -1, small_rows, shares,
    )
    hours = (F.col("_t") - F.col("_before")) / F.lit(3.6e9)
    first = F.struct(hours.alias("interval_hours"), F.lit(1).cast("bigint").alias("n"))
    repeat = F.struct(F.lit(0.0).alias("interval_hours"), (F.col("_n") - 1).alias("n"))
    rows = linked.select("inviter_id", "ts", F.explode(F.array(first, repeat)).alias("_r"))
    kept = F.col("interval_hours").isNotNull() & (F.col("n") > 0)
    return rows.select("inviter_id", "ts", "_r.*").where(kept)


def top_voters_of(counts: DataFrame, key: str, voter: str, by: str, k: int) -> DataFrame:
    """The ``k`` voters with the highest ``by`` per key, as rows with ``rank``.

    Spark keeps only ``k`` rows per key and task before the shuffle.
    """
    order = Window.partitionBy(key).orderBy(F.col(by).desc(), F.col(voter))
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def topk_voters_per_inviter(shares: DataFrame, k: int = 5) -> DataFrame:
    return top_voters_of(user_user_counts(shares), "inviter_id", "voter_id", "interaction_count", k)
