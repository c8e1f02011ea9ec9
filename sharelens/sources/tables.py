"""Share-log views over the star-schema test tables.

The voter of a share is the next user of the same item; the last share of an
item has no voter and is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sharelens.functions.skew import neighbour

QUERY_START = "2024-01-25 00:00:00"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares with real clock times, from ``events``."""
    events = _table(spark, sf_dir, "events")
    uses = events.select(
        F.col("user_id").alias("inviter_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("item_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        "event_id",
    )
    order = ["ts", "event_id"]
    shares = neighbour(uses, "item_id", order, "inviter_id", "voter_id", 1, stored=events)
    return shares.where(F.col("voter_id").isNotNull()).select(
        "inviter_id", "item_id", "voter_id", "ts", "event_id"
    )


def order_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A larger log with dates only, from ``lineitem`` and ``orders``."""
    lines = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", F.col("l_partkey").alias("item_id"), "l_shipdate"
    )
    orders = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("inviter_id")
    )
    uses = lines.join(orders, "l_orderkey").withColumn("ts", F.col("l_shipdate").cast("timestamp"))
    order = ["ts", "l_orderkey", "l_linenumber", "l_suppkey"]
    shares = neighbour(uses, "item_id", order, "inviter_id", "voter_id", 1, stored=lines, keep=["inviter_id", "item_id", "ts"])
    return shares.where(F.col("voter_id").isNotNull()).select("inviter_id", "item_id", "voter_id", "ts")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return _table(spark, sf_dir, "customer").select(
        key.alias("user_id"),
        (F.col("c_nationkey") % 3 - 1).cast("int").alias("user_gender"),
        F.when(key % 9 == 0, -1).otherwise(key % 9).cast("int").alias("user_age"),
        (1 + F.floor(F.abs("c_acctbal") / 1000)).cast("int").alias("user_level"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.concat_ws("/", "p_type", F.col("p_size").cast("string")).alias("cate_id"),
        F.col("p_type").alias("cate_level1_id"),
        F.col("p_brand").alias("brand_id"),
        (F.col("p_partkey") % 10).alias("shop_id"),
    )


def before_queries(shares: DataFrame) -> DataFrame:
    """The shares before the first query: the train set."""
    return shares.where(F.col("ts") < F.lit(QUERY_START).cast("timestamp"))


def from_queries(shares: DataFrame) -> DataFrame:
    """The shares from the first query on, as queries with their true voter."""
    later = shares.where(F.col("ts") >= F.lit(QUERY_START).cast("timestamp"))
    return later.withColumn("triple_id", F.col("event_id").cast("string"))


def train_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return before_queries(event_shares(spark, sf_dir))


def query_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_queries(event_shares(spark, sf_dir))
