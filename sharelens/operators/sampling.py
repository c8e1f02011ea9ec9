"""Repeatable samples and splits: a row's place follows from the hash of its key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sharelens.functions.columns import hash_fraction, hash_text

PREFIX_DIGITS = 3


def sample_n(df: DataFrame, n: int, keys: list[str], seed: int = 42) -> DataFrame:
    """Up to ``n`` rows without replacement: the first in hash order.

    A count per hash prefix shows how far the sample can reach, so only about
    ``n`` rows (plus one prefix) are sorted, however many partitions there are.
    """
    hashed = df.withColumn("_h", hash_text(seed, *keys))
    prefix = F.substring("_h", 1, PREFIX_DIGITS)
    sizes = hashed.groupBy(prefix.alias("_p")).agg(F.count(F.lit(1)).alias("_c"))
    so_far = F.sum("_c").over(Window.orderBy("_p"))
    reach = sizes.withColumn("_s", so_far).where(F.col("_s") >= n).agg(F.min("_p").alias("m")).scalar()
    near = hashed.where(F.coalesce(prefix <= reach, F.lit(True)))
    return near.orderBy("_h", *keys).limit(n).drop("_h")


def sample_nodes(nodes: DataFrame, n: int, seed: int = 42) -> DataFrame:
    return sample_n(nodes, n, ["user_id"], seed)


def sample_rate(df: DataFrame, rate: float, keys: list[str], seed: int = 42) -> DataFrame:
    """The rows whose hash falls below ``rate``: a share of the table, in one narrow pass."""
    return df.where(hash_fraction(seed, *keys) < rate)


def train_val_test_split(
    df: DataFrame,
    keys: list[str],
    test_size: float = 0.2,
    val_size: float = 0.1,
    seed: int = 42,
) -> DataFrame:
    """Add ``split``: ``test``, ``val`` or ``train`` by the hash of the key."""
    place = hash_fraction(seed, *keys)
    split = F.when(place < test_size, "test").when(place < test_size + val_size, "val")
    return df.withColumn("split", split.otherwise("train"))
