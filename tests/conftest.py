import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("sharelens-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def shares_of(spark):
    """Shares from ``(inviter, item, voter, second)`` tuples."""
    from pyspark.sql import functions as F

    def build(rows):
        frame = spark.createDataFrame(rows, "inviter_id long, item_id long, voter_id long, second long")
        start = F.lit("2024-01-01 00:00:00").cast("timestamp")
        ts = F.timestamp_micros(F.unix_micros(start) + F.col("second") * 1_000_000)
        return frame.withColumn("ts", ts).withColumn("event_id", F.monotonically_increasing_id()).drop("second")

    return build
