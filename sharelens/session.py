"""Shared-storage helpers: where to put scratch tables and how to cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a local session may fall back to its warehouse; a cluster without
    ``spark.checkpoint.dir`` is an error, because its executors could not read
    a folder on the driver's disk.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base and not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return (base or spark.conf.get("spark.sql.warehouse.dir", None)).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing else uses; it goes when the session ends."""
    run = f"{shared_dir(spark)}/sharelens/{spark.sparkContext.applicationId}"
    place = spark._jvm.org.apache.hadoop.fs.Path(run)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(place)
    files.deleteOnExit(place)
    return f"{run}/{uuid.uuid4().hex}/{name}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to shared storage and return it read back.

    That cuts the lineage, and later reads take only the columns and rows they need.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
