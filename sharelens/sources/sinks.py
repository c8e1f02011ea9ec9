"""Writers for feature tables, candidate lists and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sharelens.functions.ranks import row_index
from sharelens.session import checkpointed

ARRAY_RECORDS = 100_000


def write_feature_csv(df: DataFrame, path: str) -> None:
    """A feature table as a directory of CSV files with headers."""
    df.write.mode("overwrite").option("header", True).csv(path)


def _answer(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("triple_id").cast("string").alias("triple_id"),
        F.col("candidate_voter_list").cast("array<string>").alias("candidate_voter_list"),
    )


def write_candidates_jsonl(candidates: DataFrame, path: str) -> None:
    """One ``{triple_id, candidate_voter_list}`` object per line."""
    _answer(candidates).write.mode("errorifexists").json(path)


def write_predictions(predictions: DataFrame, path: str) -> None:
    """Predictions as JSON lines, replacing an earlier run."""
    _answer(predictions).write.mode("overwrite").json(path)


def write_stats_json(stats: DataFrame, path: str) -> None:
    """A one-row summary as one JSON object."""
    stats.coalesce(1).write.mode("overwrite").json(path)


def write_record_arrays(
    rows: DataFrame, order: str, path: str, per_file: int = ARRAY_RECORDS, separator: str = "\n"
) -> None:
    """Write ``rows`` (``order``, ``value``: a JSON record) as files of one array each.

    Each file holds the next ``per_file`` records in the order of ``order``; files are written
    side by side.  ``separator`` stands after a record: a line end, or a blank for a file
    of one line.
    """
    placed = checkpointed(row_index(rows.select(order, "value"), [order], "_place"))
    total = placed.count()
    first = F.col("_place") % per_file == 0
    last = (F.col("_place") % per_file == per_file - 1) | (F.col("_place") == total - 1)
    line = F.concat(F.when(first, "[").otherwise(""), "value", F.when(last, "]").otherwise(","))
    placed = placed.select(F.floor(F.col("_place") / per_file).alias("part"), "_place", line.alias("value"))
    placed = placed.repartition("part").sortWithinPartitions("part", "_place").drop("_place")
    placed.write.partitionBy("part").option("lineSep", separator).text(path)
