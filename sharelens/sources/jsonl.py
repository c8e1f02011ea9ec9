"""Readers for JSON-lines tables and for queries stored as one JSON array."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sharelens.functions.columns import parse_timestamp
from sharelens.sources.json_array import array_records

# The columns of the four input tables, in file order.
SHARE_COLUMNS = ["inviter_id", "item_id", "voter_id", "timestamp"]
USER_COLUMNS = ["user_id", "user_gender", "user_age", "user_level"]
ITEM_COLUMNS = ["item_id", "cate_id", "cate_level1_id", "brand_id", "shop_id"]
QUERY_COLUMNS = ["triple_id", "inviter_id", "item_id", "timestamp"]

SHARE_SCHEMA = "inviter_id string, item_id string, voter_id string, timestamp string"
USER_SCHEMA = "user_id string, user_gender int, user_age int, user_level int"
ITEM_SCHEMA = "item_id string, cate_id string, cate_level1_id string, brand_id string, shop_id string"
QUERY_SCHEMA = "triple_id string, inviter_id string, item_id string, timestamp string"


def _elements(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, list]:
    """Each line's records, read as text field by field, and the schema's fields.

    ``_text`` is the line, or the element of a line that holds a list; ``_bad`` tells
    whether it is no object.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    line = F.trim("value")
    parts = F.when(line.startswith("["), F.from_json(line, "array<string>")).otherwise(F.array(line))
    # A list that does not parse is one bad element: the line itself.
    parts = F.coalesce(F.when(line.startswith("[") & ~line.endswith("]"), None).otherwise(parts), F.array(line))
    split = lines.select(F.col("_metadata.file_path").alias("_file"), F.explode(parts).alias("_text"))
    return _records(split, schema)


def _records(texts: DataFrame, schema: str) -> tuple[DataFrame, list]:
    """``texts`` with ``_record``, its ``_text`` read field by field, and ``_bad``."""
    fields = texts.sparkSession.createDataFrame([], schema).schema.fields
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString() if _nested(f) else 'string'}" for f in fields)
    record = F.from_json("_text", f"{kinds}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"})
    read = texts.withColumn("_record", record)
    bad = F.col("_record._corrupt").isNotNull() | F.col("_record").isNull() | ~F.trim("_text").startswith("{")
    return read.withColumn("_bad", F.coalesce(bad, F.lit(True))), fields


def _nested(field) -> bool:
    return field.dataType.simpleString().startswith(("array", "struct", "map"))


def _typed(field):
    """The field's text in its type, NULL if it does not fit."""
    text = F.col("_record")[field.name]
    return text if _nested(field) else text.try_cast(field.dataType)


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One record per line; a line holding a list gives one row per element.

    Blank lines are skipped; lines and elements that are no object are dropped.  A
    number in quotes is a number; a field that does not fit its type is NULL and the
    rest of its record stays.  :func:`jsonl_rejects` lists all that is lost.
    """
    rows, fields = _elements(spark, path, schema)
    return rows.where(~F.col("_bad")).select(*[_typed(f).alias(f.name) for f in fields])


def read_shares(spark: SparkSession, path: str) -> DataFrame:
    """The share log with its time parsed to ``ts``; a bad time is an error."""
    rows = read_jsonl(spark, path, SHARE_SCHEMA)
    return rows.withColumn("ts", parse_timestamp(F.col("timestamp"))).drop("timestamp")


def read_queries(spark: SparkSession, path: str) -> DataFrame:
    """The query set as JSON lines, with its time parsed to ``ts``."""
    rows = read_jsonl(spark, path, QUERY_SCHEMA)
    return rows.withColumn("ts", parse_timestamp(F.col("timestamp"))).drop("timestamp")


def read_users(spark: SparkSession, path: str) -> DataFrame:
    return read_jsonl(spark, path, USER_SCHEMA)


def read_items(spark: SparkSession, path: str) -> DataFrame:
    return read_jsonl(spark, path, ITEM_SCHEMA)


def jsonl_rejects(spark: SparkSession, path: str, schema: str, width: int = 100) -> DataFrame:
    """What :func:`read_jsonl` loses: ``file, field, text``, cut to ``width`` characters.

    ``field`` is NULL for a whole line or element, else the field whose ``text`` does not
    fit its type.
    """
    return _lost(*_elements(spark, path, schema), width)


def _lost(rows: DataFrame, fields: list, width: int) -> DataFrame:
    whole = F.when(F.col("_bad"), F.struct(F.lit(None).cast("string").alias("field"), F.col("_text").alias("text")))
    misfits = [
        F.when(
            ~F.col("_bad") & F.col("_record")[f.name].isNotNull() & _typed(f).isNull(),
            F.struct(F.lit(f.name).alias("field"), F.col("_record")[f.name].alias("text")),
        )
        for f in fields
        if not _nested(f)
    ]
    lost = rows.select(F.col("_file").alias("file"), F.explode(F.array_compact(F.array(whole, *misfits))).alias("_l"))
    return lost.select("file", "_l.field", F.substring("_l.text", 1, width).alias("text"))


def jsonl_reject_counts(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Per file, how many lines or elements and how many single fields were lost."""
    lost = jsonl_rejects(spark, path, schema)
    return lost.groupBy("file").agg(
        F.count_if(F.col("field").isNull()).alias("records"), F.count_if(F.col("field").isNotNull()).alias("fields")
    )


def peek(spark: SparkSession, path: str, n: int = 5) -> DataFrame:
    """The first ``n`` lines of each file, as ``file, line_no, value``.

    Only the first split of a file is looked at; it holds the first lines.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), "value",
        F.monotonically_increasing_id().alias("_place"), F.col("_metadata.file_block_start").alias("_start"),
    )
    order = Window.partitionBy("file").orderBy("_place")
    first = lines.where("_start = 0").withColumn("line_no", F.row_number().over(order))
    return first.where(F.col("line_no") <= n).select("file", "line_no", "value")


def repair_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Name columns by position if all their present names are digits."""
    if not all(c.isdigit() for c in df.columns):
        return df
    if len(df.columns) != len(names):
        raise ValueError(f"{len(df.columns)} columns cannot take the names {list(names)}")
    return df.toDF(*names)


def _array_elements(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, list]:
    found = array_records(spark, path)
    rows, fields = _records(found.select(F.col("file").alias("_file"), "kind", F.col("text").alias("_text")), schema)
    return rows.withColumn("_bad", F.col("_bad") | (F.col("kind") != "record")), fields


def read_query_array(
    spark: SparkSession, path: str, schema: str = QUERY_SCHEMA, on_bad: str = "fail"
) -> DataFrame:
    """Queries stored as JSON arrays, in any layout; every file is split over tasks.

    Fields are read as :func:`read_jsonl` reads them.  A record that does not parse, or
    that the end of its file cuts off, is an error; with ``on_bad="drop"`` it is left to
    :func:`query_array_rejects`.
    """
    if on_bad not in ("fail", "drop"):
        raise ValueError(f"on_bad must be 'fail' or 'drop', not {on_bad!r}")
    rows, fields = _array_elements(spark, path, schema)
    if on_bad == "drop":
        rows = rows.where(~F.col("_bad"))
    else:
        said = F.concat(F.lit("bad record in "), F.col("_file"), F.lit(": "), F.substring("_text", 1, 100))
        rows = rows.where(F.when(F.col("_bad"), F.raise_error(said).cast("boolean")).otherwise(True))
    return rows.select(*[_typed(f).alias(f.name) for f in fields])


def query_array_rejects(spark: SparkSession, path: str, schema: str = QUERY_SCHEMA, width: int = 100) -> DataFrame:
    """What :func:`read_query_array` drops, as :func:`jsonl_rejects` lists it."""
    return _lost(*_array_elements(spark, path, schema), width)
