"""Joins and neighbour lookups that hold when one key owns a third of all rows.

For joins, hot keys are found by a pre-aggregated count: the ``MAX_HOT_KEYS`` largest of
the keys with more than ``hot_rows`` rows.  So the list is safe to broadcast at
any table size, and any other key has at most ``hot_rows`` rows or, in a very
large table, at most a ``MAX_HOT_KEYS``-th of it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, StructField, StructType
from pyspark.sql.window import Window

from sharelens.session import checkpointed

HOT_ROWS = 5_000_000
MAX_HOT_KEYS = 10_000
BROADCAST_ROWS = 100_000


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """The keys too large for one task, with ``_parts`` of about ``hot_rows`` rows each.

    At most ``MAX_HOT_KEYS`` rows.  The order is total, so a list computed twice is the
    same list.
    """
    counts = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    large = counts.where(F.col("_n") > hot_rows)
    parts = F.ceil(F.col("_n") / F.greatest(F.lit(hot_rows), F.lit(1))).cast("int")
    return large.orderBy(F.col("_n").desc(), *keys).limit(MAX_HOT_KEYS).select(*keys, parts.alias("_parts"))


def fits(df: DataFrame, rows: int) -> bool:
    """Has ``df`` at most ``rows`` rows?  Meant for stored tables.

    A full count adds up numbers per file; a limit would send rows to one task.
    """
    return df.count() <= rows


def skew_join(
    facts: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    hot_rows: int = HOT_ROWS,
    source: DataFrame | None = None,
    rows: int | None = None,
) -> DataFrame:
    """``facts`` left join ``table`` (unique on ``keys``) by shuffle.

    Rows of a hot key are spread over as many parts as it has times ``hot_rows`` rows,
    and the table's row for it is copied to each part.  Rows without a key match
    nothing, so they are spread freely.  A row's part follows from its partition and
    content, so a task run again sends every row the same way.  ``source`` names rows to
    count the keys in, where ``facts`` is them with more columns: a chain of joins then
    counts the plain rows.  ``rows`` is their number, if it is known: with no more than
    ``hot_rows`` of them no key can be hot, and a plain join does.
    """
    keys = list(keys)
    if rows is not None and rows <= hot_rows:
        return facts.join(table, keys, "left")
    hot = F.broadcast(hot_keys(facts if source is None else source, keys, hot_rows))
    place = F.xxhash64(F.spark_partition_id(), *facts.columns)
    unmatched = F.coalesce(*[F.when(F.col(k).isNull(), True) for k in keys])
    salt = F.when(unmatched, place).otherwise(F.coalesce(F.pmod(place, F.col("_parts")), F.lit(0)))
    left = facts.join(hot, keys, "left").withColumn("_salt", salt.cast("bigint"))
    last = F.coalesce("_parts", F.lit(1)).cast("bigint") - 1
    copies = F.sequence(F.lit(0).cast("bigint"), last)
    right = table.join(hot, keys, "left").withColumn("_salt", F.explode(copies))
    joined = left.drop("_parts").join(right.drop("_parts"), [*keys, "_salt"], "left")
    return joined.drop("_salt")


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    max_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
    source: DataFrame | None = None,
) -> DataFrame:
    """``facts`` left join a stored dimension table (unique on ``keys``).

    The dimension is counted first: up to ``max_rows`` rows it is broadcast,
    beyond that the join shuffles.
    """
    keys = list(keys)
    if fits(dim, max_rows):
        return facts.join(F.broadcast(dim), keys, "left")
    return skew_join(facts, dim, keys, hot_rows, source)


def neighbour(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    value: str,
    out: str,
    step: int,
    small_rows: int = HOT_ROWS,
    stored: DataFrame | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``out``: ``value`` of the next (``step=1``) or previous (``-1``) row of ``key``.

    Rows are sorted by key and order over ranges of both, so a key with any share of the
    rows spreads over as many partitions as it fills; let ``order`` tell rows apart.  Each
    finds its neighbour as the sorted rows stream by, and the one at a partition's edge in
    the adjoining partition's edge row, carried over in a table with a row for each
    partition; so rows are moved once.  Rows without a key have no neighbours.  ``stored``
    names a stored table with as many rows: with no more than ``small_rows`` a window by
    key does.  ``keep`` names the columns returned besides ``out``, if not all.
    """
    kept = list(df.columns if keep is None else keep)
    if stored is not None and fits(stored, small_rows):
        shift, keyed = F.lead if step > 0 else F.lag, F.col(key).isNotNull()
        alone = F.when(~keyed, F.xxhash64(*order)).alias("_alone")
        rows = Window.partitionBy(key, alone).orderBy(*order)
        return df.withColumn(out, F.when(keyed, shift(value).over(rows))).select(*kept, out)
    # Written before too, because a sort by ranges reads its rows twice.  The previous row
    # is the next one of the reverse order.
    in_order = checkpointed(df).orderBy(*[F.col(c).asc() if step > 0 else F.col(c).desc() for c in (key, *order)])
    in_order = in_order.select(*kept, F.col(key).alias("_key"), F.col(value).alias("_value"), F.spark_partition_id().alias("_part"))
    edge_fields = [StructField("_near", df.schema[value].dataType), StructField("_edge", ByteType())]
    schema = StructType([*in_order.schema.fields, *edge_fields])
    rows = checkpointed(in_order.mapInArrow(_beside_the_next, schema))
    firsts = rows.where(F.col("_edge").bitwiseAND(1) == 1).select("_part", F.struct("_key", "_value").alias("_far"))
    carried = firsts.withColumn("_far", F.lead("_far").over(Window.orderBy("_part")))
    last = F.col("_edge").bitwiseAND(2) == 2
    found = rows.join(F.broadcast(carried), "_part")
    far = F.when(F.col("_far._key") == F.col("_key"), F.col("_far._value"))
    return found.select(*kept, F.when(last, far).otherwise(F.col("_near")).alias(out))


def _beside_the_next(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add ``_near``, the next row's ``_value`` if its ``_key`` is the same, to a partition's rows.

    ``_edge`` is 1 for the first row, plus 2 for the last one, whose next row is not here;
    only these keep ``_key`` and ``_value``.
    """

    def marked(rows: pa.RecordBatch, near: pa.Array, edge: np.ndarray) -> pa.RecordBatch:
        names = [*rows.schema.names, "_near", "_edge"]
        columns = dict(zip(names, [*rows.columns, near, pa.array(edge)]))
        for name in ("_key", "_value"):
            columns[name] = pc.if_else(pa.array(edge > 0), columns[name], pa.scalar(None, columns[name].type))
        return pa.RecordBatch.from_arrays(list(columns.values()), names=names)

    held, first = None, 1
    for batch in batches:
        if batch.num_rows:
            rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            n = rows.num_rows - 1
            if n:
                keys, values = rows.column("_key"), rows.column("_value")
                same = pc.fill_null(pc.equal(keys.slice(0, n), keys.slice(1)), False)
                edge = np.zeros(n, np.int8)
                edge[0], first = first, 0
                yield marked(rows.slice(0, n), pc.if_else(same, values.slice(1), pa.scalar(None, values.type)), edge)
            held = rows.slice(n)
    if held is not None:
        yield marked(held, pa.nulls(1, held.column("_value").type), np.array([first + 2], np.int8))
