"""Helpers of the operators: tables in the shared folder, and ranks without a one-task window."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sharelens.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and return it read back.

    Cuts the lineage, fixes ids that depend on the run, and survives lost executors.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranked(df: DataFrame, order: Sequence[str | Column], name: str, out: str = "_rank") -> DataFrame:
    """``df`` with its place (from 0, gapless) in ``order``.

    Range partitions are sorted side by side and written once; a place is the row's
    place in its partition plus the rows of the partitions before.  ``df`` is written
    first, because a sort by ranges reads it twice.  Let ``order`` end with columns that
    tell rows apart, so that no value fills one partition.
    """
    rows = stored(stored(df, f"{name}_unsorted").orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), name)
    part = F.shiftright("_place", 33)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    placed = rows.withColumn("_part", part).join(F.broadcast(starts), "_part")
    within = F.col("_place").bitwiseAND((1 << 33) - 1)
    return placed.withColumn(out, F.col("_start") + within).drop("_part", "_start", "_place")


def cases(values: dict, key: Column, kind: str) -> Column:
    """A lookup of a few driver-side values as one expression; NULL for other keys."""
    if not values:
        return F.lit(None).cast(kind)
    pairs = [F.lit(x) for pair in values.items() for x in pair]
    return F.element_at(F.create_map(*pairs), key).cast(kind)


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, whatever their names; ``select("name.*")`` gives them back."""
    return F.struct(*[F.col("`{}`".format(c.replace("`", "``"))) for c in df.columns])


def small_batches(spark, size: int = 16 << 20) -> None:
    """Bound the bytes, not only the rows, of the batches that Python tasks get."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def released(batches: Iterable, forget: Callable[[], object] | None = None) -> Iterator:
    """The batches of a task; after the last, ``forget`` is called and free memory given back.

    A Python worker outlives its task: what it holds counts against the executor in all
    later stages, also in those without Python.
    """
    try:
        yield from batches
    finally:
        if forget:
            forget()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
        if trim:
            trim(0)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``vertex, component`` for the vertices of ``edges`` (``a, b`` of integers).

    Each round every vertex joins its smallest neighbour or itself, and the edges are
    drawn again between what has merged; the rest shrinks by a constant factor, as
    long as ids have nothing to do with the graph's shape.  ``component`` is some
    vertex of the component.  Counts are combined before any shuffle, so a vertex
    with very many edges does no harm.
    """
    left = stored(edges.where("a <> b").select("a", "b").distinct(), f"{name}_edges")
    ends = left.select(F.explode(F.array("a", "b")).alias("vertex")).distinct()
    found = stored(ends.withColumn("component", F.col("vertex")), f"{name}_vertices")
    turn = 0
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy(F.col("a").alias("_from")).agg(F.least("_from", F.min("b")).alias("_to"))
        near = stored(near, f"{name}_near_{turn}")
        ahead = near.select(F.col("_from").alias("_to"), F.col("_to").alias("_next"))
        jump = stored(near.join(ahead, "_to").select("_from", F.col("_next").alias("_to")), f"{name}_jump_{turn}")
        found = stored(
            found.join(jump, F.col("component") == F.col("_from"), "left").select(
                "vertex", F.coalesce("_to", "component").alias("component")
            ),
            f"{name}_found_{turn}",
        )
        first = jump.select(F.col("_from").alias("a"), F.col("_to").alias("_a"))
        second = jump.select(F.col("_from").alias("b"), F.col("_to").alias("_b"))
        merged = left.join(first, "a").join(second, "b").where("_a <> _b")
        pair = [F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")]
        left = stored(merged.select(*pair).distinct(), f"{name}_edges_{turn}")
        turn += 1
    return found
