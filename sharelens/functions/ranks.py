"""Row positions without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sharelens.session import checkpointed


def row_index(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Add the zero-based position of each row in the order of ``order``.

    The sorted rows are written with their partition and place, which fixes both; then
    position = rows in earlier partitions + place in the partition.  Only one row
    per partition meets in a single task.
    """
    rows = checkpointed(df.orderBy(*order).withColumn("_m", F.monotonically_increasing_id()))
    part = F.shiftright("_m", 33)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_c"))
    before = F.sum("_c").over(Window.orderBy("_part")) - F.col("_c")
    offsets = F.broadcast(sizes.select("_part", before.alias("_before")))
    place = F.col("_before") + F.col("_m").bitwiseAND((1 << 33) - 1)
    return rows.withColumn("_part", part).join(offsets, "_part").select(*df.columns, place.alias(name))
