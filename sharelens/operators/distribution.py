"""Box statistics, histograms and kernel densities.

Equal values are merged into (value, weight) before anything else, so cost
follows the number of distinct values, not of rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sharelens.operators.profile import count_by
from sharelens.session import checkpointed

# Kernel densities: |a * b| is at most REACH * CELL / 2 = 2.5, and what TERMS powers leave out
# of exp(a * b) is below 1e-13 of it.
CELL = 0.125
REACH = 40
TERMS = 24

def merged_values(df: DataFrame, value: str, weight: str | None = None, log: bool = False) -> DataFrame:
    """Distinct non-null values as ``x`` (through ln(1 + x) if ``log``) with weight ``w``.

    They are read several times below, so they are checkpointed, and what they
    were computed from runs once.
    """
    x = F.col(value).cast("double")
    w = F.sum(weight) if weight else F.count(F.lit(1))
    merged = df.dropna(subset=[value]).groupBy((F.log1p(x) if log else x).alias("x"))
    return checkpointed(merged.agg(w.cast("bigint").alias("w")))


def box_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Quartiles, whiskers within 1.5 interquartile ranges and outlier count per group."""
    merged = count_by(df, [group, value], "_w")
    quartiles = merged.groupBy(group).agg(
        F.percentile(value, [0.25, 0.5, 0.75], F.col("_w")).alias("_q")
    )
    fences = quartiles.select(
        group,
        F.col("_q")[0].alias("q1"),
        F.col("_q")[1].alias("median"),
        F.col("_q")[2].alias("q3"),
    ).withColumn("_reach", (F.col("q3") - F.col("q1")) * 1.5)
    inside = F.col(value).between(F.col("q1") - F.col("_reach"), F.col("q3") + F.col("_reach"))
    return (
        merged.join(fences, group)
        .groupBy(group, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col(value))).cast("double").alias("_low"),
            F.max(F.when(inside, F.col(value))).cast("double").alias("_high"),
            F.sum("_w").alias("n"),
            F.sum(F.when(inside, 0).otherwise(F.col("_w"))).alias("outliers"),
        )
        .select(
            group,
            "q1",
            "median",
            "q3",
            F.least("q1", "_low").alias("whisker_low"),
            F.greatest("q3", "_high").alias("whisker_high"),
            "n",
            "outliers",
        )
    )


def histogram(
    df: DataFrame, value: str, bins: int, weight: str | None = None, log: bool = False
) -> DataFrame:
    """``bins`` equal bins from minimum to maximum, empty ones included.

    If all values are equal, the range is half a unit to either side.
    """
    values = merged_values(df, value, weight, log)
    flat = F.min("x") == F.max("x")
    limits = values.agg(
        F.struct(
            F.when(flat, F.min("x") - 0.5).otherwise(F.min("x")).alias("lo"),
            F.when(flat, F.max("x") + 0.5).otherwise(F.max("x")).alias("hi"),
        )
    ).scalar()
    width = F.col("lim.hi") - F.col("lim.lo")
    place = F.floor((F.col("x") - F.col("lim.lo")) / width * bins)
    counts = (
        values.withColumn("lim", limits)
        .groupBy(F.least(place, F.lit(bins - 1)).alias("bin"))
        .agg(F.sum("w").alias("n"))
    )
    grid = df.sparkSession.range(bins).withColumnRenamed("id", "bin").withColumn("lim", limits)
    return grid.join(counts, "bin", "left").where(F.col("lim.lo").isNotNull()).select(
        F.col("bin").cast("int").alias("bin"),
        (F.col("lim.lo") + width * F.col("bin") / bins).alias("bin_start"),
        (F.col("lim.lo") + width * (F.col("bin") + 1) / bins).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def _moments() -> list:
    """Sums of the distances from ``low``, so that large close values lose no digits."""
    d, w = F.col("x") - F.col("low"), F.col("w")
    return [
        F.sum("w").alias("n"),
        F.min("x").alias("lo"),
        F.max("x").alias("hi"),
        F.sum(d * w).alias("s1"),
        F.sum(d * d * w).alias("s2"),
    ]


def _bandwidth(stats: DataFrame) -> DataFrame:
    """Scott's rule: n^(-1/5) times the sample standard deviation; flat data has none."""
    n = F.col("n").cast("double")
    variance = (F.col("s2") - F.col("s1") * F.col("s1") / n) / (n - 1)
    usable = stats.where((F.col("n") > 1) & (F.col("hi") > F.col("lo")))
    return usable.withColumn("h", F.pow(n, F.lit(-0.2)) * F.sqrt(variance)).drop("s1", "s2")


def _smooth(values: DataFrame, stats: DataFrame, keys: list[str], grid: int) -> DataFrame:
    """Sum the kernels of all values on the grid; ``values`` carry their group's ``lo, hi, h``.

    A fast Gauss transform.  With ``a`` and ``b`` the distances of a point and of a value
    from the middle of the value's cell, in bandwidths, the kernel is
    ``exp(-a*a/2) * exp(-b*b/2) * exp(a*b)``.  The last factor's power series needs only a
    cell's sums of ``exp(-b*b/2) * b**k / k!``, so values meet cells, not points, and cells
    meet the points within ``REACH`` bandwidths, beyond which the kernel is 0 in doubles.
    There are at most ``(hi - lo) / (CELL * h)`` cells, however many values are distinct.
    """
    width = F.col("h") * CELL
    b = (F.col("x") - F.col("lo")) / F.col("h") - (F.col("cell") + 0.5) * CELL
    weight = F.col("w") * F.exp(F.col("b") * F.col("b") * -0.5)
    sums = [F.sum(weight * F.pow("b", F.lit(k)) / float(math.factorial(k))).alias(f"m{k}") for k in range(TERMS)]
    placed = values.withColumn("cell", F.floor((F.col("x") - F.col("lo")) / width)).withColumn("b", b)
    cells = placed.groupBy(*keys, "cell", "lo", "hi", "h").agg(*sums)

    step = (F.col("hi") - F.col("lo")) / (grid - 1)
    middle, reach = (F.col("cell") + 0.5) * width, F.col("h") * REACH
    first = F.greatest(F.ceil((middle - reach) / step), F.lit(0).cast("bigint"))
    last = F.least(F.floor((middle + reach) / step), F.lit(grid - 1).cast("bigint"))
    near = cells.withColumn("_first", first).withColumn("_last", last).where("_first <= _last")
    met = near.withColumn("point", F.explode(F.sequence("_first", "_last")))
    met = met.withColumn("a", F.col("point") * step / F.col("h") - (F.col("cell") + 0.5) * CELL)
    series = F.col(f"m{TERMS - 1}")
    for k in reversed(range(TERMS - 1)):
        series = series * F.col("a") + F.col(f"m{k}")
    kernels = met.groupBy(*keys, "point").agg(F.sum(F.exp(F.col("a") * F.col("a") * -0.5) * series).alias("_k"))

    points = F.sequence(F.lit(0).cast("bigint"), F.lit(grid - 1).cast("bigint"))
    every = stats.withColumn("point", F.explode(points))
    scale = F.col("n") * F.col("h") * math.sqrt(2 * math.pi)
    return every.join(kernels, [*keys, "point"], "left").select(
        *keys,
        F.col("point").cast("int").alias("point"),
        (F.col("lo") + F.col("point") * step).alias("x"),
        (F.coalesce("_k", F.lit(0.0)) / scale).alias("density"),
    )


def kde_curve(
    df: DataFrame, value: str, weight: str | None = None, log: bool = False, grid: int = 200
) -> DataFrame:
    """Gaussian kernel density on ``grid`` points from minimum to maximum."""
    values = merged_values(df, value, weight, log)
    low = values.agg(F.min("x").alias("low")).scalar()
    stats = _bandwidth(values.withColumn("low", low).agg(*_moments()))
    limits = stats.select(F.struct("n", "lo", "hi", "h")).scalar()
    placed = values.withColumn("_s", limits).select("x", "w", "_s.*").where(F.col("h").isNotNull())
    return _smooth(placed, stats, [], grid)


def kde_by_group(df: DataFrame, group: str, value: str, grid: int = 100) -> DataFrame:
    """The same per group, each cut at its own data range: the outline of a violin."""
    values = checkpointed(
        df.dropna(subset=[group, value])
        .groupBy(group, F.col(value).cast("double").alias("x"))
        .agg(F.count(F.lit(1)).alias("w"))
    )
    lows = values.groupBy(group).agg(F.min("x").alias("low"))
    stats = _bandwidth(values.join(lows, group).groupBy(group).agg(*_moments()))
    return _smooth(values.join(stats, group), stats, [group], grid)
