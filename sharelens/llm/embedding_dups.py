"""Near-duplicate embeddings by a subspace pigeonhole join.

Unit vectors with cosine c are ``2 - 2 c`` apart (squared).  Cut into blocks after a
rotation, two such vectors are within the block's share of that distance in at least
one block.  A range join finds the pairs of each block; all of them are verified.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sharelens.llm.common import components, small_batches, stored

COSINE = 0.93
BLOCK_DIMS = 8
CELL_ROWS = 2048
SLACK = 1e-4
VECTOR_SCHEMA = "vec_id long, label long, dims int, key binary, vector binary"
CELL_SCHEMA = "label long, dims int, block int, x int, y int, home boolean, id long, part binary"
PAIR_SCHEMA = "a long, b long"


def rotation(dims: int) -> np.ndarray:
    """A fixed random rotation, so that no block gets all of the variance."""
    q, r = np.linalg.qr(np.random.default_rng(dims).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def usable_vectors(table: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """Every row with its unit vector and a digest of it; both NULL if it can't link."""

    def run(batches):
        for batch in batches:
            keys, units, dims = [], [], []
            for label, vector in zip(batch.column("label").to_pylist(), batch.column("vector").to_pylist()):
                key = unit = size = None
                if label is not None and vector and None not in vector:
                    values = np.array(vector, np.float64)
                    top = np.abs(values).max()
                    if np.isfinite(top) and top > 0:
                        scaled = values / top
                        unit = (scaled / np.sqrt(scaled @ scaled) + 0.0).tobytes()
                        key, size = hashlib.blake2b(unit, digest_size=16).digest(), len(values)
                keys.append(key)
                units.append(unit)
                dims.append(size)
            columns = [
                batch.column("vec_id"), batch.column("label"), pa.array(dims, pa.int32()),
                pa.array(keys, pa.binary()), pa.array(units, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "dims", "key", "vector"])

    slim = table.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).cast("long").alias("label"),
        F.col(vector_col).alias("vector"),
    )
    return slim.mapInArrow(run, VECTOR_SCHEMA)


def cells(classes: DataFrame, cosine: float, block_dims: int) -> DataFrame:
    """Each vector's blocks in the grid cells where they must be compared.

    A cell spans two radii in a block's first two coordinates.  A vector is at home in
    one cell and a guest in those of four neighbours that its radius reaches; the other
    four send their guests here.
    """

    def run(batches):
        for batch in batches:
            all_dims = batch.column("dims").to_numpy()
            ids, labels = batch.column("id").to_numpy(), batch.column("label").to_numpy()
            raw = batch.column("vector").to_pylist()
            for dims in np.unique(all_dims):
                rows = np.flatnonzero(all_dims == dims)
                dims = int(dims)
                turned = np.stack([np.frombuffer(raw[i], np.float64) for i in rows]) @ rotation(dims)
                starts = range(0, dims, block_dims)
                radius = np.sqrt((2 - 2 * cosine) / len(starts)) + SLACK
                for block, start in enumerate(starts):
                    part = turned[:, start : start + block_dims].astype(np.float32)
                    x, y = part[:, 0], part[:, min(1, part.shape[1] - 1)]
                    cx, cy = (np.floor(v / (2 * radius)).astype(np.int32) for v in (x, y))
                    right = x >= (cx + 1) * (2 * radius) - radius - SLACK
                    up = y >= (cy + 1) * (2 * radius) - radius - SLACK
                    down = y <= cy * (2 * radius) + radius + SLACK
                    everyone = np.ones(len(rows), bool)
                    sent = [(0, 0, everyone), (1, 0, right), (0, 1, up), (1, 1, right & up), (1, -1, right & down)]
                    raw_parts = [p.tobytes() for p in part]
                    for dx, dy, who in sent:
                        chosen = np.flatnonzero(who)
                        n = len(chosen)
                        if n:
                            yield pa.RecordBatch.from_arrays(
                                [
                                    pa.array(labels[rows][chosen], pa.int64()),
                                    pa.array(np.full(n, dims, np.int32)),
                                    pa.array(np.full(n, block, np.int32)),
                                    pa.array(cx[chosen] + np.int32(dx)),
                                    pa.array(cy[chosen] + np.int32(dy)),
                                    pa.array(np.full(n, dx == 0 and dy == 0)),
                                    pa.array(ids[rows][chosen]),
                                    pa.array([raw_parts[i] for i in chosen], pa.binary()),
                                ],
                                names=["label", "dims", "block", "x", "y", "home", "id", "part"],
                            )

    return classes.select("id", "label", "dims", "vector").mapInArrow(run, CELL_SCHEMA)


def block_pairs(placed: DataFrame, cosine: float, block_dims: int, cell_rows: int) -> DataFrame:
    """The pairs of each block within its share of the squared distance.

    A cell with more than ``cell_rows`` rows is cut into parts by id, and a task gets
    two of them; so no task's work depends on the size of a cell.
    """
    cell = ["label", "dims", "block", "x", "y"]
    counts = stored(placed.groupBy(*cell).agg(F.count(F.lit(1)).alias("n")), "cells")
    cuts = F.ceil(F.col("n") / cell_rows).cast("int")
    own = F.pmod(F.xxhash64("id"), F.col("cuts")).cast("int")
    dealt = (
        placed.join(counts.select(*cell, cuts.alias("cuts")), cell)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
        .select(
            *cell, "home", "id", "part", "own",
            F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        )
    )

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        dims = int(rows["dims"].iat[0])
        budget = (2 - 2 * cosine) / -(-dims // block_dims) + SLACK
        i, j = int(rows["i"].iat[0]), int(rows["j"].iat[0])
        part = np.frombuffer(b"".join(rows["part"]), np.float32).reshape(len(rows), -1).astype(np.float64)
        ids, home, own = rows["id"].to_numpy(), rows["home"].to_numpy(), rows["own"].to_numpy()
        found = []
        first, second = np.flatnonzero(own == i), np.flatnonzero(own == j)
        squares = (part**2).sum(axis=1)
        for at in range(0, len(first), 512):
            some = first[at : at + 512]
            apart = squares[some][:, None] + squares[second][None, :] - 2 * part[some] @ part[second].T
            near = (apart <= budget) & (home[some][:, None] | home[second][None, :])
            p, q = np.nonzero(near)
            found.append(np.stack([ids[some[p]], ids[second[q]]], axis=1))
        pairs = np.concatenate(found or [np.empty((0, 2), np.int64)])
        pairs = np.sort(pairs[pairs[:, 0] != pairs[:, 1]], axis=1)
        pairs = np.unique(pairs, axis=0)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    return dealt.groupBy(*cell, "i", "j").applyInPandas(run, PAIR_SCHEMA)


def verified(pairs: DataFrame, classes: DataFrame, cosine: float) -> DataFrame:
    """Those of ``pairs`` whose whole vectors have the cosine, in double precision."""

    def run(batches):
        for batch in batches:
            a, b = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.float64) for c in ("unit_a", "unit_b")
            )
            sizes = [len(v) // 8 for v in batch.column("unit_a").to_pylist()]
            ends = np.cumsum(sizes)
            keep = np.add.reduceat(a * b, np.r_[0, ends[:-1]]) >= cosine if sizes else np.zeros(0, bool)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    first = classes.select(F.col("id").alias("a"), F.col("vector").alias("unit_a"))
    second = classes.select(F.col("id").alias("b"), F.col("vector").alias("unit_b"))
    return pairs.join(first, "a").join(second, "b").mapInArrow(run, PAIR_SCHEMA)


def embedding_near_duplicates(
    table: DataFrame,
    cosine: float = COSINE,
    block_dims: int = BLOCK_DIMS,
    cell_rows: int = CELL_ROWS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """Every row of ``table`` with its links to vectors of the same label.

    Returns ``vec_id, n_links, component_id, kept``.  Vectors of one label and length
    link at a cosine of ``cosine`` or more.  Equal directions are one class, whose
    copies count as links of each other without any pair being formed; pairs are
    found between classes.  ``component_id`` is the smallest id reachable by links.

    Vectors that are NULL, empty, zero or hold NULL or non-finite numbers, and those
    without a label, have no links and their own id as component.  Repeated rows are
    vectors of their own.  A NULL id takes its component's smallest id; NULL if there
    is none.  Other columns are not read; an empty table gives no rows.
    """
    small_batches(table.sparkSession)
    rows = stored(usable_vectors(table, id_col, vector_col, label_col), "vectors")
    group = ["label", "dims", "key"]
    classes = (
        rows.where(F.col("key").isNotNull())
        .groupBy(*group)
        .agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector"))
    )
    classes = stored(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    placed = stored(cells(classes, cosine, block_dims), "placed")
    pairs = stored(block_pairs(placed, cosine, block_dims, cell_rows).distinct(), "pairs")
    links = stored(verified(pairs, classes, cosine), "links")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    copies = classes.select(F.col("id").alias("b"), "copies")
    linked = both.join(copies, "b").groupBy(F.col("a").alias("id")).agg(F.sum("copies").alias("others"))
    groups = components(links).select(F.col("vertex").alias("id"), "component")
    named = classes.select(*group, "id", "first_id", "copies").join(linked, "id", "left").join(groups, "id", "left")
    named = stored(
        named.select(
            *group, "first_id",
            (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component"),
        ),
        "named_classes",
    )
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = stored(named.join(smallest, "component").select(*group, "n_links", "component_id"), "class_results")
    linking = rows.where(F.col("key").isNotNull()).join(named, group)
    alone = rows.where(F.col("key").isNull()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    result = linking.select("vec_id", "n_links", "component_id").unionByName(alone)
    return result.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
