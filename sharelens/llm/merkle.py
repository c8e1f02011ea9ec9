"""A Merkle manifest of a dataset: one root, and a proof for every row.

Rows are leaves of a binary tree per language; the languages' roots are leaves of one
more tree.  Only every ``STRIDE``-th level is written.  To prove a row, the levels
between are computed again from the stored nodes below, subtree by subtree, their
siblings are handed to the rows, and nothing of them is kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sharelens.functions.skew import lookup_join
from sharelens.llm.common import ranked, stored

STRIDE = 4
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_MODULUS = 7


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def _field(value: Column) -> Column:
    text = value.cast("string")
    sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(sized, F.lit("-"))


def leaf(**changed: Column) -> Column:
    """The digest of a row, with some of its values replaced."""
    return digest(*[_field(changed.get(name, F.col(name))) for name in LEAF_COLUMNS])


@dataclass
class Forest:
    """Trees side by side: the stored levels from the leaves up, and one root a tree.

    A level has ``tree, n, idx, hash``: ``n`` nodes of the tree are on it.  Trees that
    have come to one node are left out of the levels above.  ``roots`` has ``tree, hash``
    and ``height``, the stored level on which that node stands.
    """

    levels: list[DataFrame]
    roots: DataFrame
    stride: int


def _subtrees(level: DataFrame, stride: int, payload: tuple[str, ...] = ()) -> DataFrame:
    """One row per aligned subtree: its members, at most ``2 ** stride``, and ``_l0`` to ``_l{stride}``.

    The last of these columns holds the subtree's own node alone.  The top subtree of a
    tree stops at one node; any other hashes a lone node on.
    """
    members = F.sort_array(F.collect_list(F.struct("idx", "hash", *payload)))
    rows = level.groupBy("tree", "n", F.shiftright("idx", stride).alias("up")).agg(members.alias("members"))
    rows = rows.select("*", (F.col("n") <= (1 << stride)).alias("_top"), F.col("members.hash").alias("_l0"))
    for i in range(stride):
        below = F.col(f"_l{i}")
        pairs = F.sequence(F.lit(0), F.shiftright(F.size(below) - 1, 1))
        # A column of its own: Spark then computes each level once.
        above = F.transform(pairs, lambda p: digest(F.get(below, 2 * p), F.coalesce(F.get(below, 2 * p + 1), F.lit(""))))
        rows = rows.withColumn(f"_l{i + 1}", F.when(F.col("_top") & (F.size(below) == 1), below).otherwise(above))
    return rows


def grow(leaves: DataFrame, name: str, stride: int = STRIDE) -> Forest:
    """All trees over ``leaves`` (``tree, n, idx, hash``), ``stride`` levels a round.

    No group is larger than ``2 ** stride`` rows, whatever share of the rows a tree has.
    """
    levels, done, height = [], [], 0
    level = leaves.select("tree", "n", "idx", "hash")
    while True:
        done.append(level.where("n = 1").select("tree", "hash", F.lit(height).alias("height")))
        level = level.where("n > 1")
        if level.isEmpty():
            break
        levels.append(level)
        height += 1
        above = _subtrees(level, stride).select(
            "tree",
            (F.shiftright(F.col("n") - 1, stride) + 1).alias("n"),
            F.col("up").alias("idx"),
            F.get(f"_l{stride}", 0).alias("hash"),
        )
        level = stored(above, f"{name}_{height}")
    roots = done[0]
    for more in done[1:]:
        roots = roots.unionByName(more)
    return Forest(levels, stored(roots, f"{name}_roots"), stride)


def prove(forest: Forest, tops: DataFrame, leaves: DataFrame, payload: tuple[str, ...]) -> DataFrame:
    """``leaves`` with ``steps`` to the end of ``tops`` (``tree, height, steps`` and more columns).

    A step is the sibling (NULL if none) and whether the node is the right one of the two.
    Proofs go down from the roots: a subtree takes the proof of its own node and puts the
    siblings inside the subtree before it, so no row is joined level by level.
    """
    more = [c for c in tops.columns if c not in ("tree", "height", "steps")]
    above = None
    for height in range(len(forest.levels) - 1, -1, -1):
        own = payload if height == 0 else ()
        nodes = leaves.where("n > 1") if height == 0 else forest.levels[height]
        ends = tops.where(F.col("height") == height + 1).drop("height").withColumn("up", F.lit(0).cast("long"))
        known = ends if above is None else ends.unionByName(above.withColumnRenamed("idx", "up"))
        subtrees = _subtrees(nodes, forest.stride, own).drop("n")
        rows = subtrees.join(known, ["tree", "up"]).select(
            "*", F.posexplode("members").alias("_at", "_m")
        )
        inner = []
        for i in range(forest.stride):
            nodes_here, at = F.col(f"_l{i}"), F.shiftright("_at", i)
            step = F.struct(
                F.get(nodes_here, at.bitwiseXOR(F.lit(1))).alias("sibling"), (at % 2 == 1).alias("right")
            )
            inner.append(F.when(~(F.col("_top") & (F.size(nodes_here) == 1)), step))
        steps = F.concat(F.array_compact(F.array(*inner)), F.col("steps"))
        above = rows.select("tree", "_m.idx", *[F.col(f"_m.{c}").alias(c) for c in ("hash", *own)], steps.alias("steps"), *more)
        if height:
            above = above.drop("hash")
    alone = leaves.where("n = 1").join(tops.where("height = 0").drop("height"), "tree")
    columns = ["tree", "idx", "hash", *payload, "steps", *more]
    return alone.select(*columns) if above is None else above.select(*columns).unionByName(alone.select(*columns))


def fold(start: Column, steps: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    return F.aggregate(
        steps,
        start,
        lambda node, s: F.when(s["right"], digest(s["sibling"], node)).otherwise(
            digest(node, F.coalesce(s["sibling"], F.lit("")))
        ),
    )


def proof_digest(steps: Column) -> Column:
    """The digest of all siblings, from the leaf's level up."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: s["sibling"]), ""), 256)


def manifest(docs: DataFrame, tampered: Column | None = None, stride: int = STRIDE) -> DataFrame:
    """Every row of ``docs`` with its leaf, its tree's root, the root of all, and its proof.

    Returns ``doc_id, lang, leaf, subroot, root, steps, start``: ``steps`` are the siblings
    up to the root, ``start`` is ``tampered`` where that is not NULL, else the leaf.

    Leaves of one ``lang`` ascend by ``doc_id``, NULL first; rows with equal ids by their
    leaf, so repeated rows are leaves of their own.  Languages ascend bytewise, NULL
    first, and may be as many as there are rows.  NULL values have a digest of their
    own, other than an empty text's.  Whole texts are hashed where they are read and
    never moved.  Columns other than the five of a leaf are not read.  An empty table
    gives no rows.
    """
    start = F.coalesce(tampered, leaf()) if tampered is not None else leaf()
    rows = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), leaf().alias("hash"), start.alias("start"))
    placed = ranked(rows, ["lang", "doc_id", "hash"], "leaves")
    key = F.coalesce(F.concat(F.lit(":"), F.col("lang")), F.lit(""))
    placed = placed.withColumn("_key", key)
    trees = placed.groupBy("_key").agg(F.min("_rank").alias("_first"), F.count(F.lit(1)).alias("n"))
    trees = stored(ranked(trees, ["_first"], "languages", "tree"), "trees")
    payload = ("doc_id", "lang", "start")
    leaves = lookup_join(placed, trees, ["_key"]).select(
        "tree", "n", (F.col("_rank") - F.col("_first")).alias("idx"), "hash", *payload
    )
    forest = grow(leaves, "nodes", stride)
    count = trees.agg(F.count(F.lit(1)).alias("n")).scalar()
    # Stored, so that its constant column is one to join on.
    subroots = stored(
        forest.roots.select(
            F.lit(0).cast("long").alias("tree"), count.alias("n"), F.col("tree").alias("idx"), "hash", "height"
        ),
        "subroot_leaves",
    )
    whole = grow(subroots, "languages", stride)
    no_steps = F.array().cast("array<struct<sibling:string,right:boolean>>")
    top = whole.roots.select("tree", "height", no_steps.alias("steps"), F.col("hash").alias("root"))
    tops = prove(whole, top, subroots, ("height",)).select(
        F.col("idx").alias("tree"), "height", "steps", "root", F.col("hash").alias("subroot")
    )
    proofs = prove(forest, stored(tops, "subroots"), leaves, payload)
    return proofs.select("doc_id", "lang", F.col("hash").alias("leaf"), "subroot", "root", "steps", "start")


def changed_leaf() -> Column:
    """The leaf of a row whose ``n_chars`` was raised by 1; NULL for rows left alone."""
    hit = F.crc32(F.col("doc_id").cast("string")) % TAMPER_MODULUS == 0
    larger = F.col("n_chars").cast("decimal(20,0)") + 1
    return F.when(hit & F.col("n_chars").isNotNull(), leaf(n_chars=larger))


def verified_manifest(docs: DataFrame, stride: int = STRIDE) -> DataFrame:
    """The manifest with every proof checked, after some rows were tampered with.

    Returns ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.  Rows whose
    id's crc32, as text, divides by 7 have 1 added to ``n_chars``; a NULL id or count stays
    as it is.
    """
    rows = manifest(docs, changed_leaf(), stride)
    folded = rows.withColumn("folded_root", fold(F.col("start"), F.col("steps")))
    return folded.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("steps")).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )
