"""The directed user graph: edges, degrees, roles, betweenness; the inviter-item graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sharelens.functions.skew import fits
from sharelens.operators.profile import summarize, top_n
from sharelens.operators.sampling import sample_nodes
from sharelens.session import checkpointed, scratch_path

MAX_BROADCAST_LINKS = 1_000_000
# Sources that share a row in the search for shortest paths: a bit and a few numbers each.
PACK = 32
PATHS, FLOWS = ([f"{name}_{i}" for i in range(PACK)] for name in ("paths", "flow"))


def graph_edges(shares: DataFrame) -> DataFrame:
    """Distinct ``(src, dst)`` from inviter to voter; self-loops stay."""
    return (
        shares.dropna(subset=["inviter_id", "voter_id"])
        .select(F.col("inviter_id").alias("src"), F.col("voter_id").alias("dst"))
        .distinct()
    )


def graph_nodes(edges: DataFrame) -> DataFrame:
    ends = edges.select(F.col("src").alias("user_id")).union(edges.select("dst"))
    return ends.distinct()


def degrees(edges: DataFrame) -> DataFrame:
    """In- and out-degree of every node; a self-loop counts in both.

    Both ends of an edge go through one aggregation, combined before the shuffle.
    """
    ends = edges.select(
        F.inline(
            F.array(
                F.struct(F.col("src").alias("user_id"), F.lit(0).alias("_in"), F.lit(1).alias("_out")),
                F.struct(F.col("dst").alias("user_id"), F.lit(1).alias("_in"), F.lit(0).alias("_out")),
            )
        )
    )
    return ends.groupBy("user_id").agg(
        F.sum("_in").alias("in_degree"), F.sum("_out").alias("out_degree")
    )


def degree_stats(edges: DataFrame) -> DataFrame:
    nodes = degrees(edges)
    rows = [
        summarize(nodes, column).select(F.lit(column).alias("measure"), "*")
        for column in ("in_degree", "out_degree")
    ]
    return rows[0].unionByName(rows[1])


def node_roles(edges: DataFrame) -> DataFrame:
    """Total degree, main role, strength of the role and drawing weight per node."""
    into, out = F.col("in_degree"), F.col("out_degree")
    larger = F.greatest(into, out)
    return degrees(edges).select(
        "user_id",
        (into + out).alias("total_degree"),
        F.when(into > out, "receiver").otherwise("sender").alias("role"),
        F.least(F.lit(1.0), larger / (into + out + F.lit(0.1).cast("double"))).alias("strength"),
        F.greatest(F.lit(20.0), F.log1p((into + out).cast("double")) * 30).alias("weight"),
    )


def graph_hubs(edges: DataFrame, n: int = 10) -> DataFrame:
    total = degrees(edges).withColumn("total_degree", F.col("in_degree") + F.col("out_degree"))
    return top_n(total, "user_id", "total_degree", n)


def graph_size(edges: DataFrame) -> DataFrame:
    nodes = graph_nodes(edges).agg(F.count(F.lit(1)).alias("n")).scalar()
    return edges.agg(F.count(F.lit(1)).alias("edges")).select(nodes.alias("nodes"), "edges")


def bipartite_degrees(shares: DataFrame, n_top: int = 5) -> DataFrame:
    """Degree and drawing weight of each inviter and item in the inviter-item graph.

    The two sides are kept apart, and the ``n_top`` highest of each are flagged.
    """
    pairs = shares.select("inviter_id", "item_id").dropna().distinct()
    ends = pairs.select(
        F.inline(
            F.array(
                F.struct(F.lit("inviter").alias("side"), F.col("inviter_id").alias("node_id")),
                F.struct(F.lit("item").alias("side"), F.col("item_id").alias("node_id")),
            )
        )
    )
    log = F.log1p(F.col("degree").cast("double"))
    weight = F.when(F.col("side") == "inviter", F.greatest(F.lit(30.0), log * 20))
    nodes = (
        ends.groupBy("side", "node_id")
        .agg(F.count(F.lit(1)).alias("degree"))
        .withColumn("weight", weight.otherwise(F.greatest(F.lit(20.0), log * 15)))
    )
    order = Window.partitionBy("side").orderBy(F.col("degree").desc(), "node_id")
    best = (
        nodes.withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= n_top)
        .select("side", "node_id", F.lit(True).alias("_top"))
    )
    flagged = nodes.join(F.broadcast(best), ["side", "node_id"], "left")
    return flagged.withColumn("is_top", F.coalesce("_top", F.lit(False))).drop("_top")


def bipartite_size(shares: DataFrame) -> DataFrame:
    """Inviters, items and share rows of the inviter-item graph."""
    known = shares.select("inviter_id", "item_id").dropna()

    def keys(column: str):
        return known.select(column).distinct().agg(F.count(F.lit(1)).alias("n")).scalar()

    rows = known.agg(F.count(F.lit(1)).alias("connections"))
    return rows.select(
        keys("inviter_id").alias("inviters"), keys("item_id").alias("items"), "connections"
    )


def induced_subgraph(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """The edges with both ends among ``nodes``, which are broadcast if they are counted to be few."""
    src, dst = (nodes.withColumnRenamed("user_id", end) for end in ("src", "dst"))
    if fits(nodes, MAX_BROADCAST_LINKS):
        src, dst = F.broadcast(src), F.broadcast(dst)
    return edges.join(src, "src", "left_semi").join(dst, "dst", "left_semi").select("src", "dst")


def betweenness(edges: DataFrame, n_nodes: int = 1000, seed: int = 42) -> DataFrame:
    """Betweenness of the subgraph induced by up to ``n_nodes`` sampled nodes.

    One search runs from all sources at once, one join per level.  Sources are packed
    by ``PACK``: a row holds, for a node that a pack reaches at a level, a bitmap of the
    sources and their numbers of shortest paths, so what moves is a row per (pack, node).
    A level is written once and never again; what was reached before is the bitwise or
    over the levels' bitmaps.  Then dependencies flow back level by level.  A lost
    executor costs one level.  Directed, scaled by 1 / ((n - 1) (n - 2)).
    """
    spark = edges.sparkSession
    nodes = checkpointed(sample_nodes(graph_nodes(edges), n_nodes, seed))
    links = checkpointed(induced_subgraph(edges, nodes).where(F.col("src") != F.col("dst")))
    out_links = F.broadcast(links) if fits(links, MAX_BROADCAST_LINKS) else links
    levels, flows = scratch_path(spark, "levels"), scratch_path(spark, "flows")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size, node_type = nodes.count(), nodes.schema["user_id"].dataType.simpleString()

    def columns(first: str, numbers: list[str]) -> str:
        return ", ".join(["pack long", f"node {node_type}", first, *[f"{c} double" for c in numbers], "level int"])

    def write(at: DataFrame, path: str) -> None:
        # Small rows, each joined with many links: as many files as there may be tasks.
        at.repartition(parts, "pack", "node").write.parquet(path)

    def sums(names: list[str]) -> list:
        return [F.expr(f"sum({name}) AS {name}") for name in names]

    def has(place: int) -> str:
        return f"bits & {1 << place}L <> 0"

    numbered = nodes.select(  # at most n_nodes rows
        F.col("user_id").alias("node"), (F.row_number().over(Window.orderBy("user_id")) - 1).alias("_at")
    )
    level = numbered.selectExpr(
        f"CAST(_at AS LONG) DIV {PACK} AS pack",
        "node",
        f"shiftleft(1L, _at % {PACK}) AS bits",
        *[f"CAST(_at % {PACK} = {i} AS DOUBLE) AS {paths}" for i, paths in enumerate(PATHS)],
    )
    depth, open_pairs = 0, size * size - size
    while True:
        write(level, f"{levels}/level={depth}")
        stored = spark.read.schema(columns("bits long", PATHS)).parquet(levels)
        level = level_at(stored, depth)
        if depth:
            found = level.agg(F.coalesce(F.sum(F.bit_count("bits")), F.lit(0))).first()[0]
            open_pairs -= found
            if not found:
                depth -= 1
                break
        if not open_pairs:
            break
        reached = stored.groupBy("pack", "node").agg(F.bit_or("bits").alias("_old"))
        step = (
            level.join(out_links, level["node"] == links["src"])
            .groupBy("pack", F.col("dst").alias("node"))
            .agg(F.bit_or("bits").alias("bits"), *sums(PATHS))
        )
        fresh = step.join(reached, ["pack", "node"], "left").withColumn("bits", F.expr("bits & ~coalesce(_old, 0L)"))
        level = fresh.where("bits <> 0").selectExpr(
            "pack", "node", "bits", *[f"IF({has(i)}, {p}, 0D) AS {p}" for i, p in enumerate(PATHS)]
        )
        depth += 1

    def passed_on(at: DataFrame, deltas: list[str]) -> DataFrame:
        """What a node gives to each of the paths that reach it, with the sum of its own."""
        shares = [f"IF({has(i)}, ({d} + 1) / {p}, 0D) AS {f}" for i, (p, d, f) in enumerate(zip(PATHS, deltas, FLOWS))]
        return at.selectExpr("pack", "node", " + ".join(deltas) + " AS _sum", *shares)

    flow = passed_on(level_at(stored, depth), ["0D"] * PACK)
    for k in range(depth - 1, 0, -1):
        arriving = (
            flow.join(out_links, flow["node"] == links["dst"])
            .groupBy("pack", F.col("src").alias("node"))
            .agg(*sums(FLOWS))
        )
        upper = level_at(stored, k).join(arriving, ["pack", "node"], "left")
        deltas = [f"coalesce({f}, 0D) * {p}" for p, f in zip(PATHS, FLOWS)]
        write(passed_on(upper, deltas), f"{flows}/level={k}")
        flow = level_at(spark.read.schema(columns("_sum double", FLOWS)).parquet(flows), k)

    # The first level is the sources themselves, the last passes nothing on.
    given = flow.where("false") if depth < 2 else spark.read.schema(columns("_sum double", [])).parquet(flows)
    totals = given.groupBy(F.col("node").alias("user_id")).agg(F.sum("_sum").alias("_sum"))
    scale = 1 / ((size - 1) * (size - 2)) if size > 2 else 1.0
    return nodes.join(totals, "user_id", "left").select(
        "user_id", (F.coalesce("_sum", F.lit(0.0)) * F.lit(scale)).alias("betweenness")
    )


def level_at(stored: DataFrame, level: int) -> DataFrame:
    return stored.where(F.col("level") == level).drop("level")


def network_features(edges: DataFrame, central: DataFrame) -> DataFrame:
    """Degrees of every node, with betweenness for the sampled ones."""
    return degrees(edges).join(central, "user_id", "left")
