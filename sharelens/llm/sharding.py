"""Shards by balanced label propagation.

Documents start evenly dealt, neighbours in runs.  In each round linked documents ask for the shard that
most of their neighbours are in.  As many of them move as can change places with each
other, in pairs or longer cycles, or with documents without links, so no shard's size
changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sharelens.llm.common import cases, ranked, stored

PATIENCE = 3


def _count_by(df: DataFrame, column: str) -> dict[int, int]:
    """Rows by shard: at most as many entries as there are shards."""
    return {r[0]: r[1] for r in df.groupBy(column).count().collect()}


def _starts(counts: dict[int, int], n_shards: int) -> dict[int, int]:
    starts, total = {}, 0
    for shard in range(n_shards):
        starts[shard] = total
        total += counts.get(shard, 0)
    return starts


def _rank_in(df: DataFrame, shard: str, order: list, n_shards: int, name: str) -> tuple[DataFrame, dict]:
    """``df`` with ``_rank``, its place within its shard, and the rows by shard."""
    rows = ranked(df, [shard, *order], name, "_all")
    counts = _count_by(rows, shard)
    start = cases(_starts(counts, n_shards), F.col(shard), "long")
    return rows.withColumn("_rank", F.col("_all") - start).drop("_all"), counts


def wishes(links: DataFrame, shards: DataFrame, votes: DataFrame) -> DataFrame:
    """``row, shard, target, votes, tie`` of the rows with as many neighbours elsewhere.

    A target is the shard with the most votes, if no fewer than at home.  Ties between
    shards follow ``tie``, a hash of the key, so that wishes go in all directions and the
    members of an evenly split key still agree on one shard.
    """
    asked = (
        links.join(votes, "key")
        .groupBy("row", "shard")
        .agg(F.sum("votes").alias("votes"), F.max("tie").alias("tie"))
        .groupBy("row")
        .agg(
            F.max(F.struct("votes", "tie", "shard")).alias("best"),
            F.sum("votes").alias("votes"),
        )
    )
    moves = asked.join(shards, "row").where(F.col("best.shard") != F.col("shard"))
    return moves.select("row", "shard", F.col("best.shard").alias("target"), "votes", "best.tie")


def admitted(wanted: dict[tuple[int, int], int], free: dict[int, int]) -> dict[tuple[int, int], int]:
    """How many of the ``wanted`` moves by (from, to) can be made at once.

    A shard may take as many as leave it and as it has ``free`` rows, which can leave for
    any place.  Too many newcomers are turned away, first from where most can stay;
    that may crowd their shards, so it goes on until all are right.  Without free rows
    what is left are cycles, swaps of two shards among them.
    """
    flow = dict(wanted)
    slack = dict.fromkeys({s for pair in flow for s in pair}, 0)
    for s in slack:
        slack[s] = free.get(s, 0)
    for (source, target), n in flow.items():
        slack[source] += n
        slack[target] -= n
    while min(slack.values(), default=0) < 0:
        target = min(slack, key=lambda s: (slack[s], s))
        sources = sorted((pair[0] for pair, n in flow.items() if pair[1] == target and n), key=lambda s: (-slack[s], s))
        spare = sum(max(0, slack[s]) for s in sources)
        excess = -slack[target]
        for careful in (True, False):
            for s in sources:
                n = min(excess, flow[s, target], max(0, slack[s]) if careful and spare else flow[s, target])
                flow[s, target] -= n
                slack[s] -= n
                slack[target] += n
                excess -= n
    return {pair: n for pair, n in flow.items() if n}


def dealt(rows: DataFrame, links: DataFrame, n_shards: int) -> DataFrame:
    """``row, shard, linked``: linked rows in runs by their first key, the others one by one.

    Only a run's ends cut first keys; every shard gets its part of the other rows.
    """
    first = links.groupBy("row").agg(F.min("key").alias("key"))
    runs = ranked(first, ["key", "row"], "runs", "_all")
    n = first.count()
    size, longer = divmod(n, n_shards)
    place, head = F.col("_all"), longer * (size + 1)
    run = F.when(place < head, F.floor(place / (size + 1))).otherwise(
        longer + F.floor((place - head) / max(size, 1))
    )
    others = ranked(rows.join(first, "row", "left_anti").select("row"), ["row"], "others", "_all")
    return runs.select("row", run.cast("int").alias("shard"), F.lit(True).alias("linked")).unionByName(
        others.select(
            "row", F.pmod(place + longer, F.lit(n_shards)).cast("int").alias("shard"), F.lit(None).cast("boolean").alias("linked")
        )
    )


def in_parts(links: DataFrame, most: int) -> DataFrame:
    """``links`` without rows alone under their key; a key's rows, by number, in parts of ``most``.

    Every key is cut alike; one that fits a shard has one part.  Only few keys can have more
    than ``most`` rows: as many as there are shards, times the keys that a row has.
    """
    sizes = stored(links.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "key_sizes")

    def parted(part: Column) -> Column:
        return F.struct("key", part.cast("long").alias("part")).alias("key")

    whole = links.join(sizes.where(F.col("n") <= most).select("key"), "key").select("row", parted(F.lit(0)))
    large = links.join(F.broadcast(sizes.where(F.col("n") > most).select("key")), "key")
    placed = ranked(large, ["key", "row"], "large_keys", "_all")
    starts = F.broadcast(placed.groupBy("key").agg(F.min("_all").alias("_start")))
    part = F.floor((F.col("_all") - F.col("_start")) / most)
    return whole.unionByName(placed.join(starts, "key").select("row", parted(part)))


def balanced_shards(
    rows: DataFrame, links: DataFrame, n_shards: int = 16, max_rounds: int | None = None
) -> DataFrame:
    """``row, shard`` for each of ``rows`` (``row``: distinct integers 0, 1, ...).

    ``links`` holds ``row, key``: rows that share a key are neighbours, whatever their
    number, and a row may have several keys.  The shards' sizes differ by one at
    most, before and after every round.  Rows move along the flows that ``admitted`` finds,
    those with few neighbours first; rows without links leave for the places that came
    free.  A key with more rows than a shard holds counts as several, each but the last as
    large as a shard.
    Rounds end when nobody wishes to move, or when ``PATIENCE`` rounds in a row have not
    lowered the number of linked pairs that are cut; the best round counts.
    """
    links = stored(links, "links")
    most = max(1, -(-rows.count() // n_shards))
    links = stored(in_parts(links, most), "links_in_parts")
    state = stored(dealt(rows, links, n_shards), "dealt")
    best, together, waited, turn = state, -1, 0, 0
    while True:
        members = state.where(F.col("linked")).select("row", "shard")
        # Counted by (key, shard) first: a key adds as many rows as there are shards to any member.
        votes = links.join(members, "row").groupBy("key", "shard").agg(F.count(F.lit(1)).alias("votes"))
        # Other ties every round, or what cannot change places now never could.
        votes = stored(votes.withColumn("tie", F.xxhash64("key", "shard", F.lit(turn))), f"votes_{turn}")
        pairs = votes.agg(F.sum(F.col("votes") * F.col("votes"))).first()[0] or 0
        waited = 0 if pairs > together else waited + 1
        if pairs > together:
            best, together = state, pairs
        if waited >= PATIENCE or turn == max_rounds:
            break
        asked = wishes(links, members, votes).withColumn("flow", F.col("shard") * n_shards + F.col("target"))
        moves, wanted = _rank_in(asked, "flow", ["votes", "tie", "row"], n_shards * n_shards, f"wishes_{turn}")
        if not wanted:
            break
        free, free_by = _rank_in(
            state.where(F.col("linked").isNull()).select("row", "shard"),
            "shard", ["row"], n_shards, f"free_{turn}",
        )
        flow = admitted({divmod(f, n_shards): n for f, n in wanted.items()}, free_by)
        turn += 1
        if not flow:
            continue  # with other ties
        quota = cases({s * n_shards + t: n for (s, t), n in flow.items()}, F.col("flow"), "long")
        moves = stored(moves.where(F.col("_rank") < quota), f"moves_{turn}")
        surplus = dict.fromkeys(range(n_shards), 0)
        for (source, target), n in flow.items():
            surplus[source] -= n
            surplus[target] += n
        crowded = {s: n for s, n in surplus.items() if n > 0}
        places = {s: -n for s, n in surplus.items() if n < 0}
        out_starts, in_starts = _starts(crowded, n_shards), _starts(places, n_shards)
        place = F.col("_rank") + cases(out_starts, F.col("shard"), "long")
        target = F.lit(None).cast("int")
        for shard in places:
            start = in_starts[shard]
            target = F.when((place >= start) & (place < start + places[shard]), shard).otherwise(target)
        makers = free.where(F.col("_rank") < cases(crowded, F.col("shard"), "long"))
        changed = moves.select("row", "target").unionByName(makers.select("row", target.alias("target")))
        state = stored(
            state.join(changed, "row", "left").select(
                "row", F.coalesce("target", "shard").alias("shard"), "linked"
            ),
            f"state_{turn}",
        )
    return best.select("row", "shard")


def shard_documents(
    docs: DataFrame,
    n_shards: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_rounds: int | None = None,
) -> DataFrame:
    """Every row of ``docs`` in one of ``n_shards`` shards, equal texts together.

    Returns ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.  The law is
    ``rows``: the shards' row counts are at most one apart.  Equal texts are linked
    and share a shard unless the quotas forbid it; a text with more rows than a shard
    fills as few shards as the rounds find.  ``slot`` numbers a shard's rows by id; ``grown_shard`` is NULL.

    NULL text has size 1 and counts as empty.  Repeated rows and NULL ids are rows
    like others.  Other columns are not read.  An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.sha2(text, 256).alias("_text_key"),
    )
    slim = ranked(slim, ["doc_id", "_text_key"], "slim", "row")
    several = slim.groupBy("_text_key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    several = stored(several, "several")
    links = slim.join(several, "_text_key").select("row", F.col("_text_key").alias("key"))
    placed = slim.join(balanced_shards(slim.select("row"), links, n_shards, max_rounds), "row")
    slots, _ = _rank_in(placed, "shard", ["doc_id", "row"], n_shards, "placed")
    return slots.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        F.col("_rank").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
