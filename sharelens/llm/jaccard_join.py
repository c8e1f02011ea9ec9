"""Jaccard self-join over word shingles through a token-group matrix.

Two sets that overlap enough share at least ``OVERLAP`` tokens of their prefixes, the
first tokens in an order that puts frequent ones last.  Similar sets are first
partitioned into groups; the matrix holds each group's union of prefix tokens.  A
query opens a group only if its overlap with that union and the sizes allow a link;
members of opened groups are then compared exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sharelens.functions.skew import fits
from sharelens.llm.common import components, released, small_batches, stored, whole_row
from sharelens.llm.shingles import Shingles, distinct, pieces, set_id, shingle_sets, shingles

OVERLAP = 3
LAST_SIZES = 4
FREQUENT = 8
BATCH_FREQUENT = 2
MAX_FREQUENT = 1_000_000
WORD_BITS = 20
MOST_COMMON = 127
KEEP_BITS = 56
FILTER_BITS = 24
BROADCAST_IDS = 1_000_000
OPEN_ROWS = 256
HOT_SETS = 32
BLOCK = ("grp", "m_part", "q_part")
PREFIX_SCHEMA = "doc_id long, text_id long, set_id long, n long, prefix array<long>"


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_id"), text.alias("_text")
    )


def common_words_and_tokens(texts: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How common words are; tokens that several documents have, sorted; how common these are.

    Words are counted by the first ``WORD_BITS`` bits of their hash.  Of the tokens at most
    ``MAX_FREQUENT`` are listed, the most frequent: every batch counts all its tokens and
    reports those of ``BATCH_FREQUENT`` documents or more.  Counts become numbers up to
    ``MOST_COMMON`` that grow with their logarithm.  All this only orders tokens: any
    numbers and any list give the same links.
    """

    def rows(values, counts, word):
        columns = [pa.array(values.astype(np.int64)), pa.array(counts.astype(np.int64)), pa.array(np.full(len(values), word))]
        return pa.RecordBatch.from_arrays(columns, names=["token", "n", "word"])

    def run(batches):
        words, turns = np.zeros(1 << WORD_BITS, np.int64), 0
        for batch in released(batches):
            sets = [np.empty(0, np.uint64)]
            for piece in pieces(batch.column("_text")):
                found = shingles(piece, k)
                words += np.bincount(word_place(found.words), minlength=len(words))
                sets += [distinct(found.tokens[i:j]) for i, j in zip(found.starts.tolist(), found.ends.tolist())]
            tokens, counts = np.unique(np.concatenate(sets), return_counts=True)
            often = counts >= BATCH_FREQUENT
            turns += 1
            yield rows(tokens[often].view(np.int64), counts[often], False)
        often = np.flatnonzero(words >= BATCH_FREQUENT * max(1, turns))
        yield rows(often, words[often], True)

    counts = texts.select("_text").mapInArrow(run, "token long, n long, word boolean")
    often = counts.groupBy("token", "word").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT)
    often = stored(often, "frequent")
    words = often.where("word").select(F.col("token").cast("int"), "n").toArrow()
    common = np.zeros(1 << WORD_BITS, np.uint8)
    common[words.column("token").to_numpy()] = graded(words.column("n").to_numpy())
    tokens = often.where("NOT word").orderBy(F.col("n").desc(), "token").limit(MAX_FREQUENT).select("token", "n").toArrow()
    listed = tokens.column("token").to_numpy().view(np.uint64)
    order = np.argsort(listed)
    return common, listed[order], graded(tokens.column("n").to_numpy())[order]


def graded(counts: np.ndarray) -> np.ndarray:
    """Numbers from 0 to ``MOST_COMMON`` that grow with the logarithm of the counts."""
    if not len(counts):
        return np.empty(0, np.uint8)
    return np.rint(np.log1p(counts) / np.log1p(counts.max()) * MOST_COMMON).astype(np.uint8)


def word_place(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(64 - WORD_BITS)).astype(np.int64)


def in_sorted(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(values), bool)
    places = np.searchsorted(table, values)
    places[places == len(table)] = 0
    return table[places] == values


def ordered_tokens(found: Shingles, k: int, common: np.ndarray, often: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The tokens of ``found`` by names that sort by how many other texts are likely to have them.

    The first ``64 - KEEP_BITS`` bits are, for a token in ``often``, its ``counts`` above
    ``MOST_COMMON``, else the mean of how common its words are: texts of one origin share
    the former, others by chance those with common words only.  The other bits are the
    token's own.
    """
    grades, sums = common[word_place(found.words)], np.zeros(len(found.words), np.uint32)
    for i in range(min(k, len(grades))):
        sums[: len(grades) - i] += grades[i:]
    order = (sums // np.uint32(k)).astype(np.uint64)
    few = np.flatnonzero((found.sizes > 0) & (found.sizes < k))
    for start, size in zip(found.starts[few].tolist(), found.sizes[few].tolist()):
        order[start] = int(grades[start : start + size].sum(dtype=np.int64)) // size
    if len(often):
        places = np.searchsorted(often, found.tokens)
        places[places == len(often)] = 0
        hits = np.flatnonzero(often[places] == found.tokens)
        order[hits] = counts[places[hits]].astype(np.uint64) + np.uint64(MOST_COMMON + 1)
    return order << np.uint64(KEEP_BITS) | found.tokens >> np.uint64(64 - KEEP_BITS)


def prefixes(texts: DataFrame, k: int, percent: int, ordering) -> DataFrame:
    """``doc_id, text_id, set_id, n, prefix``; the prefix only for a set's first copy in a batch.

    An overlap of ``percent`` % needs ``ceil(n * percent / 100)`` common tokens, so of
    any two such sets the first ``n - that + OVERLAP`` tokens share ``OVERLAP``.
    ``ordering``: what ``common_words_and_tokens`` found, broadcast.
    """

    def run(batches):
        for batch in released(batches):
            seen, rows = set(), []
            for piece in pieces(batch.column("_text")):
                found = shingles(piece, k)
                names = ordered_tokens(found, k, *ordering.value)
                for start, end in zip(found.starts.tolist(), found.ends.tolist()):
                    tokens = distinct(found.tokens[start:end])
                    n, name, prefix = len(tokens), set_id(tokens), None
                    need = -(-n * percent // 100)
                    if name not in seen and need >= OVERLAP:
                        seen.add(name)
                        prefix = distinct(names[start:end])[: n - need + OVERLAP].view(np.int64)
                    rows.append((name, n, prefix))
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()))
            columns = [pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 3, kinds)]
            columns = [batch.column("doc_id"), batch.column("text_id"), *columns]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_id", "set_id", "n", "prefix"])

    return texts.mapInArrow(run, PREFIX_SCHEMA)


def shared_postings(sets: DataFrame) -> DataFrame:
    """``token, set_id, n`` of the tokens that several sets have.

    Rows stream through a sorted partition: the token's first set and the next row tell
    whether there are several, and of the copies of one set only the last row stays.  A
    set has many tokens, so even one that all sets have is a small share of the rows.
    """
    posts = sets.where(F.col("prefix").isNotNull()).select("set_id", "n", F.explode("prefix").alias("token"))
    rows = Window.partitionBy("token").orderBy("set_id")
    first = F.first("set_id").over(rows.rowsBetween(Window.unboundedPreceding, 0))
    marked = posts.withColumns({"_first": first, "_next": F.lead("set_id").over(rows)})
    last_copy = F.col("_next").isNull() | (F.col("_next") != F.col("set_id"))
    several = F.col("_next").isNotNull() | (F.col("_first") != F.col("set_id"))
    return marked.where(last_copy & several).select("token", "set_id", "n")


def id_filter(ids: DataFrame) -> np.ndarray:
    """A bit map of ``2 ** FILTER_BITS`` bits with the bit of each ``text_id`` set.

    Its size is fixed, so it can go to all tasks; a wrong hit costs a row, no link.
    """
    bit = F.col("text_id").bitwiseAND((1 << FILTER_BITS) - 1)
    words = ids.groupBy(F.shiftright(bit, 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(text_id & 63 as int))")).alias("bits")
    )
    found = words.toArrow()
    bits = np.zeros(max(1, 1 << (FILTER_BITS - 6)), np.uint64)
    bits[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return bits


def wanted_texts(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """``text_id, _text`` of the texts wanted (and a few more), each once.

    Most texts are passed over where they are read, so few go through the shuffle.  The
    result is dealt by ``text_id``: a join on it moves no text again.
    """
    wanted = texts.sparkSession.sparkContext.broadcast(id_filter(ids))

    def run(batches):
        bits = wanted.value
        for batch in batches:
            place = batch.column("text_id").to_numpy() & ((1 << FILTER_BITS) - 1)
            hit = bits[place >> 6] >> (place & 63).astype(np.uint64) & np.uint64(1)
            yield batch.filter(pa.array(hit.astype(bool)))

    found = texts.select("text_id", "_text").mapInArrow(run, "text_id long, _text string")
    return found.dropDuplicates(["text_id"])


def texts_of_sets(texts: DataFrame, sets: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """``set_id, _text``: one text for each of ``ids``; smaller to move than the set."""
    text_of = sets.select("set_id", "text_id").join(ids, "set_id", "left_semi")
    text_of = stored(text_of.groupBy("set_id").agg(F.min("text_id").alias("text_id")), f"{name}_ids")
    whole = wanted_texts(texts, text_of.select("text_id")).join(text_of, "text_id")
    return stored(whole.select("set_id", "_text"), f"{name}_sets")


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    if 100 * len(small) < percent * len(large):
        return False
    common = int(in_sorted(small, large).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def sets_by_id(ids: pa.Array, texts: pa.Array, k: int) -> tuple[list[np.ndarray], list[int]]:
    """The sets of ``texts``, each id's once, and each row's place among them."""
    _, first, at = np.unique(ids.to_numpy(), return_index=True, return_inverse=True)
    return list(shingle_sets(texts.take(pa.array(first)), k)), at.tolist()


def verified_stars(pairs: DataFrame, texts: DataFrame, sets: DataFrame, k: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (``a``, its center ``b``) whose whole sets overlap by ``percent`` %."""
    pairs = stored(pairs, "star_pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("set_id")).distinct()
    whole = texts_of_sets(texts, sets, ids, "star")

    def run(batches):
        for batch in released(batches):
            texts = pa.concat_arrays([batch.column("text_a"), batch.column("text_b")])
            found, at = sets_by_id(pa.concat_arrays([batch.column("a"), batch.column("b")]), texts, k)
            keep = [linked(found[x], found[y], percent) for x, y in zip(at[: len(batch)], at[len(batch) :])]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    first = whole.select(F.col("set_id").alias("a"), F.col("_text").alias("text_a"))
    second = whole.select(F.col("set_id").alias("b"), F.col("_text").alias("text_b"))
    return stored(pairs.join(first, "a").join(second, "b").mapInArrow(run, "a long, b long"), "stars")


def enough(common: Column, n: Column, m: Column, percent: int) -> Column:
    """Can sets of ``n`` and ``m`` tokens link that share ``common`` tokens of their prefixes?

    Up to where the first of the two prefixes ends, all common tokens are counted;
    after it, that set has as many tokens as its prefix leaves out.
    """
    need = F.ceil((n + m) * percent / F.lit(100 + percent) - F.lit(1e-9))
    left_out = F.ceil(F.greatest(n, m) * percent / F.lit(100) - F.lit(1e-9)) - OVERLAP
    return (common >= OVERLAP) & (common + left_out >= need)


def enough_for_any(common: Column, n: Column, small: Column, large: Column, percent: int) -> Column:
    """Is there a size from ``small`` to ``large`` that ``enough`` allows with ``n``?

    Of sizes up to ``n`` the smallest needs least.  Beyond, the need less what is left out
    falls by ``percent ** 2 / (100 * (100 + percent))`` a token, over 0.27; rounding lifts
    it by less than one, so one of the four largest sizes needs least.
    """
    low = F.greatest(small, F.ceil(n * percent / F.lit(100) - F.lit(1e-9)))
    high = F.least(large, F.floor(n * 100 / F.lit(percent) + F.lit(1e-9)))
    may = enough(common, n, low, percent)
    for less in range(LAST_SIZES):
        may = may | enough(common, n, F.greatest(low, high - less), percent)
    return may


def block_starts(rows: pa.RecordBatch) -> np.ndarray:
    """Where the blocks begin in rows that are sorted by block."""
    keys = [rows.column(c).to_numpy() for c in BLOCK]
    new = np.ones(len(rows), bool)
    new[1:] = np.logical_or.reduce([key[1:] != key[:-1] for key in keys])
    return np.flatnonzero(new)


def may_be_enough(common: Column, n: Column, small: Column, large: Column, percent: int) -> Column:
    """``enough_for_any`` without rounding: no less, and little work for each row of a join.

    The need less what is left out falls with the distance of the two sizes, so the
    smallest or the largest size needs least.
    """
    share, part = percent / (100 + percent), percent / 100
    ends = [(n + m) * F.lit(share) - F.greatest(n, m) * F.lit(part) for m in (small, large)]
    return common >= F.least(*ends) + F.lit(OVERLAP - 1 - 1e-6)


def opened_links(met: DataFrame, members: DataFrame, texts: DataFrame, sets: DataFrame, k: int, percent: int) -> DataFrame:
    """A link ``a, b`` for each query that has one into a group it opened.

    ``met``: ``set_id, grp``.  Queries and members meet in blocks of about ``OPEN_ROWS`` of
    each, so no pair is ever a row, however many queries open a large group.
    """
    met = stored(met, "met")
    asked = met.groupBy("grp").agg(F.count(F.lit(1)).alias("q"))
    inside = members.join(asked, "grp", "left_semi")
    sizes = inside.groupBy("grp").agg(F.count(F.lit(1)).alias("m")).join(asked, "grp")
    sizes = stored(
        sizes.select("grp", F.ceil(F.col("m") / OPEN_ROWS).alias("m_parts"), F.ceil(F.col("q") / OPEN_ROWS).alias("q_parts")),
        "opened_sizes",
    )
    ids = met.select("set_id").unionByName(inside.select("set_id")).distinct()
    whole = texts_of_sets(texts, sets, ids, "opened")

    def dealt(rows: DataFrame, asks: bool) -> DataFrame:
        own, other = ("q_part", "m_part") if asks else ("m_part", "q_part")
        every = F.sequence(F.lit(0).cast("long"), F.col(f"{other}s") - 1)
        return rows.select("set_id", "grp").join(sizes, "grp").select(
            "grp", "set_id", F.lit(asks).alias("asks"),
            F.pmod(F.xxhash64("set_id"), F.col(f"{own}s")).alias(own), F.explode(every).alias(other),
        )

    def links(rows: pa.RecordBatch) -> pa.RecordBatch:
        found, at = sets_by_id(rows.column("set_id"), rows.column("_text"), k)
        ids, asks = rows.column("set_id").to_pylist(), rows.column("asks").to_pylist()
        bounds = [*block_starts(rows).tolist(), len(rows)]
        links = []
        for start, end in zip(bounds[:-1], bounds[1:]):
            others = [j for j in range(start, end) if not asks[j]]
            for i in range(start, end):
                near = asks[i] and next((j for j in others if linked(found[at[i]], found[at[j]], percent)), None)
                if asks[i] and near is not None:
                    links.append((ids[i], ids[near]))
        columns = [pa.array(c, pa.int64()) for c in zip(*links)] or [pa.array([], pa.int64())] * 2
        return pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    def run(batches):
        rest = None  # the last block, which may go on in the next batch
        for batch in released(batches):
            rows = batch if rest is None else pa.concat_batches([rest, batch])
            if len(rows):
                end = int(block_starts(rows)[-1])
                rest = rows.slice(end)
                yield links(rows.slice(0, end))
        if rest is not None:
            yield links(rest)

    blocks = dealt(met, True).unionByName(dealt(inside, False)).join(whole, "set_id")
    blocks = blocks.repartition(*BLOCK).sortWithinPartitions(*BLOCK)
    return stored(blocks.mapInArrow(run, "a long, b long"), "across")


def opening_pairs(asking: DataFrame, matrix: DataFrame, percent: int) -> DataFrame:
    """``set_id, grp``: the groups that each set has enough tokens of its prefix in common with.

    ``asking``: ``token, common, set_id, n, grp, m``; ``matrix``: ``token, common, other,
    others, small, large``.  Tokens marked ``common``, as of a passage that many texts have,
    are mostly shared by sets that share nothing else.  So pairs come from the other
    tokens, and to these the common ones they share are added, pair by pair; pairs with
    common tokens alone come from sets and groups that have as many as a link needs.
    """
    lists = F.collect_list("token")
    of_set = asking.where("common").groupBy("set_id").agg(lists.alias("hot"))
    of_set = stored(of_set.withColumn("h", F.size("hot")), "hot_of_sets")
    of_group = matrix.where("common").groupBy("other").agg(lists.alias("other_hot"))
    of_group = stored(of_group.withColumn("other_h", F.size("other_hot")), "hot_of_groups")
    fewer = (F.col("m") < F.col("others")) | ((F.col("m") == F.col("others")) & (F.col("grp") < F.col("other")))
    near = (F.col("n") * percent <= F.col("large") * 100) & (F.col("small") * percent <= F.col("n") * 100)
    sizes = ["set_id", "n", "other", "small", "large"]

    def may(common: Column) -> Column:
        return enough_for_any(common, F.col("n"), F.col("small"), F.col("large"), percent)

    rare = asking.where("NOT common").join(matrix.where("NOT common").drop("common"), "token").where(fewer & near)
    rare = rare.groupBy(*sizes).agg(F.count(F.lit(1)).alias("c"))
    rare = rare.join(of_set, "set_id", "left").join(of_group, "other", "left")
    none = F.col("hot").isNull() | F.col("other_hot").isNull()
    for more in (F.least("h", "other_h"), F.size(F.array_intersect("hot", "other_hot"))):
        rare = rare.where(may(F.col("c") + F.when(none, 0).otherwise(more)))

    sets = asking.where("common").join(of_set.select("set_id", "h"), "set_id")
    groups = matrix.where("common").drop("common").join(of_group.select("other", "other_h"), "other")
    most = may_be_enough(F.least("h", "other_h"), F.col("n"), F.col("small"), F.col("large"), percent)
    alone = sets.join(groups, "token").where(fewer & near & most)
    alone = alone.groupBy(*sizes).agg(F.count(F.lit(1)).alias("c")).where(may(F.col("c")))
    pairs = rare.select("set_id", F.col("other").alias("grp")).unionByName(alone.select("set_id", F.col("other").alias("grp")))
    return pairs.distinct()


def linked_sets(texts: DataFrame, sets: DataFrame, k: int, percent: int) -> DataFrame:
    """``vertex, component`` of the sets in links between different sets."""
    posts = stored(shared_postings(sets), "postings")

    # Groups: each set goes with the center that most of its tokens name, if they link.  A
    # token's center is the set most of whose prefix others have too: of many edited
    # copies, that is the one nearest to the original.
    shares = posts.groupBy("set_id").agg(F.count(F.lit(1)).alias("shared"))
    prefix = F.col("n") - F.ceil(F.col("n") * percent / F.lit(100)) + OVERLAP
    scored = posts.join(shares, "set_id").select("token", "set_id", "n", (F.col("shared") / prefix).alias("share"))
    scored = stored(scored, "scored")
    centers = scored.groupBy("token").agg(F.max(F.struct("share", "set_id", "n")).alias("best"))
    centers = stored(centers.select("token", F.col("best.set_id").alias("b"), F.col("best.n").alias("n_b")), "centers")
    votes = scored.join(centers, "token").where("b <> set_id").groupBy("set_id", "n", "b", "n_b")
    votes = votes.agg(F.count(F.lit(1)).alias("c"))
    sizes = F.least("n", "n_b") * 100 >= F.greatest("n", "n_b") * percent
    votes = votes.where(sizes & enough(F.col("c"), F.col("n"), F.col("n_b"), percent))
    best = votes.groupBy(F.col("set_id").alias("a")).agg(F.max_by("b", F.struct("c", "b")).alias("b"))
    stars = verified_stars(best, texts, sets, k, percent)
    groups = components(stars, "groups")

    # The matrix: each group's union of tokens, as far as other groups have them too.
    named = posts.join(groups.select(F.col("vertex").alias("set_id"), "component"), "set_id", "left")
    named = stored(named.withColumn("grp", F.coalesce("component", "set_id")).drop("component"), "named")
    ends = named.groupBy("token").agg(F.min("grp").alias("low"), F.max("grp").alias("high"), F.count(F.lit(1)).alias("q"))
    several = stored(ends.where("low <> high").select("token", (F.col("q") > HOT_SETS).alias("common")), "several")
    members = stored(named.select("set_id", "n", "grp").distinct(), "members")
    shape = members.groupBy("grp").agg(
        F.count(F.lit(1)).alias("m"), F.min("n").alias("small"), F.max("n").alias("large")
    )
    shape = stored(shape, "shape")
    # Of two groups the one with fewer sets asks.
    asking = stored(named.join(several, "token").join(shape.select("grp", "m"), "grp"), "asking")
    matrix = asking.select("token", "common", "grp").distinct().join(shape, "grp")
    matrix = stored(
        matrix.select("token", "common", F.col("grp").alias("other"), F.col("m").alias("others"), "small", "large"), "matrix"
    )
    met = opening_pairs(asking, matrix, percent)
    across = opened_links(met, members.select("set_id", "grp"), texts, sets, k, percent)
    return components(stars.unionByName(across), "links")


def near_duplicates(
    docs: DataFrame,
    k: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every row of ``docs`` with the component of links that it belongs to.

    Returns ``doc_id, n_shingles, component_id``.  Rows link when the Jaccard
    similarity of their sets of ``k``-word shingles is at least ``percent`` %; the
    component's id is its smallest document id.  ``percent`` must be over 67, so that
    sets too small for the prefix rule can link only when equal.

    NULL text counts as empty; a text without words is linked with nothing, itself
    under its own id.  Rows that repeat an id, or have none, are rows like others: a
    NULL id takes the component's smallest id, NULL if all are.  Equal sets link.
    Sets are told apart by 64-bit hashes.  Other columns are not read; an empty table
    gives no rows.
    """
    if not 67 < percent <= 100:
        raise ValueError("percent must be over 67 and at most 100")
    spark = docs.sparkSession
    small_batches(spark)
    texts = _texts(docs, id_col, text_col)
    ordering = spark.sparkContext.broadcast(common_words_and_tokens(texts, k))
    sets = stored(prefixes(texts, k, percent, ordering), "prefixes")
    links = linked_sets(texts, sets, k, percent)
    slim = sets.select("doc_id", "set_id", "n").join(
        links.select(F.col("vertex").alias("set_id"), "component"), "set_id", "left"
    )
    named = stored(slim.withColumn("component", F.coalesce("component", "set_id")), "named_documents")
    wordy = F.col("n") > 0
    smallest = named.where(wordy).groupBy("component").agg(F.min("doc_id").alias("_first"))
    smallest = stored(smallest, "smallest")
    return named.join(smallest, "component", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(wordy, F.col("_first")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def drop_near_duplicates(
    docs: DataFrame,
    k: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are the first of their component.

    The first is the one with the smallest id, NULL last.  Rows without words all stay.
    """
    whole = whole_row(docs).alias("doc")
    rows = stored(docs.select(F.monotonically_increasing_id().alias("_row"), whole), "rows")
    texts = rows.select("_row", F.col("doc")[text_col].alias("text"), F.col("doc")[id_col].alias("_id"))
    found = near_duplicates(texts, k, percent, "_row", "text").where("n_shingles > 0")
    linked = found.select(F.col("doc_id").alias("_row"), F.col("component_id").alias("_component"))
    several = linked.groupBy("_component").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_component")
    several = stored(linked.join(several, "_component").join(texts.select("_row", "_id"), "_row"), "several")
    first = several.groupBy("_component").agg(
        F.min(F.struct(F.col("_id").isNull().alias("missing"), "_id", "_row")).alias("_first")
    )
    first = stored(first, "first")
    gone = several.join(first, "_component").where(F.col("_row") != F.col("_first._row")).select("_row")
    gone = stored(gone, "gone")
    if fits(gone, BROADCAST_IDS):
        gone = F.broadcast(gone)
    return rows.join(gone, "_row", "left_anti").select("doc.*")
