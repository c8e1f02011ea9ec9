"""Ranked lexical search over a length-stratified index.

Documents with the same length normaliser ``m`` form a stratum.  In a stratum a term's
impact depends on its frequency ``tf`` alone, so postings are kept by (term, tf) and an
impact is worked out once for all documents with that frequency.  The largest
frequencies of a stratum bound what it can add to a query; strata are visited by
falling bound, and those that cannot reach a query's k-th best score are not opened.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sharelens.llm.common import small_batches, stored

SEGMENT_POSTINGS = 400_000  # a stratum with more is cut into segments of about so many
MAX_LARGE_STRATA = 100_000
MAX_CHOSEN_TERMS = 1_000_000
BLOCK_PAIRS = 500_000  # (query, term) pairs that are searched together
FIRST_VISIT, VISIT_GROWTH = 8, 16

LEAST_M, LENGTH_SHARE = 10, 90
IMPACT_SCALE = 1_000_000_000

# Bytes outside 0-9, A-Z, a-z and UTF-8's part terms; A-Z become a-z.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

BAG_SCHEMA = "doc_id long, n long, terms array<binary>, tfs array<long>"
SEGMENT_SCHEMA = (
    "m long, part int, doc_ids array<long>, terms array<binary>, dfs array<long>, max_tfs array<long>, "
    "group_term array<int>, group_tf array<long>, group_size array<int>, members array<int>"
)


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text in order, lower-cased in A-Z only."""
    return text.translate(_FOLD).split()


@dataclass
class Index:
    """``segments`` of strata with their postings, and the counts over all documents.

    A segment has its documents, its terms with document counts and largest
    frequencies, and groups of equal (term, tf) one after the other in ``members``, which
    are places in ``doc_ids``.
    """

    segments: DataFrame
    n_docs: int
    n_terms: int


def _bags(docs: DataFrame, only: frozenset[bytes] | None) -> DataFrame:
    """Each document's number of terms and its distinct ones (of ``only``) with their counts."""

    def run(batches):
        for batch in batches:
            columns = [], [], []
            for text in batch.column("_text").cast(pa.binary()):
                words = terms_of(text.as_py())
                counts = Counter(words)
                kept = counts.keys() if only is None else counts.keys() & only
                columns[0].append(len(words))
                columns[1].append(list(kept))
                columns[2].append([counts[t] for t in kept])
            kinds = pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                names=["doc_id", "n", "terms", "tfs"],
            )

    return docs.mapInArrow(run, BAG_SCHEMA)


def _segment(table: pa.Table) -> pa.Table:
    """The documents of one segment turned into postings by (term, tf)."""
    table = table.combine_chunks().sort_by("doc_id")
    ids = table.column("doc_id").to_pylist()
    lists = table.column("terms").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    place = np.repeat(np.arange(len(ids), dtype=np.int32), np.diff(lists.offsets.to_numpy()))
    words = lists.flatten().dictionary_encode()
    vocabulary = words.dictionary.to_pylist()
    by_bytes = sorted(range(len(vocabulary)), key=vocabulary.__getitem__)
    rank = np.empty(len(vocabulary), np.int64)
    rank[by_bytes] = np.arange(len(vocabulary))
    term = rank[words.indices.to_numpy()]
    tfs = table.column("tfs").combine_chunks()
    tfs = tfs.chunk(0) if isinstance(tfs, pa.ChunkedArray) else tfs
    tf = tfs.flatten().to_numpy()
    order = np.lexsort((place, tf, term))
    place, term, tf = place[order], term[order], tf[order]
    starts = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (tf[1:] != tf[:-1])])
    sizes = np.diff(np.r_[starts, len(term)])
    ends = np.flatnonzero(np.r_[term[1:] != term[:-1], True])
    row = {
        "m": table.column("m")[0].as_py(),
        "part": table.column("part")[0].as_py(),
        "doc_ids": ids,
        "terms": [vocabulary[i] for i in by_bytes],
        "dfs": np.bincount(term, minlength=len(vocabulary)),
        "max_tfs": tf[ends],
        "group_term": term[starts].astype(np.int32),
        "group_tf": tf[starts],
        "group_size": sizes.astype(np.int32),
        "members": place,
    }
    kinds = dict(
        m=pa.int64(), part=pa.int32(), doc_ids=pa.list_(pa.int64()), terms=pa.list_(pa.binary()),
        dfs=pa.list_(pa.int64()), max_tfs=pa.list_(pa.int64()), group_term=pa.list_(pa.int32()),
        group_tf=pa.list_(pa.int64()), group_size=pa.list_(pa.int32()), members=pa.list_(pa.int32()),
    )
    return pa.table({k: pa.array([row[k]], kind) for k, kind in kinds.items()})


def build_index(
    docs: DataFrame,
    only: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    segment_postings: int = SEGMENT_POSTINGS,
) -> Index:
    """Index every row of ``docs``.

    ``only`` (``term``, binary) names the terms that will ever be asked for; others are
    then counted in lengths and not stored.  More than ``MAX_CHOSEN_TERMS`` of them are
    not sent to the tasks, and all terms are indexed.

    NULL text has no terms.  Rows with equal ids are documents of their own.  A stratum of
    any size is cut into segments by its postings, so a task holds one segment.
    """
    small_batches(docs.sparkSession)
    chosen = None
    if only is not None:
        only = stored(only.select("term").distinct(), "terms")
        if only.count() <= MAX_CHOSEN_TERMS:
            chosen = frozenset(bytes(r[0]) for r in only.collect())
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("_text"))
    bags = stored(_bags(slim, chosen), "bags")
    n_docs, n_terms = bags.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    m = F.expr(f"{LEAST_M}L + ({LENGTH_SHARE} * n * {n_docs}L) div {max(n_terms, 1)}L")
    held = bags.where(F.size("terms") > 0).withColumn("m", m)
    parts = F.ceil(F.sum(F.size("terms")) / segment_postings).cast("int")
    large = held.groupBy("m").agg(parts.alias("_parts")).where("_parts > 1")
    large = large.orderBy(F.col("_parts").desc(), "m").limit(MAX_LARGE_STRATA)
    spread = F.pmod(F.xxhash64("doc_id", "n", "tfs", F.monotonically_increasing_id()), F.coalesce("_parts", F.lit(1)))
    dealt = held.join(F.broadcast(large), "m", "left").withColumn("part", spread.cast("int")).drop("_parts", "n")
    segments = dealt.groupBy("m", "part").applyInArrow(_segment, SEGMENT_SCHEMA)
    return Index(stored(segments, "segments"), n_docs, n_terms)


class _Asked:
    """A block of queries as numbers: (query, term) pairs grouped by query, with weights."""

    def __init__(self, pairs: list[tuple[int, bytes, int]]):
        pairs = sorted(pairs)
        self.terms = {t: i for i, t in enumerate(sorted({t for _, t, _ in pairs}))}
        self.weight = np.zeros(len(self.terms) + 1, np.int64)
        for _, t, w in pairs:
            self.weight[self.terms[t]] = w
        number = np.array([q for q, _, _ in pairs], np.int64)
        self.pair_term = np.array([self.terms[t] for _, t, _ in pairs], np.int64)
        self.starts = np.flatnonzero(np.r_[True, number[1:] != number[:-1]])
        self.queries = number[self.starts]
        self.ends = np.r_[self.starts[1:], len(pairs)]

    def places(self, terms) -> np.ndarray:
        """The asked number of each of a segment's terms; one past the last if not asked."""
        none = len(self.terms)
        return np.array([self.terms.get(t, none) for t in terms], np.int64)

    def bounds(self, places: np.ndarray, best: np.ndarray) -> np.ndarray:
        """What the segment can add to each query at most."""
        most = np.zeros(len(self.weight), np.int64)
        most[places] = best
        return np.add.reduceat((most * self.weight)[self.pair_term], self.starts)


def _impacts(tf: np.ndarray, m: int) -> np.ndarray:
    return (IMPACT_SCALE * tf) // (1000 * tf + 8 * m)


def _arrays(batch, names) -> Iterator[dict]:
    """Rows of a batch with list columns as numpy arrays, and terms as bytes."""
    for i in range(batch.num_rows):
        row = {}
        for name in names:
            value = batch.column(name)[i]
            if name in ("m", "part"):
                row[name] = value.as_py()
            else:
                row[name] = value.as_py() if name in ("terms", "doc_ids") else value.values.to_numpy()
        yield row


def _bound_rows(segments: DataFrame, asked: _Asked) -> DataFrame:
    """``query, bound`` for every segment that can add to a query."""

    def run(batches):
        for batch in batches:
            for row in _arrays(batch, ("m", "terms", "max_tfs")):
                bound = asked.bounds(asked.places(row["terms"]), _impacts(row["max_tfs"], row["m"]))
                some = np.flatnonzero(bound)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(asked.queries[some]), pa.array(bound[some])], names=["query", "bound"]
                )

    return segments.select("m", "terms", "max_tfs").mapInArrow(run, "query long, bound long")


def _best(found: dict, query: int, ids: list, scores: np.ndarray, k: int) -> None:
    """Put a segment's scores above 0 to the ``k`` best of a query; ties go to the smaller id."""
    some = np.flatnonzero(scores)
    if len(some) > k:
        least = np.partition(scores[some], len(some) - k)[len(some) - k]
        some = some[scores[some] >= least]
    rows = found.get(query, []) + [(-int(scores[i]), ids[i] is None, ids[i] or 0) for i in some]
    found[query] = sorted(rows)[:k]


def _opened(segments: DataFrame, asked: _Asked, low: np.ndarray, high: np.ndarray, k: int) -> DataFrame:
    """The ``k`` best documents a task finds for each query in segments with ``low <= bound < high``."""

    def run(batches):
        found = {}
        for batch in batches:
            for row in _arrays(batch, batch.schema.names):
                places = asked.places(row["terms"])
                bound = asked.bounds(places, _impacts(row["max_tfs"], row["m"]))
                wanted = np.flatnonzero((bound >= low) & (bound < high) & (bound > 0))
                if not len(wanted):
                    continue
                impact = np.repeat(_impacts(row["group_tf"], row["m"]), row["group_size"])
                edge = np.r_[0, np.cumsum(row["dfs"])]
                local = np.full(len(asked.weight), -1, np.int64)
                local[places] = np.arange(len(places))
                local[-1] = -1
                for q in wanted:
                    scores = np.zeros(len(row["doc_ids"]), np.int64)
                    for t in asked.pair_term[asked.starts[q] : asked.ends[q]]:
                        at = local[t]
                        if at >= 0:
                            span = slice(edge[at], edge[at + 1])
                            # A document is in one group of a term only.
                            scores[row["members"][span]] += asked.weight[t] * impact[span]
                    _best(found, int(asked.queries[q]), row["doc_ids"], scores, k)
        rows = [(q, None if none else d, -s) for q, best in found.items() for s, none, d in best]
        columns = list(zip(*rows)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query", "doc_id", "score"])

    return segments.mapInArrow(run, "query long, doc_id long, score long")


def _top(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(index: Index, pairs: list[tuple[int, bytes, int]], k: int) -> DataFrame:
    """``query, rank, doc_id, score`` of a block, visiting segments by falling bound.

    Each round opens a query's next segments, ``VISIT_GROWTH`` times as many as before,
    as long as their bound reaches the k-th best score so far; an equal bound may still
    hold a smaller id with that score.
    """
    spark = index.segments.sparkSession
    asked = _Asked(pairs)
    bounds = stored(_bound_rows(index.segments, asked), "bounds")
    high = np.full(len(asked.queries), np.iinfo(np.int64).max)
    least = np.ones(len(asked.queries), np.int64)
    at = {int(q): i for i, q in enumerate(asked.queries)}
    found, visit = None, FIRST_VISIT
    while True:
        limits = spark.createDataFrame(
            [(int(q), int(h), int(s)) for q, h, s in zip(asked.queries, high, least)], "query long, high long, least long"
        )
        left = bounds.join(F.broadcast(limits), "query").where("bound < high AND bound >= least")
        order = Window.partitionBy("query").orderBy(F.col("bound").desc())
        next_ones = left.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") <= visit)
        low = np.full(len(asked.queries), np.iinfo(np.int64).max)
        for query, bound in next_ones.groupBy("query").agg(F.min("bound")).collect():
            low[at[query]] = bound
        if (low == np.iinfo(np.int64).max).all():
            break
        fresh = _opened(index.segments, asked, low, high, k)
        found = stored(_top(fresh if found is None else fresh.unionByName(found), k).drop("rank"), "found")
        for query, n, score in found.groupBy("query").agg(F.count(F.lit(1)), F.min("score")).collect():
            if n >= k:
                least[at[query]] = max(1, score)
        high = np.minimum(high, low)
        visit *= VISIT_GROWTH
    if found is None:
        return spark.createDataFrame([], "query long, rank int, doc_id long, score long")
    return _top(found, k).select("query", "rank", "doc_id", "score")


def query_terms(queries: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item_id, term``: the distinct terms of each query."""

    def run(batches):
        for batch in batches:
            rows = [
                (i, t)
                for i, text in zip(batch.column("item_id").to_pylist(), batch.column("_text").cast(pa.binary()))
                for t in set(terms_of(text.as_py()))
            ]
            ids, terms = list(zip(*rows)) or ([], [])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(terms, pa.binary())], names=["item_id", "term"])

    text = F.coalesce(F.col(text_col), F.lit("")).alias("_text")
    slim = queries.select(F.col(id_col).cast("long").alias("item_id"), text)
    return slim.mapInArrow(run, "item_id long, term binary").distinct()


def search(index: Index, asked: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best documents of every query (``asked``: ``item_id, term``, distinct).

    Returns ``item_id, rank, doc_id, score``.  A term's weight falls with the number of
    documents that hold it; a document's score adds weight times impact over the
    query's terms, in integers.  Only scores above 0 count; equal scores go by ascending
    id, NULL last.  Queries are searched in blocks of at most ``BLOCK_PAIRS`` pairs or one
    query, whatever their number.
    """
    spark = asked.sparkSession
    counted = index.segments.select(F.explode(F.arrays_zip("terms", "dfs")).alias("_e"))
    counted = counted.select(F.col("_e.terms").alias("term"), F.col("_e.dfs").alias("_df"))
    df = counted.groupBy("term").agg(F.sum("_df").alias("_df"))
    weight = F.floor(1000 * F.log((2 * F.lit(index.n_docs) + 2) / (2 * F.col("_df") + 1))).cast("long")
    pairs = stored(asked.join(df, "term").select("item_id", "term", weight.alias("weight")), "pairs")
    sizes = pairs.groupBy("item_id").agg(F.count(F.lit(1)).alias("_n"))
    result = None
    for block in _blocks(sizes):
        wanted = pairs.join(F.broadcast(block), F.col("item_id").eqNullSafe(F.col("_item")))
        rows = [(r[0], bytes(r[1]), r[2]) for r in wanted.select("_query", "term", "weight").collect()]
        best = _search_block(index, rows, k)
        names = F.broadcast(block.select("_query", F.col("_item").alias("item_id")))
        best = best.join(names, F.col("query") == F.col("_query")).select("item_id", "rank", "doc_id", "score")
        result = best if result is None else result.unionByName(best)
    empty = "item_id long, rank int, doc_id long, score long"
    return spark.createDataFrame([], empty) if result is None else result


def _blocks(sizes: DataFrame) -> Iterator[DataFrame]:
    """Queries (``_item``, numbered ``_query``) in blocks of bounded (query, term) pairs."""
    spark = sizes.sparkSession
    rows, held = [], 0
    for item, n in sizes.orderBy("item_id").toLocalIterator():
        if rows and held + n > BLOCK_PAIRS:
            yield spark.createDataFrame(rows, "_item long, _query long")
            rows, held = [], 0
        rows.append((item, len(rows)))
        held += n
    if rows:
        yield spark.createDataFrame(rows, "_item long, _query long")


def ranked_search(
    docs: DataFrame, queries: DataFrame, k: int = 10, segment_postings: int = SEGMENT_POSTINGS
) -> DataFrame:
    """The ``k`` best of all ``docs`` for each query row's text; see :func:`search`.

    Returns ``item_id, rank, doc_id, score``.  Query rows with one id are one query with the
    terms of all; a query without a term that some document holds has no rows.  Other
    columns of either table are not read; an empty table gives no rows.
    """
    asked = stored(query_terms(queries), "asked")
    return search(build_index(docs, asked, segment_postings=segment_postings), asked, k)
