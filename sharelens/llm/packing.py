"""Best-fit packing of documents into sequences, planned over counts of lengths."""

from __future__ import annotations

import zlib
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sharelens.llm import pieces
from sharelens.llm.common import cases, ranked, released, small_batches

SEQUENCE = 2048
END_ID = 0
BATCH_BYTES = 4 << 20
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLAN_SCHEMA = "length long, first long, n long, per long, sequence long, base long"


def token_pieces(
    docs: DataFrame, tokenizer_path: str, ranks_path: str | None, size: int, end_id: int
) -> DataFrame:
    """``docs`` (``doc_id, _text``) as pieces of at most ``size`` ids.

    A longer document gives its remainder first and full pieces after it.
    """
    end = end_id.to_bytes(4, "little")

    def run(batches):
        encode = pieces.id_encoder(tokenizer_path, ranks_path)
        for batch in released(batches):
            out = []
            # One text after the other: lists of all texts and ids would be the most of a worker's memory.
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("_text")):
                (ids,) = encode([text.as_py()])
                ids += end
                total = len(ids) // 4
                stop, start, place = (total - 1) % size + 1, 0, 0
                while start < total:
                    crc = zlib.crc32(memoryview(ids)[4 * start : 4 * stop])
                    out.append((doc_id, place, start, stop - start, crc))
                    start, stop, place = stop, stop + size, place + 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 5, kinds)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.mapInArrow(run, PIECE_SCHEMA)


def best_fit_plan(histogram: dict[int, int], size: int) -> list[tuple[int, int, int, int, int, int]]:
    """Where the pieces of each length go: ``(length, first, n, per, sequence, base)``.

    Of the pieces of a length, numbers ``first`` to ``first + n - 1`` go ``per`` to a
    sequence, from ``sequence`` on, from offset ``base`` in each.  Longest first, each
    into the fullest sequence that still has room; equal sequences are handled
    together, so the plan grows with the number of lengths, not of pieces.
    """
    room: dict[int, list[tuple[int, int]]] = defaultdict(list)
    plan, used = [], 0
    for length in sorted(histogram, reverse=True):
        done, left = 0, histogram[length]
        for space in range(length, size + 1):
            while left and (room.get(space) or space == size):
                sequence, bins = room[space].pop() if room.get(space) else (used, left)
                per = space // length
                fresh = sequence == used
                whole = min(bins, left // per)
                if whole:
                    n, taken, rest = whole * per, whole, space - per * length
                else:
                    n, taken, per, rest = left, 1, left, space - left * length
                plan.append((length, done, n, per, sequence, size - space))
                if rest:
                    room[rest].append((sequence, taken))
                if fresh:
                    used += taken
                elif bins > taken:
                    room[space].append((sequence + taken, bins - taken))
                done, left = done + n, left - n
            if not left:
                break
    return plan


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    ranks_path: str | None = None,
    size: int = SEQUENCE,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every row of ``docs`` tokenised, ended by ``end_id`` and packed.

    Returns a row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id,
    offset``.  ``ranks_path`` names the tokenizer's vocabulary as ranks, if there is one;
    ids are then the same, and found faster.  Only documents over ``size`` ids are cut.  The driver sees the
    count of each length (at most ``size`` numbers) and plans over those; pieces are
    ranked within their length by a sort and find their place by a join on that rank.

    NULL text counts as empty: one piece with the end id alone.  Special strings in a
    text become what the library makes of them.  Repeated rows are packed each;
    other columns are not read; ids must be integers or NULL.  An empty table gives
    no rows.
    """
    spark = docs.sparkSession
    small_batches(spark, BATCH_BYTES)
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("_text"))
    order = ["length", "doc_id", "piece"]
    cut = ranked(token_pieces(slim, tokenizer_path, ranks_path, size, end_id), order, "pieces")
    histogram = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}
    starts, total = {}, 0
    for length in sorted(histogram):
        starts[length] = total
        total += histogram[length]
    plan = spark.createDataFrame(best_fit_plan(histogram, size), PLAN_SCHEMA)
    cut = cut.withColumn("_nth", F.col("_rank") - cases(starts, F.col("length"), "long"))
    nth = F.col("_nth") - F.col("first")
    fits = (cut["length"] == plan["length"]) & (cut["_nth"] >= plan["first"]) & (
        cut["_nth"] < plan["first"] + plan["n"]
    )
    return cut.join(F.broadcast(plan), fits).select(
        "doc_id", "piece", "start", cut["length"], "ids_crc32",
        (F.col("sequence") + F.floor(nth / F.col("per"))).cast("long").alias("sequence_id"),
        (F.col("base") + nth % F.col("per") * cut["length"]).cast("long").alias("offset"),
    )
