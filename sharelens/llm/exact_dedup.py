"""Exact duplicates by deterministic block naming.

Equal texts have equal names and no others do: the name of a block stands for its
place among the distinct blocks, the name of two adjacent names for the place of
that pair among the distinct pairs, and so on up to one name a document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sharelens.llm.common import stored, whole_row

BLOCK_CHARS = 4096
EDGE_CHARS = 64
NO_NAME = -1
BITS_A_MARK, MIN_BITS, MAX_BITS = 16, 15, 30


def _names(values: DataFrame, level: int) -> DataFrame:
    """Each distinct row of ``values`` with an integer: its partition, then its sorted place.

    Equal rows meet by hash, not by range, so no sample of whole blocks goes to the driver.
    """
    distinct = values.distinct().sortWithinPartitions(*values.columns)
    return stored(distinct.withColumn("_name", F.monotonically_increasing_id()), f"names_{level}")


def _marks(edges: DataFrame, bits: int) -> DataFrame:
    """``_bucket, _bits``: a bit map of ``2 ** bits`` bits with a bit for every mark (``_edges``)."""
    place = F.pmod("_edges", F.lit(1 << bits))
    return edges.groupBy(F.bitmap_bucket_number(place).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bits")
    )


def _may_have_equal(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` (``_edges``: a hash of size and edges) with ``_maybe``: can another row be equal?

    Rows are counted by that hash alone.  The hashes of several rows go to all tasks as a bit
    map of ``BITS_A_MARK`` bits each, ``2 ** MAX_BITS`` bits at most, so no text is moved to
    find out.  A wrong hit costs the naming of one text and changes nothing.
    """
    shared = rows.groupBy("_edges").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_edges")
    shared = stored(shared, name)
    bits = min(MAX_BITS, max(MIN_BITS, (shared.count() * BITS_A_MARK).bit_length()))
    place = F.pmod("_edges", F.lit(1 << bits))
    marked = rows.withColumn("_bucket", F.bitmap_bucket_number(place)).withColumn("_place", F.bitmap_bit_position(place))
    marked = marked.join(F.broadcast(_marks(shared, bits)), "_bucket", "left")
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(_place div 8 as int) + 1, 1)")), 16, 10).cast("int")
    hit = F.expr("cast(_place % 8 as int)")
    bit = F.getbit(byte, hit) == 1
    return marked.withColumn("_maybe", F.coalesce(bit, F.lit(False))).drop("_bucket", "_place", "_bits")


def _grouped(docs: DataFrame, extra: list, id_col: str, text_col: str, block_chars: int, edge_chars: int):
    """Rows that surely have no equal, and the others with their group; both with ``extra`` columns."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = F.octet_length(text)
    keyed = docs.select(
        F.col(id_col).alias("doc_id"),
        text.alias("_text"),
        F.xxhash64(size, F.substring(text, 1, edge_chars), F.right(text, F.lit(edge_chars))).alias("_edges"),
        *extra,
    )
    marked = _may_have_equal(keyed, "shared")
    kept = [c for c in keyed.columns if c not in ("_text", "_edges")]
    pieces = F.regexp_extract_all("_text", F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0))
    blocks = F.when(F.col("_text") != "", pieces).otherwise(F.array(F.lit("")))
    several = stored(
        marked.where("_maybe").select(F.monotonically_increasing_id().alias("_row"), *kept, blocks.alias("_blocks")),
        "rows",
    )
    named = _name_documents(several)
    groups = named.groupBy("_name").agg(
        F.max(F.struct("doc_id", "_row")).alias("_keep"), F.count(F.lit(1)).alias("group_size")
    )
    groups = stored(groups, "groups")
    return marked.where("NOT _maybe").select(*kept), several, named.join(groups, "_name")


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_chars: int = BLOCK_CHARS,
    edge_chars: int = EDGE_CHARS,
) -> DataFrame:
    """Each row of ``docs`` with the row that stays among those of equal text.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256``; the largest id stays.

    A text whose size, first and last characters no other text has is its own
    group at once and stays where it is; every other text is cut into blocks, and names
    are given level by level.  Each level is written, so the plan stays short, and the
    levels are as many as the doublings in the longest text.

    NULL text counts as empty, and empty texts are equal.  Texts are compared as they
    are, without normalisation.  Rows that repeat an id are rows of their own; among
    equal ids one row stays.  NULL ids come last: one stays only if all are NULL.
    Other columns are not read.  An empty table gives an empty result.
    """
    digest = F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("text_sha256")
    alone, several, named = _grouped(docs, [digest], id_col, text_col, block_chars, edge_chars)
    alone = alone.select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    members = several.select("_row", "doc_id", "text_sha256").join(named.drop("doc_id"), "_row").select(
        "doc_id",
        F.col("_keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("_row") == F.col("_keep._row")).alias("kept"),
        "text_sha256",
    )
    return alone.unionByName(members)


def drop_exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_chars: int = BLOCK_CHARS,
    edge_chars: int = EDGE_CHARS,
) -> DataFrame:
    """The rows that ``exact_dedup`` keeps, with all columns of ``docs``, whatever their names.

    NULL text counts as empty.  Of rows that repeat an id and text one stays.
    """
    whole = whole_row(docs).alias("_doc")
    alone, several, named = _grouped(docs, [whole], id_col, text_col, block_chars, edge_chars)
    stay = named.where(F.col("_row") == F.col("_keep._row")).select("_row")
    kept = several.join(stay, "_row", "left_semi")
    return alone.select("_doc.*").unionByName(kept.select("_doc.*"))


def _name_documents(rows: DataFrame) -> DataFrame:
    """``_row, doc_id, _name``: equal names for equal lists of blocks."""
    who = ["_row", "doc_id"]
    blocks = rows.select(*who, F.posexplode("_blocks").alias("_place", "_block"))
    names = _names(blocks.select("_block"), 0)
    named = blocks.join(names, "_block").select(*who, "_place", "_name")
    longest = rows.agg(F.max(F.size("_blocks"))).first()[0] or 1
    for level in range(1, (longest - 1).bit_length() + 1):
        left = F.col("_place") % 2 == 0
        pairs = named.groupBy(*who, F.shiftright("_place", 1).alias("_pair")).agg(
            F.max(F.when(left, F.col("_name"))).alias("_left"),
            F.coalesce(F.max(F.when(~left, F.col("_name"))), F.lit(NO_NAME)).alias("_right"),
        )
        pairs = stored(pairs, f"pairs_{level}")
        names = _names(pairs.select("_left", "_right"), level)
        named = pairs.join(names, ["_left", "_right"]).select(
            *who, F.col("_pair").alias("_place"), "_name"
        )
    return stored(named, "named").drop("_place")
