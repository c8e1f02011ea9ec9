"""Conversations as a prefix tree of turns, formatted and tokenised.

Conversations that begin with the same turns share the nodes of those turns.  Nodes
are emitted once each, depth first; a node knows the position of its first token
within any conversation through it, and the intervals of the emitted stream that its
tokens may attend to: its ancestors and itself.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sharelens.llm import pieces
from sharelens.llm.common import ranked, small_batches, stored

# Marks of this template and of other common ones.
START, END = "<|im_start|>", "<|im_end|>"
CONTROL = [START, END, "<|endoftext|>", "<|startoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
LEARNED_ROLE = "assistant"

_CONTROL = re.compile("|".join(re.escape(c) for c in sorted(CONTROL, key=len, reverse=True)))
_TURN = re.compile(rf"{re.escape(START)}((?:[^\\\n]|\\.)*)\n(.*?){re.escape(END)}\n", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
NODE_SCHEMA = """node binary, parent binary, depth int, role string, ids binary,
    n_tokens int, learn_from int, learn_to int, owner long"""
CONV_SCHEMA = """conv_id long, n_turns long, turns_sha256 string, loss_chars long,
    loss_sha256 string, formatted_chars long, in_place boolean"""


def escape(text: str) -> str:
    """No control string is left in the result, and ``unescape`` gives ``text`` again."""
    doubled = text.replace("\\", "\\\\")
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], doubled)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def turn_parts(role: str, text: str) -> tuple[str, str, str]:
    """What stands before a turn's text, the text, and what ends it, formatted."""
    return START + escape(role).replace("\n", "\\\n") + "\n", escape(text), END + "\n"


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) pairs of a formatted conversation."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def conversation_paths(rows: DataFrame) -> DataFrame:
    """One row a conversation: its turns in order and the names of its tree nodes.

    A node's name digests its parent's name, its role and its text.
    """
    turns = rows.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")
    )

    def run(batches):
        for batch in batches:
            paths = []
            for turns in batch.column("turns").to_pylist():
                node, path = b"", []
                for t in turns:
                    role, text = (t[c].encode("utf-8", "surrogatepass") for c in ("role", "text"))
                    head = len(role).to_bytes(8, "little")
                    node = hashlib.blake2b(node + head + role + text, digest_size=16).digest()
                    path.append(node)
                paths.append(path)
            columns = [*batch.columns, pa.array(paths, pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "turns", "path"])

    schema = "conv_id long, turns array<struct<turn:long,role:string,text:string>>, path array<binary>"
    return turns.mapInArrow(run, schema)


def encoded_nodes(nodes: DataFrame, tokenizer_path: str, ranks_path: str | None) -> DataFrame:
    """Nodes with their tokens and the span of them that is learned."""

    def run(batches):
        encode = pieces.id_encoder(tokenizer_path, ranks_path)
        for batch in batches:
            rows = batch.to_pylist()
            sizes = [len(r["text"]) for r in rows]
            for a, b in pieces.text_groups([r["text"] for r in rows]) if any(sizes) else [(0, len(rows))]:
                some = rows[a:b]
                parts = [p for r in some for p in turn_parts(r["role"], r["text"])]
                ids = encode(parts)
                out = []
                for k, r in enumerate(some):
                    head, body, tail = ids[3 * k : 3 * k + 3]
                    learned = r["role"] == LEARNED_ROLE
                    start = len(head) // 4
                    stop = start + len(body) // 4 if learned else start
                    all_ids = head + body + tail
                    out.append({
                        "node": r["node"], "parent": r["parent"], "depth": r["depth"], "role": r["role"],
                        "ids": all_ids, "n_tokens": len(all_ids) // 4, "learn_from": start,
                        "learn_to": stop, "owner": r["owner"],
                    })
                kinds = pa.schema([
                    ("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int32()),
                    ("role", pa.string()), ("ids", pa.binary()), ("n_tokens", pa.int32()),
                    ("learn_from", pa.int32()), ("learn_to", pa.int32()), ("owner", pa.int64()),
                ])
                yield pa.RecordBatch.from_pylist(out, schema=kinds)

    return nodes.mapInArrow(run, NODE_SCHEMA)


def emitted(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``flat_start``, the place of their first token in the whole stream.

    Nodes are sorted depth first: by the first conversation through them, in the
    order of the paths, then by depth.  Sums run within sorted partitions.
    """
    placed = ranked(nodes, ["owner", "depth"], "nodes", "emit_rank")
    part = placed.withColumn("_part", F.shiftright("emit_rank", 16))
    sums = part.groupBy("_part").agg(F.sum("n_tokens").alias("_sum"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_part").orderBy("emit_rank").rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    return (
        part.withColumn("_within", within)
        .join(F.broadcast(starts), "_part")
        .withColumn("flat_start", F.col("_start") + F.col("_within"))
        .drop("_part", "_start", "_within")
    )


def prefix_tree(
    rows: DataFrame,
    tokenizer_path: str,
    ranks_path: str | None = None,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """The tree's nodes, and the way of each conversation through it.

    Nodes: ``node, parent, depth, role, ids`` (little-endian unsigned 32 bit),
    ``n_tokens, learn_from, learn_to`` (the learned span within the node),
    ``owner, emit_rank, flat_start, position_start, attend``.  Position ids count from
    ``position_start``; ``attend`` lists the intervals ``[start, end)`` of the stream
    that the node's tokens see, ancestors first, the node's own last.
    Conversations: ``rank, conv_id, path`` (their nodes), in depth-first order.

    Rows are ordered by turn; rows of one turn by role, then text.  NULL text or role
    counts as empty, a NULL turn comes first, and rows without a conversation id are
    one conversation with id NULL.  A conversation must fit one task, as its hash
    does.  Other columns are not read; an empty table gives no rows.
    """
    small_batches(rows.sparkSession)
    slim = rows.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    convs = ranked(conversation_paths(slim), ["path", "conv_id"], "conversations", "rank")
    steps = convs.select("rank", "path", F.posexplode("turns").alias("depth", "t"))
    steps = steps.select(
        "rank", "depth", F.get("path", F.col("depth")).alias("node"),
        F.get("path", F.col("depth") - 1).alias("parent"), "t.role", "t.text",
    )
    nodes = steps.groupBy("node").agg(
        F.min("rank").alias("owner"), F.first("depth").alias("depth"), F.first("parent").alias("parent"),
        F.first("role").alias("role"), F.first("text").alias("text"),
    )
    nodes = stored(emitted(encoded_nodes(nodes, tokenizer_path, ranks_path)), "emitted")

    # A conversation's way runs through stretches of the stream, one for each owner on
    # it: an owner's nodes follow one another, and its own stretch comes last.
    ways = convs.select("rank", F.explode("path").alias("node")).join(
        nodes.select("node", "flat_start", "n_tokens", "owner"), "node"
    )
    ways = ways.join(nodes.select(F.col("owner").alias("rank")).distinct(), "rank", "left_semi")
    stretches = ways.groupBy("rank", "owner").agg(
        F.min("flat_start").alias("start"),
        F.max(F.col("flat_start") + F.col("n_tokens")).alias("end"),
        F.sum("n_tokens").alias("n"),
    )
    own = F.col("owner") == F.col("rank")
    above = stretches.groupBy(F.col("rank").alias("owner")).agg(
        F.array_sort(F.collect_list(F.when(~own, F.struct("start", "end")))).alias("_above"),
        F.sum(F.when(own, 0).otherwise(F.col("n"))).alias("_before"),
        F.max(F.when(own, F.col("start"))).alias("_start"),
    )
    last = F.struct(F.col("_start").alias("start"), (F.col("flat_start") + F.col("n_tokens")).alias("end"))
    nodes = nodes.join(above, "owner").withColumns(
        {
            "position_start": F.col("_before") + F.col("flat_start") - F.col("_start"),
            "attend": F.concat("_above", F.array(last)),
        }
    )
    return nodes.drop("_above", "_before", "_start"), convs.select("rank", "conv_id", "path")


def joined(intervals: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same intervals, one for each run of them that touch."""
    out: list[tuple[int, int]] = []
    for start, end in intervals:
        if out and out[-1][1] == start:
            start = out.pop()[0]
        if end > start:
            out.append((start, end))
    return out


def in_place(steps: list[dict]) -> bool:
    """Do position ids run from 0 without a gap, and does the last turn see this conversation alone and whole?"""
    at = 0
    for s in steps:
        if s["position_start"] != at:
            return False
        at += s["n_tokens"]
    own = [(s["flat_start"], s["flat_start"] + s["n_tokens"]) for s in steps]
    return joined(own) == joined([(a["start"], a["end"]) for a in steps[-1]["attend"]])


def read_back(nodes: DataFrame, convs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Each conversation decoded from the tree, parsed and summed up.

    Returns ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars, in_place``; the learned text is what stands under the learned
    spans.  ``in_place`` tells whether the position ids and the attention intervals give
    each turn its place in just this conversation.
    """
    steps = convs.select("rank", "conv_id", "path", F.posexplode("path").alias("depth", "node"))
    steps = steps.withColumn("last", F.col("depth") == F.size("path") - 1).drop("path")
    fields = ["ids", "learn_from", "learn_to", "n_tokens", "flat_start", "position_start"]
    found = steps.join(nodes.select("node", "attend", *fields), "node")
    attend = F.when(F.col("last"), F.col("attend")).alias("attend")
    ways = found.groupBy("rank", "conv_id").agg(
        F.array_sort(F.collect_list(F.struct("depth", *fields, attend))).alias("steps")
    )

    def run(batches):
        decode = pieces.load(tokenizer_path).decode_batch
        for batch in batches:
            out = []
            for conv_id, steps in zip(batch.column("conv_id").to_pylist(), batch.column("steps").to_pylist()):
                ids = [np.frombuffer(s["ids"], "<u4") for s in steps]
                learned = [i[s["learn_from"] : s["learn_to"]] for i, s in zip(ids, steps)]
                texts = decode([i.tolist() for i in ids + learned], skip_special_tokens=False)
                formatted = "".join(texts[: len(ids)])
                loss = unescape("".join(texts[len(ids) :]))
                turns = parse(formatted)
                said = "".join(f"{role}\n{text}\n" for role, text in turns)
                digests = [hashlib.sha256(t.encode()).hexdigest() for t in (said, loss)]
                out.append((conv_id, len(turns), digests[0], len(loss), digests[1], len(formatted), in_place(steps)))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_())
            columns = list(zip(*out)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "in_place"],
            )

    return ways.select("conv_id", "steps").mapInArrow(run, CONV_SCHEMA)
