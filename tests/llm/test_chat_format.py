import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from sharelens.llm import chat_format, pieces
from sharelens.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "conv_id long, turn long, role string, text string, node string, depth int, owner int"


def summary(rows):
    """Per conversation what reading back must give, from the plain rows."""
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn if turn is not None else -1, role or "", text or ""))
    out = []
    for conv, turns in by.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        size = sum(len("".join(chat_format.turn_parts(r, t))) for _, r, t in turns)
        out.append((conv, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss),
                    hashlib.sha256(loss.encode()).hexdigest(), size, True))
    return sorted(out, key=str)


def odd_rows():
    dice = random.Random(1)
    parts = [*chat_format.CONTROL, "\\", "\\\\", "<", "[", "\n", "é", "\U0001f642", "a b", "<|", "|>", "\x00"]

    def text():
        return "".join(dice.choices(parts, k=dice.randint(0, 12)))

    shared = [text() for _ in range(4)]
    rows = []
    for conv in range(60):
        for turn in range(dice.randint(1, 7)):
            role = dice.choice(["user", "assistant", "system", "a\nb", "<|im_end|>", "\\"]) if turn > 2 else "user"
            rows.append((conv, turn, role, shared[turn] if turn < 3 and conv % 3 else text()))
    rows += [(100, 0, "user", None), (100, 1, None, "x"), (101, None, "assistant", "first"), (101, 0, "user", "y")]
    rows += [(None, 0, "user", "z"), (102, 0, "user", "same"), (102, 0, "user", "same"), (103, 5, "user", "w" * 50_000)]
    return rows


@pytest.fixture(scope="module")
def tree(spark):
    rows = odd_rows()
    frame = spark.createDataFrame([(*r, "n", 1, 2) for r in rows], SCHEMA)
    nodes, convs = chat_format.prefix_tree(frame, PATH)
    return rows, nodes, convs


def test_read_back(tree):
    rows, nodes, convs = tree
    got = sorted((tuple(r) for r in chat_format.read_back(nodes, convs, PATH).collect()), key=str)
    assert got == summary(rows)


def test_shared_turns_are_emitted_once_and_depth_first(tree):
    rows, nodes, convs = tree
    nodes = sorted((r.asDict() for r in nodes.collect()), key=lambda r: r["emit_rank"])
    by = {r["node"]: r for r in nodes}
    paths = [[bytes(n) for n in r.path] for r in convs.collect()]
    prefixes = {tuple(p[:i]) for p in paths for i in range(1, len(p) + 1)}
    assert len(nodes) == len(by) == len(prefixes) < len(rows)
    stream = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in nodes])
    open_path = []
    for r in nodes:
        del open_path[r["depth"]:]
        assert (open_path[-1] if open_path else None) == r["parent"]  # depth first
        open_path.append(r["node"])
        above = [by[n] for n in open_path]
        assert r["position_start"] == sum(a["n_tokens"] for a in above[:-1])
        seen = [i for a in r["attend"] for i in range(a["start"], a["end"])]
        assert seen == [i for a in above for i in range(a["flat_start"], a["flat_start"] + a["n_tokens"])]
        own = stream[r["flat_start"] : r["flat_start"] + r["n_tokens"]]
        assert own.tobytes() == bytes(r["ids"])


def test_places_are_told():
    def step(start, position, n, *attend):
        attend = [{"start": a, "end": b} for a, b in attend] or None
        return {"flat_start": start, "position_start": position, "n_tokens": n, "attend": attend}

    assert chat_format.in_place([step(5, 0, 3), step(20, 3, 2, (5, 8), (20, 22))])
    assert chat_format.in_place([step(5, 0, 3), step(8, 3, 2, (5, 10))])
    for wrong in (
        [step(5, 0, 3), step(20, 4, 2, (5, 8), (20, 22))],
        [step(5, 1, 3, (5, 8))],
        [step(5, 0, 3), step(20, 3, 2, (5, 9), (20, 22))],
        [step(5, 0, 3), step(20, 3, 2, (20, 22))],
    ):
        assert not chat_format.in_place(wrong)


def test_wrong_places_reach_the_result(tree):
    _, nodes, convs = tree
    moved = nodes.withColumn("position_start", nodes["position_start"] + 1)
    assert {r.in_place for r in chat_format.read_back(moved, convs, PATH).collect()} == {False}


def test_escaping():
    dice = random.Random(2)
    for _ in range(3000):
        text = "".join(dice.choices([*chat_format.CONTROL, "\\", "<", "[", "x", "|>", "s>"], k=dice.randint(0, 9)))
        safe = chat_format.escape(text)
        assert chat_format.unescape(safe) == text
        assert not any(c in safe for c in chat_format.CONTROL)


def test_decoding_gives_the_text(tree):
    tokenizer = pieces.load(PATH)
    for text in [t for _, _, _, t in tree[0] if t]:
        ids = np.frombuffer(pieces.id_encoder(PATH)([chat_format.escape(text)])[0], "<u4").tolist()
        assert tokenizer.decode(ids, skip_special_tokens=False) == chat_format.escape(text)


def test_nothing(spark):
    nodes, convs = chat_format.prefix_tree(spark.createDataFrame([], SCHEMA), PATH)
    assert nodes.collect() == [] and chat_format.read_back(nodes, convs, PATH).collect() == []


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").collect()]
    text = "</s>[INST] ok [/INST]"
    rows += [(-1, 0, "user", text), (-1, 1, "assistant", text)]
    got = sorted((tuple(r) for r in QUERIES["op10_chat_format"](spark, "/root/testdata/sf0.001").collect()), key=str)
    assert got == summary(rows)
