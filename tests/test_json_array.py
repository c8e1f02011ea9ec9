"""Arrays in any layout, read over byte ranges of a few bytes, against Python's json."""

import json
import random

import pytest
from pyspark.errors import PySparkException

from sharelens.sources import json_array, jsonl

TEXTS = ["", "a", "}", "{", '"', "\\", "[{", "]}", '\\"}', "é日", "x\ny", "tab\t", "}}{{", "\\\\", ",", "null"]


@pytest.fixture
def tiny_ranges(spark):
    """Byte ranges of ``n`` bytes, so that records reach over several."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum"]
    before = {n: spark.conf.get(n, None) for n in names}

    def cut(n):
        spark.conf.set(names[0], str(n))
        spark.conf.set(names[1], "1")
        spark.conf.set(names[2], "1")

    yield cut
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def value(draw, deep=0):
    kind = draw.randrange(6 if deep < 3 else 3)
    if kind < 2:
        return "".join(draw.choices(TEXTS, k=draw.randrange(3)))
    if kind == 2:
        return draw.choice([None, True, 1, -2.5])
    if kind == 3:
        return [value(draw, deep + 1) for _ in range(draw.randrange(3))]
    return {draw.choice(TEXTS) + str(i): value(draw, deep + 1) for i in range(draw.randrange(3))}


def records(n, seed):
    draw = random.Random(seed)
    return [{"id": i, "v": value(draw), "s": draw.choice(TEXTS)} for i in range(n)]


LAYOUTS = {
    "one line": lambda rows: json.dumps(rows),
    "raw text": lambda rows: json.dumps(rows, ensure_ascii=False),
    "tight": lambda rows: json.dumps(rows, separators=(",", ":")),
    "pretty": lambda rows: json.dumps(rows, indent=4),
    "a record a line": lambda rows: "[" + ",\n".join(map(json.dumps, rows)) + "]\n",
    "no array": lambda rows: "\n".join(map(json.dumps, rows)),
    "windows": lambda rows: json.dumps(rows, indent=1).replace("\n", "\r\n") + "\r\n",
    "several arrays": lambda rows: json.dumps(rows[: len(rows) // 2]) + "\n" + json.dumps(rows[len(rows) // 2 :]),
    "mark": lambda rows: "﻿" + json.dumps(rows),
}


def read(spark, path):
    found = json_array.array_records(spark, str(path)).collect()
    return sorted(found, key=lambda r: (r.file, r.block, r.nth))


@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("size", [7, 64])
def test_every_layout_gives_the_records_in_order(spark, tmp_path, tiny_ranges, layout, size):
    rows = records(25, 1)
    path = tmp_path / "a.json"
    path.write_text(LAYOUTS[layout](rows), newline="")
    tiny_ranges(size)
    found = read(spark, path)
    assert {r.kind for r in found} == {"record"}
    assert [json.loads(r.text) for r in found] == rows
    assert len({r.block for r in found}) > 5


def test_ranges_of_any_size(spark, tmp_path, tiny_ranges):
    rows = records(12, 2)
    path = tmp_path / "a.json"
    path.write_text(json.dumps(rows))
    for size in (1, 2, 3, 5, 11, 31, 1000):
        tiny_ranges(size)
        assert [json.loads(r.text) for r in read(spark, path)] == rows


def test_many_files(spark, tmp_path, tiny_ranges):
    expected = {}
    for i, layout in enumerate(LAYOUTS.values()):
        rows = records(i, 10 + i)
        (tmp_path / f"{i}.json").write_text(layout(rows))
        expected[f"{i}.json"] = rows
    (tmp_path / "empty.json").write_text("")
    tiny_ranges(40)
    found = {}
    for r in read(spark, tmp_path):
        found.setdefault(r.file.rsplit("/", 1)[1], []).append(json.loads(r.text))
    assert found == {k: v for k, v in expected.items() if v}


def test_bad_records_are_told_and_cost_no_others(spark, tmp_path, tiny_ranges):
    good = [{"triple_id": str(i), "inviter_id": str(i)} for i in range(6)]
    g = [json.dumps(r) for r in good]
    text = f'[{g[0]},\n7, "text",\n{g[1]},\n{{"triple_id": "open string}},\n{g[2]}, }}\n,{g[3]},\n{{"triple_id" 5}},{g[4]},null]'
    path = tmp_path / "a.json"
    path.write_text(text)
    tiny_ranges(16)
    kept = jsonl.read_query_array(spark, str(path), on_bad="drop").collect()
    lost = [r.text for r in jsonl.query_array_rejects(spark, str(path)).collect()]
    # The open string takes the record after it along, as both stand between one pair of braces.
    assert {"0", "1", "3", "4"} <= {r.triple_id for r in kept} <= {"0", "1", "2", "3", "4"}
    assert any(t.startswith('7, "text"') for t in lost) and "null" in lost and '{"triple_id" 5}' in lost
    with pytest.raises(PySparkException, match="bad record"):
        jsonl.read_query_array(spark, str(path)).collect()
    with pytest.raises(ValueError):
        jsonl.read_query_array(spark, str(path), on_bad="guess")


@pytest.mark.parametrize("size", [9, 10_000])
def test_a_file_that_was_cut_off(spark, tmp_path, tiny_ranges, size):
    rows = [{"triple_id": str(i), "item_id": "4"} for i in range(5)]
    whole = json.dumps(rows)
    path = tmp_path / "a.json"
    path.write_text(whole[: whole.rindex('"}')])  # the last record lacks its end
    tiny_ranges(size)
    kept = jsonl.read_query_array(spark, str(path), on_bad="drop").collect()
    assert sorted(r.triple_id for r in kept) == ["0", "1", "2", "3"]
    assert [r.text for r in jsonl.query_array_rejects(spark, str(path)).collect()] == ['{"triple_id": "4", "item_id": "4']
    path.write_text(whole[:-1])  # all records are whole, only the array is not
    assert jsonl.read_query_array(spark, str(path)).count() == 5


def test_fields_are_cast_and_misfits_told(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_text('[{"n": "5", "m": 1}, {"n": "x", "m": 2}, {"m": "3"}]')
    schema = "n int, m int"
    rows = [tuple(r) for r in jsonl.read_query_array(spark, str(path), schema).collect()]
    assert rows == [(5, 1), (None, 2), (None, 3)]
    assert [(r.field, r.text) for r in jsonl.query_array_rejects(spark, str(path), schema).collect()] == [("n", "x")]


def test_a_record_beyond_the_bound_is_an_error(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(json_array, "MAX_RECORD_BYTES", 50)
    reader = json_array._Range(False, 0)
    with pytest.raises(ValueError, match="over 50 bytes"):
        list(reader.add(b'{"a": "' + b"x" * 100 + b'"', True))


def test_effects_compose():
    chunks = [b'[{"a": "', b'x"', b', {"b": [{', b"", b'"', b"\n", b'{{"']
    for inside in (False, True):
        effect = json_array.Effect(inside)
        state, depth, least = inside, 10, 10
        for chunk in chunks:
            effect.add(chunk)
            state, opened, _ = json_array.walk(chunk, state)
            depth += opened - (0 if state else 1)
        assert effect.inside == state and max(10 + effect.sum, effect.floor) == depth
