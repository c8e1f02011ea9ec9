import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sharelens.sources import jsonl, sinks

SCHEMA = "a string, b long"
LINES = [
    '{"a": "1", "b": 2}',
    "",
    "   ",
    '[{"a": "2"}, {"a": "3", "b": 5}]',
    "[]",
    "5",
    '{"a": ' + '"x' * 80,
    '  {"a": "4", "other": 1}',
]


@pytest.fixture()
def lines(tmp_path):
    path = tmp_path / "rows.jsonl"
    path.write_text("\n".join(LINES) + "\n", encoding="utf-8")
    return str(path)


def test_read_jsonl(spark, lines):
    rows = jsonl.read_jsonl(spark, lines, SCHEMA).orderBy("a").collect()
    assert [tuple(r) for r in rows] == [("1", 2), ("2", None), ("3", 5), ("4", None)]


def test_rejects_are_the_dropped_lines(spark, lines):
    found = {r.text: r.file for r in jsonl.jsonl_rejects(spark, lines, SCHEMA).collect()}
    assert set(found) == {"5", LINES[6][:100]}
    assert all(name.endswith("rows.jsonl") for name in found.values())


def test_misfits_are_reported_and_the_rest_stays(spark, tmp_path):
    path = tmp_path / "users.jsonl"
    path.write_text(
        '{"a": "1", "b": "7"}\n{"a": "2", "b": "x"}\n{"a": "3", "b": 3.5}\n{"a": 4, "b": null}\n'
        '[{"a": "5", "b": 1}, 6, {"a": "7", "b": "y"}, "z", {"a": "8"}]\n[{"a": "9"}\n'
    )
    rows = jsonl.read_jsonl(spark, str(path), SCHEMA).orderBy("a").collect()
    assert [tuple(r) for r in rows] == [
        ("1", 7), ("2", None), ("3", None), ("4", None), ("5", 1), ("7", None), ("8", None),
    ]
    lost = {(r.field, r.text) for r in jsonl.jsonl_rejects(spark, str(path), SCHEMA).collect()}
    assert lost == {("b", "x"), ("b", "3.5"), ("b", "y"), (None, "6"), (None, "z"), (None, '[{"a": "9"}')}
    (counts,) = jsonl.jsonl_reject_counts(spark, str(path), SCHEMA).collect()
    assert (counts.records, counts.fields) == (3, 3)


def test_peek(spark, tmp_path):
    for name in "pq":
        (tmp_path / name).write_text("".join(f"{name}{i}\n" for i in range(9)))
    rows = jsonl.peek(spark, str(tmp_path), 2).collect()
    assert sorted((r.line_no, r.value) for r in rows) == [(1, "p0"), (1, "q0"), (2, "p1"), (2, "q1")]


def test_repair_columns(spark):
    frame = spark.createDataFrame([(1, 2, 3, "t")], ["0", "1", "2", "3"])
    assert jsonl.repair_columns(frame, jsonl.SHARE_COLUMNS).columns == jsonl.SHARE_COLUMNS
    named = spark.createDataFrame([(1, 2)], ["x", "1"])
    assert jsonl.repair_columns(named, ["p", "q"]).columns == ["x", "1"]
    with pytest.raises(ValueError):
        jsonl.repair_columns(frame, ["only", "three", "names"])


def test_query_array(spark, tmp_path):
    path = tmp_path / "queries.json"
    rows = [{"triple_id": str(i), "inviter_id": "7", "item_id": "8", "timestamp": "2024-01-01 00:00:00"} for i in range(3)]
    path.write_text(json.dumps(rows))
    assert {r.triple_id for r in jsonl.read_query_array(spark, str(path)).collect()} == {"0", "1", "2"}
    path.write_text("[" + ",\n".join(map(json.dumps, rows)) + "]\n")
    split = jsonl.read_query_array(spark, str(path)).collect()
    assert sorted(r.triple_id for r in split) == ["0", "1", "2"] and {r.timestamp for r in split} == {"2024-01-01 00:00:00"}


def test_record_arrays_are_written_side_by_side(spark, tmp_path):
    rows = spark.range(10).selectExpr("id AS triple_id", "to_json(struct(string(id) AS triple_id)) AS value").repartition(3)
    path = tmp_path / "arrays"
    sinks.write_record_arrays(rows, "triple_id", str(path), per_file=4)
    found = sorted([int(r["triple_id"]) for r in json.loads(f.read_text())] for f in path.glob("part=*/*.txt"))
    assert found == [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9]]
    back = jsonl.read_query_array(spark, str(path))
    assert sorted(r.triple_id for r in back.collect()) == [str(i) for i in range(10)]
    sinks.write_record_arrays(rows.limit(0), "triple_id", str(tmp_path / "none"))
    assert jsonl.read_query_array(spark, str(tmp_path / "none")).count() == 0


def test_sinks_round_trip(spark, tmp_path):
    table = spark.createDataFrame([(1, 2), (3, 4)], "user_id long, n long")
    sinks.write_feature_csv(table, str(tmp_path / "t.csv"))
    back = spark.read.option("header", True).schema("user_id long, n long").csv(str(tmp_path / "t.csv"))
    assert sorted(map(tuple, back.collect())) == [(1, 2), (3, 4)]

    answers = spark.createDataFrame([(1, [5, 6]), (2, [])], "triple_id long, candidate_voter_list array<long>")
    path = str(tmp_path / "c.json")
    sinks.write_candidates_jsonl(answers, path)
    text = [json.loads(r.value) for r in spark.read.text(path).collect()]
    assert sorted(text, key=lambda r: r["triple_id"]) == [
        {"triple_id": "1", "candidate_voter_list": ["5", "6"]},
        {"triple_id": "2", "candidate_voter_list": []},
    ]
    with pytest.raises(PySparkException):
        sinks.write_candidates_jsonl(answers, path)
    sinks.write_predictions(answers, path)
    assert spark.read.json(path).count() == 2

    stats = spark.createDataFrame([(1, 0.1)], "rows long, mean double")
    sinks.write_stats_json(stats, str(tmp_path / "s.json"))
    assert json.loads(spark.read.text(str(tmp_path / "s.json")).first().value) == {"rows": 1, "mean": 0.1}


def test_bad_timestamp_is_an_error(spark):
    from sharelens.functions.columns import parse_timestamp

    good = spark.createDataFrame([("2023-01-05 10:11:12",)], ["t"])
    assert str(good.select(parse_timestamp(F.col("t")).alias("t")).first().t) == "2023-01-05 10:11:12"
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE_TIMESTAMP"):
        spark.createDataFrame([("soon",)], ["t"]).select(parse_timestamp(F.col("t"))).collect()
