from collections import defaultdict

import public_tokenizers
import pytest
from test_jaccard_join import near_copies, shingles

import corpus_pipeline
from sharelens.llm import exact_dedup, jaccard_join, toxicity
from sharelens.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_exact_duplicates_are_dropped_with_all_columns(spark, texts_of):
    rows = [(1, "a"), (2, "a"), (2, "a"), (3, None), (4, ""), (None, "b"), (5, "c"), (None, None)]
    frame = texts_of(rows)
    kept = exact_dedup.drop_exact_duplicates(frame)
    assert kept.columns == frame.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [("2", "a"), ("4", ""), ("5", "c"), ("None", "b")]
    assert exact_dedup.drop_exact_duplicates(texts_of([])).collect() == []


@pytest.mark.parametrize("few", [0, 1_000_000])
def test_one_of_each_group_stays(texts_of, monkeypatch, few):
    monkeypatch.setattr(jaccard_join, "BROADCAST_IDS", few)
    rows = near_copies(7) + [(500, ""), (501, None), (None, "one two"), (502, "One two"), (502, "one two")]
    frame = texts_of(rows)
    kept = jaccard_join.drop_near_duplicates(frame)
    assert kept.columns == frame.columns
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(frame).collect()}
    want = sorted(str(i) for i, (n, c) in found.items() if i is not None and (i == c or not n))
    assert sorted(str(r.doc_id) for r in kept.collect()) == want


def test_toxic_documents_are_dropped_with_all_columns(spark, texts_of):
    rows = [(i, f"word{i % 7} other" + (" vile" if i % 3 == 0 else "")) for i in range(200)] + [(None, None)]
    frame = texts_of(rows)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(200)], "doc_id long, toxic int")
    kept = toxicity.drop_toxic(frame, labels)
    assert kept.columns == frame.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, t in rows if "vile" not in (t or ""))


def test_columns_with_dots_and_quotes_are_kept(spark):
    rows = [(i, f"one two three four five {i % 3} six seven", "u", "v") for i in range(30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, `meta.url` string, `a``b` string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(30)], "doc_id long, toxic int")
    for kept in (
        exact_dedup.drop_exact_duplicates(frame),
        jaccard_join.drop_near_duplicates(frame),
        toxicity.drop_toxic(frame, labels),
    ):
        assert kept.columns == frame.columns
        assert {tuple(r)[2:] for r in kept.collect()} == {("u", "v")}


def test_pipeline_against_plain_steps(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    toxic = {r.doc_id for r in QUERIES["op9_toxicity"](spark, SF_DIR).collect() if r.predicted}
    last = {t: i for i, t in sorted(docs.items()) if i not in toxic}
    left = sorted((i, t) for t, i in last.items())
    sets = {i: shingles(t, corpus_pipeline.SHINGLE_WORDS) for i, t in left}
    by_token = defaultdict(list)
    for i, s in sets.items():
        for token in s:
            by_token[token].append(i)
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    pairs = {(a, b) for ids in by_token.values() for a in ids for b in ids if a < b}
    for a, b in pairs:
        common = len(sets[a] & sets[b])
        if 100 * common >= corpus_pipeline.SIMILARITY_PERCENT * (len(sets[a]) + len(sets[b]) - common):
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    want = {i for i in sets if find(i) == i}
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id for r in rows} == want and len(want) < len(docs)
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.doc_id] += r.length
    assert all(sizes[i] == len(plain.encode(docs[i], add_special_tokens=False).ids) + 1 for i in want)


def test_stages_take_empty_documents(spark):
    empty = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("doc_id < -1")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).collect() == []
