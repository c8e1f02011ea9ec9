"""Ranked search against scoring every document for every query."""

import math
import random
import re
from collections import Counter

import pytest

from sharelens.llm import ranked_search as rs

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_search(docs, queries, k=10):
    bags = [(d, Counter(plain_terms(t))) for d, t in docs]
    n_docs = sum(1 for _, c in bags if c)
    n_terms = sum(sum(c.values()) for _, c in bags)
    df = Counter(t for _, c in bags for t in c)
    asked = {}
    for item, text in queries:
        asked.setdefault(item, set()).update(plain_terms(text))
    rows = []
    for item, terms in asked.items():
        scores = []
        for doc, bag in bags:
            if not bag:
                continue
            m = 10 + 90 * sum(bag.values()) * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 8 * m))
                for t in terms
                if bag[t]
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        rows += [(item, i + 1, s[3], -s[0]) for i, s in enumerate(sorted(scores)[:k])]
    return sorted(rows, key=str)


def search(spark, docs, queries, k=10, **more):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS n", "2 AS m", "'x' AS `meta.url`")
    q = spark.createDataFrame(queries, "item_id long, text string").selectExpr("*", "3 AS term", "4 AS doc_id")
    return sorted((tuple(r) for r in rs.ranked_search(d, q, k, **more).collect()), key=str)


def random_texts(n, seed, most=60):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["Ünder", "ÀB", "x9", "日本"]
    return [(i, " ".join(draw.choices(words, [1 / (j + 1) for j in range(len(words))], k=draw.randint(0, most)))) for i in range(n)]


@pytest.mark.parametrize("segment_postings", [1, 50, 400_000])
def test_equals_scoring_everything(spark, monkeypatch, segment_postings):
    monkeypatch.setattr(rs, "FIRST_VISIT", 2)
    monkeypatch.setattr(rs, "VISIT_GROWTH", 3)
    docs, queries = random_texts(150, 1), random_texts(12, 2, 9)
    assert search(spark, docs, queries, segment_postings=segment_postings) == plain_search(docs, queries)


def test_queries_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(rs, "BLOCK_PAIRS", 10)
    docs, queries = random_texts(60, 3), random_texts(9, 4, 9)
    assert search(spark, docs, queries, 3) == plain_search(docs, queries, 3)


def test_all_terms_indexed_gives_the_same(spark, monkeypatch):
    monkeypatch.setattr(rs, "MAX_CHOSEN_TERMS", 0)
    docs, queries = random_texts(60, 5), random_texts(6, 6, 9)
    assert search(spark, docs, queries) == plain_search(docs, queries)


def test_ties_nulls_repeats_and_long_texts(spark):
    long_text = " ".join(f"only{i}" for i in range(50_000)) + " rare"
    docs = [(i, "rare word here") for i in range(30, 0, -1)] + [
        (5, "rare word here"), (None, "rare word here"), (100, None), (101, ""), (102, "!! .. ??"),
        (103, long_text), (104, "RARE-rare\trare\x00Rare"), (105, "word"),
    ]
    queries = [(1, "Rare"), (1, "word!"), (2, None), (3, ""), (4, "absent terms"), (None, "here"), (5, "only7 only9")]
    assert search(spark, docs, queries) == plain_search(docs, queries)


def test_pruned_strata_are_not_opened(spark):
    docs = random_texts(200, 7)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    index = rs.build_index(frame, segment_postings=20)
    asked = rs._Asked([(0, b"w39", 5000), (0, b"w0", 10)])
    bounds = sorted(r.bound for r in rs._bound_rows(index.segments, asked).collect())
    assert bounds[0] < bounds[-1] and len(bounds) > 8


def test_empty_tables(spark):
    assert search(spark, [], [(1, "a")]) == []
    assert search(spark, [(1, "a")], []) == []


def test_terms_are_those_of_the_pattern():
    texts = ["Aß Zz_9\x7f~ Ωmega", "ÀÉ naïve x y", "İI ſS K", "".join(map(chr, range(1, 300)))]
    for text in texts:
        assert rs.terms_of(text.encode()) == [t.encode() for t in plain_terms(text)]
