"""The manifest against trees built in plain Python."""

import hashlib
import zlib
from collections import defaultdict

import pytest

from sharelens.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_leaf(row, more=0):
    doc_id, source, lang, n, text = row
    n = None if n is None else n + more
    return sha(*map(field, (doc_id, source, lang, n, text)))


def levels(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        last = found[-1]
        found.append([sha(*last[i : i + 2]) for i in range(0, len(last), 2)])
    return found


def plain_manifest(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append(row)
    langs = sorted(groups, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for lang in langs:
        groups[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        trees[lang] = levels([plain_leaf(r) for r in groups[lang]])
    crown = levels([trees[lang][-1][0] for lang in langs])
    root = crown[-1][0]
    found = []
    for t, lang in enumerate(langs):
        for i, row in enumerate(groups[lang]):
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            node, siblings = plain_leaf(row, int(hit)), []
            for tree, at in ((trees[lang], i), (crown, t)):
                for height, level in enumerate(tree[:-1]):
                    place = at >> height
                    other = level[place ^ 1] if place ^ 1 < len(level) else ""
                    siblings.append(other)
                    node = sha(other, node) if place & 1 else sha(node, other)
            found.append((row[0], plain_leaf(row), trees[lang][-1][0], root, sha(*siblings), node, node == root))
    return found


def rows_of(frame):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in frame.select(*names).collect()), key=str)


def documents_in(sizes):
    rows, doc = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            rows.append((doc * 7 % 1009, f"src{doc % 3}", lang, doc % 5 or None, f"text {doc}" if doc % 4 else None))
            doc += 1
    return rows


@pytest.mark.parametrize("stride", [1, 2, 4])
def test_every_shape_of_tree(spark, stride):
    rows = documents_in({"a": 1, "b": 2, "c": 3, "d": 5, "e": 16, "f": 17, "ä": 33, None: 7, "": 4})
    docs = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(merkle.verified_manifest(docs, stride)) == sorted(plain_manifest(rows), key=str)


def test_one_language_holds_most_rows(spark):
    rows = documents_in({"x": 700, "y": 1})
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert rows_of(merkle.verified_manifest(docs)) == sorted(plain_manifest(rows), key=str)


def test_nulls_repeats_and_long_texts(spark):
    rows = [
        (None, None, None, None, None), (None, "s", None, 1, ""), (1, "s", "l", 2, "same"), (1, "s", "l", 2, "same"),
        (1, "s", "l", 2, "other"), (10, "s", "l", 2**63 - 1, "é" * 300_000), (3, "", "", 0, ""),
    ]
    found = rows_of(merkle.verified_manifest(spark.createDataFrame(rows, SCHEMA)))
    assert found == sorted(plain_manifest(rows), key=str)


def test_only_tampered_rows_fail(spark, documents):
    frame = merkle.verified_manifest(documents)
    hit = {r.doc_id for r in documents.collect() if zlib.crc32(str(r.doc_id).encode()) % 7 == 0}
    assert hit and {r.doc_id for r in frame.where("NOT verified").collect()} == hit


def test_empty_and_clashing_columns(spark):
    assert merkle.verified_manifest(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = documents_in({"a": 3, "b": 18})
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "1 AS hash", "2 AS idx", "3 AS tree", "'m' AS `meta.url`", "0 AS start", "5 AS _rank", "6 AS n"
    )
    assert rows_of(merkle.verified_manifest(docs)) == sorted(plain_manifest(rows), key=str)
