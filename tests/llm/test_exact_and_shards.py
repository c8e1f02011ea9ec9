import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict

import pytest

from sharelens.llm.exact_dedup import exact_dedup
from sharelens.llm.sharding import admitted, balanced_shards, shard_documents

ODD = [
    (1, "a"), (2, "a"), (3, None), (4, ""), (5, "b" * 9000), (6, "b" * 9000), (7, "b" * 8999 + "c"),
    (8, "b" * 4000 + "x" + "b" * 4999), (9, "é\n\n"), (10, "é\n\n"), (11, "a "), (2, "a"), (None, "a"),
    (12, "🙂" * 5000), (13, "🙂" * 5000), (None, "z"), (None, "z"),
]


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), digest) for i in ids]
    return Counter(out)


def test_exact_dedup_on_odd_rows(texts_of):
    for block in (4096, 7):
        rows = exact_dedup(texts_of(ODD), block_chars=block, edge_chars=3).collect()
        assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows) == expected(ODD)
        kept = Counter(r.text_sha256 for r in rows if r.kept)
        assert set(kept.values()) == {1} and len(kept) == len({t or "" for _, t in ODD})
        assert all(r.doc_id == r.keep_id for r in rows if r.kept)


def test_exact_dedup_of_nothing(texts_of):
    assert exact_dedup(texts_of([])).collect() == []


def check_shards(rows, source, n):
    assert Counter((r.doc_id, r.text_crc32, r.size) for r in rows) == Counter(
        (i, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1) for i, t in source
    )
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    sizes = [len(slots.get(s, [])) for s in range(n)]
    assert max(sizes) - min(sizes) <= 1 and set(slots) <= set(range(n))
    assert all(r.law == "rows" and r.grown_shard is None for r in rows)


def test_shards_of_odd_rows(texts_of):
    check_shards(shard_documents(texts_of(ODD), 4).collect(), ODD, 4)
    assert shard_documents(texts_of([])).collect() == []


def test_equal_texts_share_a_shard(texts_of):
    rows = [(i, f"text {i % 40 if i < 80 else i}") for i in range(400)]
    rows += [(1000 + i, "very common") for i in range(150)]
    found = shard_documents(texts_of(rows), 16).collect()
    check_shards(found, rows, 16)
    cut = defaultdict(set)
    for r in found:
        cut[r.text_crc32].add(r.shard)
    common = zlib.crc32(b"very common")
    assert all(len(v) == 1 for k, v in cut.items() if k != common)


def test_copies_change_places_without_other_rows(spark):
    """Nobody is without links: pairs, tens and a key too large for a shard."""

    def cut(n, key_of):
        rows = spark.range(n).withColumnRenamed("id", "row")
        links = spark.createDataFrame([(i, key_of(i)) for i in range(n)], "row long, key long")
        shards = {r.row: r.shard for r in balanced_shards(rows, links, 16).collect()}
        assert Counter(shards.values()) == dict.fromkeys(range(16), n // 16)
        where = defaultdict(set)
        for i in range(n):
            where[key_of(i)].add(shards[i])
        return sum(len(v) > 1 for k, v in where.items() if k >= 0)

    assert cut(960, lambda i: i // 2) <= 15  # all 480 before
    assert cut(800, lambda i: i // 10 if i < 720 else -1) <= 8  # all 72 before


@pytest.mark.parametrize("n", [10, 11, 25, 40, 97, 160])
def test_large_keys_fill_few_shards(spark, n):
    """160 rows in 16 shards of 10: a key of n rows needs at least n / 10 shards, one more at most here."""
    rows = spark.range(160).withColumnRenamed("id", "row")
    links = spark.createDataFrame([(i * 7 % 160, "large") for i in range(n)], "row long, key string")
    shards = {r.row: r.shard for r in balanced_shards(rows, links, 16).collect()}
    assert Counter(shards.values()) == dict.fromkeys(range(16), 10)
    assert len({shards[i * 7 % 160] for i in range(n)}) == -(-n // 10)


def least_cut(groups, size):
    """The fewest cut links of groups with all rows in two shards of ``size``, by all ways."""
    n = sum(map(len, groups))
    ways = itertools.combinations(range(n), size)
    return min(sum(len(set(w) & set(g)) * (len(g) - len(set(w) & set(g))) for g in groups) for w in ways)


@pytest.mark.parametrize("sizes", [[5, 2, 1, 1, 1], [7, 1, 1, 1], [4, 3, 1, 1, 1], [3, 3, 2, 1, 1], [2, 2, 2, 2, 2]])
def test_cut_links_against_all_ways(spark, sizes):
    """Two shards of five: groups with rows without links to change places with are cut as little as can be."""
    starts = list(itertools.accumulate([0, *sizes]))
    groups = [range(a, b) for a, b in zip(starts, starts[1:])]
    rows = spark.range(10).withColumnRenamed("id", "row")
    links = spark.createDataFrame([(i, g) for g, own in enumerate(groups) for i in own], "row long, key long")
    shards = {r.row: r.shard for r in balanced_shards(rows, links, 2).collect()}
    ends = [[shards[i] for i in own] for own in groups]
    cut = sum(e.count(0) * e.count(1) for e in ends)
    if 1 in sizes:
        assert cut == least_cut(groups, 5)
    else:
        assert cut <= least_cut(groups, 5) + 1


def test_admitted_moves_keep_the_sizes():
    dice = random.Random(6)
    for _ in range(300):
        n = dice.randint(2, 8)
        wanted = {(s, t): dice.randint(1, 40) for s in range(n) for t in range(n) if s != t and dice.random() < 0.5}
        free = {s: dice.randint(0, 10) for s in range(n) if dice.random() < 0.5}
        flow = admitted(wanted, free)
        assert all(0 < m <= wanted[pair] for pair, m in flow.items())
        for s in range(n):
            come, go = (sum(m for pair, m in flow.items() if pair[side] == s) for side in (1, 0))
            assert come - go <= free.get(s, 0)
    assert admitted({(0, 1): 5, (1, 0): 3}, {}) == {(0, 1): 3, (1, 0): 3}
    assert admitted({(0, 1): 2, (1, 2): 2, (2, 0): 4}, {}) == {(0, 1): 2, (1, 2): 2, (2, 0): 2}


def test_rows_with_several_keys_keep_the_sizes(spark):
    rows = spark.range(60).withColumnRenamed("id", "row")
    pairs = [(i, i // 4) for i in range(24)] + [(i, 100 + i % 3) for i in range(12)]
    links = spark.createDataFrame(pairs, "row long, key long")
    shards = {r.row: r.shard for r in balanced_shards(rows, links, 5).collect()}
    assert Counter(shards.values()) == dict.fromkeys(range(5), 12)
    before = sum(len({i % 5 for i, k in pairs if k == key}) for key in {k for _, k in pairs})
    after = sum(len({shards[i] for i, k in pairs if k == key}) for key in {k for _, k in pairs})
    assert after < before
