import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sharelens.llm import jaccard_join
from sharelens.llm import shingles as shingles_of
from sharelens.llm.common import components
from sharelens.llm.jaccard_join import near_duplicates
from sharelens.llm.shingles import shingle_set

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def shingles(text, k):
    words = WORD.findall(lower(text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))}


def brute_force(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common and 100 * common >= percent * len(a | sets[j]):
                parent[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        same = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(same) if same and sets[i] else doc_id))
    return sorted(out, key=str)


def found(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def near_copies(seed, n_groups=12, n_alone=30):
    """Groups that drift by single words, and texts with one passage in common."""
    dice = random.Random(seed)
    words = [f"W{i}" if i % 7 else f"é{i}" for i in range(400)]
    passage = dice.choices(words, k=40)
    rows = []
    for _ in range(n_groups):
        text = dice.choices(words, k=dice.randint(6, 120))
        for _ in range(dice.randint(2, 12)):
            rows.append(" ".join(text))
            text = list(text)
            for _ in range(dice.randint(0, 3)):
                text[dice.randrange(len(text))] = dice.choice(words)
    for _ in range(n_alone):
        rows.append(" ".join(dice.choices(words, k=dice.randint(0, 60)) + passage))
    dice.shuffle(rows)
    return list(enumerate(rows))


ODD = [
    (100, None), (101, ""), (102, " \n\t"), (103, "One two"), (104, "one TWO"), (105, "one two three four"),
    (106, "one\x0btwo\x0cthree\rfour"), (107, "one\xa0two three four"), (107, "one two three four"),
    (None, "one two"), (None, "nobody else has this"), (108, "É two three four"), (109, "é two three four"),
]


@pytest.mark.parametrize("k,percent,seed", [(4, 85, 1), (5, 80, 2), (4, 85, 3), (3, 70, 4)])
def test_against_all_pairs(texts_of, k, percent, seed):
    rows = near_copies(seed) + ODD
    assert found(near_duplicates(texts_of(rows), k, percent)) == brute_force(rows, k, percent)


def test_any_list_of_frequent_tokens_gives_the_same_links(texts_of, monkeypatch):
    monkeypatch.setattr(jaccard_join, "FREQUENT", 4)
    monkeypatch.setattr(jaccard_join, "BATCH_FREQUENT", 1)
    monkeypatch.setattr(jaccard_join, "FILTER_BITS", 6)
    rows = near_copies(5)
    assert found(near_duplicates(texts_of(rows), 4, 85)) == brute_force(rows, 4, 85)


def test_group_bound_holds_for_every_size(spark):
    """Sizes between a group's smallest and largest can need fewer common tokens than both."""
    for percent in (68, 80, 85, 99):
        sizes = [(n, m) for n in range(3, 121) for m in range(n * percent // 100, n * 100 // percent + 1)]

        def need(n, m):
            left_out = -(-max(n, m) * percent // 100) - jaccard_join.OVERLAP
            return max(jaccard_join.OVERLAP, -(-(n + m) * percent // (100 + percent)) - left_out)

        spans = [(n, a, b) for n, a in sizes for m, b in sizes if m == n and a <= b]
        spans = [(n, a, b) for n, a, b in spans if b * 100 >= n * percent and a * percent <= n * 100][:: 1 + len(sizes) // 400]

        def links(n, a, b):
            return [m for m in range(a, b + 1) if 100 * m >= n * percent and m * percent <= n * 100]

        rows = [(n, a, b, min(need(n, m) for m in links(n, a, b))) for n, a, b in spans if links(n, a, b)]
        frame = spark.createDataFrame(rows, "n long, small long, large long, least long")
        columns = [F.col(c) for c in ("n", "small", "large")]
        at = jaccard_join.enough_for_any(F.col("least"), *columns, percent)
        below = jaccard_join.enough_for_any(F.col("least") - 1, *columns, percent)
        assert frame.where(~at | below).collect() == []


def test_link_with_a_member_between_the_sizes_of_its_group(texts_of):
    """A links with B alone (17 / 20); D and C, the smallest and largest of B's group, are too far."""
    by_hash = sorted((f"w{i}" for i in range(2000)), key=lambda w: int(shingle_set(w, 1)[0]))
    rows = []
    for case in range(12):
        a1, b1, b2, c1, *t = by_hash[case::12][:21]
        for words in ([a1, *t], [b1, b2, *t], [b1, b2, *t, c1], [b1, b2, *t[:-1]]):
            rows.append((len(rows), " ".join(words)))
    want = brute_force(rows, 1, 85)
    assert {r[2] for r in want} == set(range(0, 48, 4))
    assert found(near_duplicates(texts_of(rows), 1, 85)) == want


def line_texts():
    """Texts of their own that share one line, of which some are near copies of another."""
    dice = random.Random(11)
    line = [f"line{i}" for i in range(14)]
    rows = []
    for _ in range(90):
        own = [f"w{dice.randrange(10**6)}" for _ in range(dice.randint(12, 70))]
        rows.append(" ".join(own + line))
        if dice.random() < 0.3:
            own[dice.randrange(len(own))] = "other"
            rows.append(" ".join(own + line))
    return list(enumerate(rows + [" ".join(line), " ".join(line + ["end"])]))


@pytest.mark.parametrize("hot", [0, 3, 10**9])
@pytest.mark.parametrize("percent", [70, 85])
def test_hot_tokens_lose_no_link(texts_of, monkeypatch, hot, percent):
    monkeypatch.setattr(jaccard_join, "HOT_SETS", hot, raising=False)
    rows = line_texts() + [(1000 + i, t) for i, t in near_copies(6, 6, 12)]
    assert found(near_duplicates(texts_of(rows), 2, percent)) == brute_force(rows, 2, percent)


def test_a_common_line_alone_opens_no_group(spark):
    """300 sets share 8 tokens, of the 9 that a link needs; two of them have 4 others in common."""
    tokens = [(t, i) for i in range(300) for t in [*range(8), *[1000 + 4 * (1 if i == 2 else i) + j for j in range(4)]]]
    rows = spark.createDataFrame(tokens, "token long, set_id long").selectExpr("token", "token < 8 AS common", "set_id", "80L AS n", "set_id AS grp", "1L AS m")
    matrix = rows.selectExpr("token", "common", "set_id AS other", "1L AS others", "80L AS small", "80L AS large")
    assert [tuple(r) for r in jaccard_join.opening_pairs(rows, matrix, 85).collect()] == [(1, 2)]


def test_nothing(texts_of):
    assert near_duplicates(texts_of([])).collect() == []


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 200 + i) for i in range(20)] + [(300, 300), (400, 399)]
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    by = {}
    for r in rows:
        by.setdefault(r.component, set()).add(r.vertex)
    assert sorted(map(sorted, by.values())) == [
        list(range(31)), [100, *range(200, 220)], [399, 400],
    ]


def test_each_text_is_stored_once_a_comparison(texts_of, monkeypatch):
    kept = []
    real = jaccard_join.stored

    def stored(df, name):
        kept.extend([name] if "_text" in df.columns else [])
        return real(df, name)

    monkeypatch.setattr(jaccard_join, "stored", stored)
    rows = near_copies(1)
    assert found(near_duplicates(texts_of(rows), 4, 85)) == brute_force(rows, 4, 85)
    assert kept == ["star_sets", "opened_sets"]


def copies_of_copies(n, edits):
    """A family of ``n`` texts, each an earlier one with a few other words."""
    dice = random.Random(21)
    family = [[f"base{i}" for i in range(100)]]
    while len(family) < n:
        text = list(dice.choice(family))
        for place in dice.sample(range(100), edits):
            text[place] = f"new{len(family)}_{place}"
        family.append(text)
    return [(i, " ".join(t)) for i, t in enumerate(family)]


@pytest.mark.parametrize("edits,most", [(2, 300), (1, 3000)])
def test_a_family_too_far_apart_to_link_opens_few_groups(texts_of, monkeypatch, edits, most):
    """Two other words leave 89 of 97 shingles, 0.848; the family has 44,850 pairs."""
    met = []
    real = jaccard_join.stored

    def stored(df, name):
        out = real(df, name)
        met.extend([out.count()] if name == "met" else [])
        return out

    monkeypatch.setattr(jaccard_join, "stored", stored)
    rows = copies_of_copies(300, edits)
    assert found(near_duplicates(texts_of(rows), 4, 85)) == brute_force(rows, 4, 85)
    assert sum(met) <= most


def test_texts_shingled_together_have_their_own_sets(monkeypatch):
    monkeypatch.setattr(shingles_of, "PIECE_BYTES", 300)
    long = "x" * 100
    rows = [t for _, t in near_copies(8, 3, 5)] + [t or "" for _, t in ODD] + [
        f" {long} a b\tc {long}y\x0c", f"{long} a b c {long}", "12345678 1234567 123456789", "1234567812345678", "a", "", "A  b a\nB a b", "\x00 \x00\x00 a\x1cb",
    ]
    texts = pa.array(["before", *rows, "after"]).slice(1, len(rows))
    for k in (1, 4):
        got = [set(s.tolist()) for s in shingles_of.shingle_sets(texts, k)]
        want = [set(shingles(t, k)) for t in rows]
        names = {}
        for a, b in zip(got, want):
            assert len(a) == len(b)
            names.setdefault(frozenset(b), set()).add(frozenset(a))
        assert all(len(x) == 1 for x in names.values()) and len(set().union(*got)) == len(set().union(*want))
        assert [shingles_of.shingle_set(t, k).tolist() for t in rows] == [s.tolist() for s in shingles_of.shingle_sets(texts, k)]
    assert list(shingles_of.shingle_sets(pa.array([], pa.string()), 4)) == []


@pytest.mark.parametrize("percent", [68, 85, 100])
def test_the_quick_bound_is_no_stricter(spark, percent):
    sizes = [(n, a, b) for n in range(3, 90, 3) for a in range(3, 100, 4) for b in range(a, 110, 7)]
    frame = spark.createDataFrame(sizes, "n long, small long, large long").crossJoin(spark.range(40))
    columns = [F.col(c) for c in ("id", "n", "small", "large")]
    near = (F.col("n") * percent <= F.col("large") * 100) & (F.col("small") * percent <= F.col("n") * 100)
    exact, quick = (f(*columns, percent) for f in (jaccard_join.enough_for_any, jaccard_join.may_be_enough))
    assert frame.where(near & exact & ~quick).isEmpty()
    assert not frame.where(near & ~quick).isEmpty()
