import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from sharelens.llm import toxicity
from sharelens.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def channel(span):
    """All (output, cost) that a span can come from, one choice a character."""
    choices, last = [], ""
    for c in span:
        kind = int(toxicity.char_classes(c)[0])
        if c in toxicity.LOOKS_LIKE:
            some = [(c, kind, toxicity.KEPT_SIGN_COST)]
            some += [(x, ord(x) - 96, toxicity.SIGN_COST) for x in toxicity.LOOKS_LIKE[c]]
        elif c in toxicity.SEPARATORS:
            some = [(c, kind, 0.0), ("", None, toxicity.GAP_COST)]
        else:
            some = [(c, kind, 0.0)]
        if c == last and c not in toxicity.SEPARATORS:
            some.append(("", None, toxicity.REPEAT_COST))
        choices.append(some)
        last = c
    return itertools.product(*choices)


def test_viterbi_finds_the_cheapest_path():
    dice = random.Random(1)
    cube = np.random.default_rng(1).uniform(0.1, 5, (toxicity.CLASSES,) * 3)
    for _ in range(150):
        span = "".join(dice.choices("abi103$!. -é#", k=dice.randint(0, 7)))

        def cost(path):
            total, a, b = 0.0, 0, 0
            for _, kind, extra in path:
                total += extra
                if kind is not None:
                    total += cube[a, b, kind]
                    a, b = b, kind
            return total

        best = min(channel(span), key=cost)
        found = toxicity.restore(span, cube.tolist())
        ways = [cost(p) for p in channel(span) if "".join(o for o, _, _ in p) == found]
        assert ways and min(ways) == pytest.approx(cost(best))


def test_trigrams_of_all_texts(spark, texts_of):
    texts = ["Abc é1", "", "aaa", "\U0001f642 x"]
    frame = texts_of(list(enumerate(texts))).selectExpr("text AS _text")
    want = Counter()
    for t in texts:
        c = [int(x) for x in toxicity.char_classes(f" {t.lower()} ")]
        want.update((a * toxicity.CLASSES + b) * toxicity.CLASSES + d for a, b, d in zip(c, c[1:], c[2:]))
    assert {r.trigram: r.n for r in toxicity.trigram_counts(frame).collect()} == dict(want)


def toxic_corpus():
    dice = random.Random(3)
    syllables = ["ta", "re", "mi", "no", "lu", "sen", "der", "pol"]
    rude = ["gorblat", "snivork"]
    rows = []
    for i in range(900):
        words = ["".join(dice.choices(syllables, k=dice.randint(1, 3))) for _ in range(dice.randint(5, 30))]
        toxic = int(i % 5 == 0)
        if toxic:
            words.insert(dice.randrange(len(words)), dice.choice(rude))
        rows.append((i, " ".join(words), toxic))
    return rows


def test_disguised_words_are_caught(spark, texts_of):
    rows = toxic_corpus()
    tests = ["ta re g0rbl@t no", "mi sn1v0rk", "g o r b l a t mi", "no s.n.i.v.o.r.k", "gorrrblaaat lu", "GORBLAT!", "«snivork»"]
    clean = ["ta re mi", "", None, "room 101 t0 re", "a b c d", "mmm", "12 34", "lu " * 30_000]
    extra = [(10_000 + i, t) for i, t in enumerate(tests + clean)] + [(None, "mi"), (10_000, tests[0])]
    docs = texts_of([(i, t) for i, t, _ in rows] + extra)
    labels = spark.createDataFrame(
        [(i, y) for i, _, y in rows] + [(0, None), (None, 1), (99_999, 1)], "doc_id long, toxic int"
    )
    got = toxicity.toxicity_scores(docs, labels).collect()
    assert len(got) == len(rows) + len(extra)
    by = {r.doc_id: r for r in got}
    assert [by[10_000 + i].predicted for i in range(len(tests))] == [1] * len(tests)
    assert [by[10_000 + len(tests) + i].predicted for i in range(len(clean))] == [0] * len(clean)
    assert all(by[i].predicted == y for i, _, y in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)


def test_all_signs_doubled_and_wide_spaced_words_are_caught(spark, texts_of):
    rows = [(i, t.replace("snivork", "baglot").replace("gorblat", "sabot"), y) for i, t, y in toxic_corpus()]
    tests = [
        "ta re 8@9|07", "mi $480+ re", "ta baaglott", "ssabboot mi", "mi b  a  g  l  o  t re", "ta s\ta\tb\to\tt",
        "s\na\nb\no\nt\nta", "re b\u2003a \r\n g l\u00a0o t",
    ]
    clean = ["ta re mi", "12 34 100 $5", "a  b  c  d", "mmii ttaa", "2222", "a\n\nb\tc"]
    docs = texts_of([(i, t) for i, t, _ in rows] + [(10_000 + i, t) for i, t in enumerate(tests + clean)])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    by = {r.doc_id: r.predicted for r in toxicity.toxicity_scores(docs, labels).collect()}
    assert [by[10_000 + i] for i in range(len(tests))] == [1] * len(tests)
    assert [by[10_000 + len(tests) + i] for i in range(len(clean))] == [0] * len(clean)


def test_without_labels_or_rows(spark, texts_of):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    rows = toxicity.toxicity_scores(texts_of([(1, "a"), (2, None)]), none).collect()
    assert {r.predicted for r in rows} == {0} and len({r.score for r in rows}) == 1
    assert toxicity.toxicity_scores(texts_of([]), none).collect() == []


def test_held_out_accuracy(spark):
    scores = {r.doc_id: r for r in QUERIES["op9_toxicity"](spark, SF_DIR).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    assert len(scores) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    held = [(scores[i], y) for i, y in labels.items() if scores[i].held_out]
    assert len(held) > 50
    assert sum(r.predicted == y for r, y in held) >= 0.93 * len(held)
    assert not any(r.predicted and not y for r, y in held)
