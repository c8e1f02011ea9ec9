"""Quality scores: the risk against its formula, the prior on known mixtures, held-out labels."""

import zlib

import numpy as np
import pytest

from sharelens.llm import quality


def mixture(n, share, seed, apart=3.0):
    draw = np.random.default_rng(seed)
    good = draw.random(n) < share
    return draw.normal(np.where(good, apart, -apart)[:, None] * [1.0, 0.3], 1.0, (n, 2))


@pytest.mark.parametrize("share", [0.2, 0.5, 0.85])
def test_prior_of_a_known_mixture(share):
    prior = quality.estimate_prior(mixture(4000, 1.0, 1), mixture(4000, share, 2))
    assert abs(prior - share) < 0.06


def test_risk_never_falls_below_zero_and_separates():
    good, unlabelled = mixture(3000, 1.0, 3), mixture(3000, 0.7, 4)
    w = quality.fit_positive_unlabelled(good, unlabelled, 0.7)
    margins = quality._with_bias(mixture(2000, 1.0, 5)) @ w, quality._with_bias(mixture(2000, 0.0, 6)) @ w
    assert (margins[0] > 0).mean() > 0.97 and (margins[1] < 0).mean() > 0.97
    bad_part = np.logaddexp(0, quality._with_bias(unlabelled) @ w).mean() - 0.7 * np.logaddexp(0, quality._with_bias(good) @ w).mean()
    assert bad_part > -0.02


def test_gradient_is_that_of_the_unbiased_risk(monkeypatch):
    good, unlabelled, prior = mixture(200, 1.0, 7), mixture(200, 0.5, 8), 0.5
    seen = []
    monkeypatch.setattr(quality, "_adam", lambda gradient, width, rounds: seen.append(gradient) or np.zeros(width))
    quality.fit_positive_unlabelled(good, unlabelled, prior)

    def risk(w):
        p, u = quality._with_bias(good) @ w, quality._with_bias(unlabelled) @ w
        bad = np.logaddexp(0, u).mean() - prior * np.logaddexp(0, p).mean()
        return prior * np.logaddexp(0, -p).mean() + bad + quality.RIDGE / 2 * (w[:-1] ** 2).sum()

    w = np.array([0.1, -0.2, 0.05])
    steps = np.eye(3) * 1e-5
    numeric = [(risk(w + s) - risk(w - s)) / 2e-5 for s in steps]
    assert np.allclose(seen[0](w), numeric, atol=1e-6)


def test_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = quality.quality_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.98 and np.mean([s >= quality.THRESHOLD for s in good]) > 0.98


def test_held_out_labels_and_zero_labels_are_not_read(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    other = labels.selectExpr(
        "doc_id",
        "CASE WHEN crc32(CAST(doc_id AS STRING)) % 5 = 0 THEN 1 - quality WHEN quality = 0 THEN NULL ELSE quality END AS quality",
    )
    a = {r.doc_id: r.score for r in quality.quality_scores(documents, labels).collect()}
    b = {r.doc_id: r.score for r in quality.quality_scores(documents, other).collect()}
    assert a == b


def test_odd_rows(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    odd = spark.createDataFrame(
        [(9_000_001, None), (9_000_002, ""), (None, "x"), (9_000_003, "word " * 200_000), (9_000_003, "\u0000é\n")],
        "doc_id long, text string",
    )
    docs = documents.select("doc_id", "text").unionByName(odd).selectExpr("*", "1 AS good", "2 AS score", "3 AS `meta.url`", "4 AS _text")
    rows = quality.quality_scores(docs, labels).collect()
    assert len(rows) == documents.count() + 5
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows if r.doc_id is not None)
    scores = {r.doc_id: r.score for r in rows}
    assert scores[9_000_001] == scores[9_000_002]


def test_empty_tables(spark, documents):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.quality_scores(documents, labels).collect()} == {0.5}
    assert quality.quality_scores(documents.limit(0), labels).collect() == []


def test_a_description_sees_the_whole_text():
    a, b = b"word " * 1000, b"word " * 999 + b"%%%% "
    assert not np.array_equal(quality.describe(a), quality.describe(b))
    assert len(quality.describe(b"")) == quality.WIDTH
