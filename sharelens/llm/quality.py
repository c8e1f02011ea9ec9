"""Text quality learned from trusted good texts and unlabelled ones.

No text is labelled bad: a classifier minimises the non-negative unbiased risk, in which
the loss of the bad class is that of the unlabelled texts less the share that good
ones have in them.  That share, the class prior, is estimated from how the scores of a
good-against-unlabelled classifier lie in both samples.
"""

from __future__ import annotations

import operator
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sharelens.llm.common import small_batches, stored

TRAIN_ROWS = 8_000  # of trusted texts, and as many unlabelled ones
THRESHOLD = 0.3
ROUNDS, RATE, RIDGE = 400, 0.05, 1e-3
CLIP = 4.0
CONFIDENCE = 0.1

# Byte classes: lower, upper, digit, blank, line end, one for each ASCII sign, UTF-8 parts, control.
_SIGNS = [c for c in range(33, 127) if not chr(c).isalnum()]
LOWER, UPPER, DIGIT, BLANK, LINE, HIGH, CONTROL = range(7)
CLASSES = 7 + len(_SIGNS)


def _class_table() -> np.ndarray:
    table = np.full(256, CONTROL, np.int64)
    table[97:123], table[65:91], table[48:58], table[128:] = LOWER, UPPER, DIGIT, HIGH
    table[[9, 32]], table[10] = BLANK, LINE
    table[_SIGNS] = 7 + np.arange(len(_SIGNS))
    return table


_CLASS = _class_table()
_SIGN = 7  # all signs as one class in pairs
PAIRS = 8
WIDTH = CLASSES + PAIRS * PAIRS + 12


def _share(part: float, whole: float) -> float:
    return part / whole if whole else 0.0


def describe(text: bytes) -> np.ndarray:
    """What a whole UTF-8 text looks like, as numbers of like size whatever its length.

    Root shares of the byte classes and of their pairs; lengths of words and lines; how
    many of either are different; words said twice running; how well the text compresses.
    """
    kinds = _CLASS[np.frombuffer(text, np.uint8)]
    size = max(len(kinds), 1)
    single = np.bincount(kinds, minlength=CLASSES) / size
    coarse = np.minimum(kinds, _SIGN)
    pairs = np.bincount(coarse[:-1] * PAIRS + coarse[1:], minlength=PAIRS * PAIRS) / size
    words, lines = text.split(), [line for line in text.split(b"\n") if line.strip()]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    different, rows = set(words), set(lines)
    rest = [
        np.log1p(len(words)) / 10,
        np.log1p(len(lines)) / 10,
        np.log1p(lengths.mean() if len(words) else 0.0),
        np.log1p(lengths.std() if len(words) else 0.0),
        _share(int((lengths > 20).sum()), len(words)) ** 0.5,
        _share(int((lengths == 1).sum()), len(words)) ** 0.5,
        _share(len(different), len(words) ** 0.8),
        _share(len(rows), len(lines)),
        _share(sum(map(len, rows)), sum(map(len, lines))),
        _share(len(lines), len(words)) ** 0.5,
        _share(sum(map(operator.eq, words, words[1:])), len(words)) ** 0.5,
        _share(len(zlib.compress(text, 1)), len(text)),
    ]
    return np.concatenate([np.sqrt(single), np.sqrt(pairs), rest]).astype(np.float32)


def described(texts: list[bytes]) -> np.ndarray:
    return np.stack([describe(t) for t in texts]) if texts else np.zeros((0, WIDTH), np.float32)


class Scale:
    """Columns to mean 0 and deviation 1 over a sample; columns that hardly vary count for nothing."""

    def __init__(self, x: np.ndarray):
        self.mean, self.spread = x.mean(axis=0), x.std(axis=0)
        self.spread[self.spread < 1e-6] = np.inf

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.spread, -CLIP, CLIP)


def _chance(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def _adam(gradient, width: int, rounds: int) -> np.ndarray:
    w, first, second = np.zeros(width), np.zeros(width), np.zeros(width)
    for t in range(1, rounds + 1):
        g = gradient(w)
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        w = w - RATE * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return w


def _with_bias(x: np.ndarray) -> np.ndarray:
    return np.hstack([x, np.ones((len(x), 1))])


def fit_positive_unlabelled(good: np.ndarray, unlabelled: np.ndarray, prior: float, rounds: int = ROUNDS) -> np.ndarray:
    """Weights and bias with the least non-negative unbiased risk under logistic loss.

    The risk is ``prior * E_good[l(g)] + max(0, E_unlabelled[l(-g)] - prior * E_good[l(-g)])``.
    Where the second part falls below 0, which no true risk can, a step undoes it.
    """
    p, u = _with_bias(good), _with_bias(unlabelled)

    def gradient(w):
        on_good, on_any = p @ w, u @ w
        bad_part = np.logaddexp(0, on_any).mean() - prior * np.logaddexp(0, on_good).mean()
        bad = u.T @ _chance(on_any) / len(u) - prior * (p.T @ _chance(on_good)) / len(p)
        if bad_part < 0:
            return -bad
        return prior * (p.T @ (_chance(on_good) - 1)) / len(p) + bad + RIDGE * np.r_[w[:-1], 0.0]

    return _adam(gradient, p.shape[1], rounds)


def estimate_prior(good: np.ndarray, unlabelled: np.ndarray, rounds: int = ROUNDS) -> float:
    """The share of good texts among unlabelled ones.

    Half of each sample fits a classifier of one against the other; on the other half, the
    share of unlabelled texts above a score over that of good ones is never below the
    prior, and near it where only good ones are.  The score is taken whose upper
    confidence bound of that ratio is least.
    """
    train, check = good[::2], good[1::2]
    seen, other = unlabelled[::2], unlabelled[1::2]
    if not len(check) or not len(other):
        return 0.5
    p, u = _with_bias(train), _with_bias(seen)

    def gradient(w):
        g = p.T @ (_chance(p @ w) - 1) / len(p) + u.T @ _chance(u @ w) / len(u)
        return g / 2 + RIDGE * np.r_[w[:-1], 0.0]

    w = _adam(gradient, p.shape[1], rounds)
    high, any_high = np.sort(_with_bias(check) @ w), np.sort(_with_bias(other) @ w)
    cuts = np.concatenate([high, any_high])
    q = 1 - np.searchsorted(high, cuts) / len(high)
    r = 1 - np.searchsorted(any_high, cuts) / len(any_high)
    slack = sum(np.sqrt(np.log(4 / CONFIDENCE) / (2 * n)) for n in (len(high), len(any_high)))
    usable = q > 0
    best = np.argmin((r[usable] + slack) / q[usable])
    return float(np.clip((r[usable] / q[usable])[best], 0.01, 0.99))


def _held_out(column):
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % 5 == 0


def _sample(rows: DataFrame, n: int, seed: int) -> DataFrame:
    """About ``n`` of the rows, or all if there are fewer; by hash, so that it repeats."""
    share = min(1.0, n / max(1, rows.count()))
    place = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    return rows.where(place < share)


def training_matrices(texts: DataFrame, labels: DataFrame, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Descriptions of about ``rows`` trusted texts and as many unlabelled ones.

    Trusted are texts of labelled quality 1 that are not held out.  The unlabelled ones
    are drawn from all texts that are not held out, without a look at labels.
    """
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
    trusted = marks.where(~_held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("quality").alias("_q")).where("_q = 1")
    trusted = _sample(trusted, rows, 1).select("doc_id")
    free = texts.where(~_held_out(F.col("doc_id")))
    drawn = _sample(free.select("doc_id").distinct(), rows, 2)
    kinds = stored(
        trusted.withColumn("good", F.lit(True)).unionByName(drawn.withColumn("good", F.lit(False))), "drawn"
    )

    def run(batches):
        for batch in batches:
            x = described([t.as_py() for t in batch.column("_text").cast(pa.binary())])
            flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel(), pa.float32()), WIDTH).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([flat, batch.column("good"), batch.column("doc_id")], names=["x", "good", "doc_id"])

    # The drawn ids are bounded by `rows`, twice, and so is what comes back.
    found = texts.join(F.broadcast(kinds), "doc_id").select("_text", "good", "doc_id")
    table = found.mapInArrow(run, "x array<float>, good boolean, doc_id long").toArrow().sort_by("doc_id")
    x = table.column("x").combine_chunks()
    x = x.chunk(0) if isinstance(x, pa.ChunkedArray) else x
    x = x.flatten().to_numpy().reshape(-1, WIDTH).astype(np.float64)
    good = table.column("good").to_numpy().astype(bool)
    return x[good], x[~good]


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    train_rows: int = TRAIN_ROWS,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every row of ``docs`` with the chance that its text is good.

    Returns ``doc_id, held_out, score, predicted``.  Of ``labels`` (``doc_id, quality``) only
    rows of quality 1 are read, at most about ``train_rows`` of them and none held out;
    held out are ids whose crc32, as text, divides by 5.  As many unlabelled texts are
    drawn.  A score sees nothing but the whole text.

    NULL text counts as empty; empty texts get a score like any other.  A NULL id counts as
    held out.  Of several labels for one id the largest counts.  Without trusted or
    without unlabelled texts the score is 0.5 for all.  Repeated rows are rows like
    others; other columns are not read; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("_text"))
    good, unlabelled = training_matrices(texts, labels, train_rows)
    scale = weights = None
    if len(good) and len(unlabelled):
        scale = Scale(unlabelled)
        good, unlabelled = scale(good), scale(unlabelled)
        weights = fit_positive_unlabelled(good, unlabelled, estimate_prior(good, unlabelled))

    def run(batches):
        for batch in batches:
            scores = np.full(batch.num_rows, 0.5)
            if weights is not None and batch.num_rows:
                x = described([t.as_py() for t in batch.column("_text").cast(pa.binary())])
                scores = _chance(_with_bias(scale(x)) @ weights)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])

    scored = texts.mapInArrow(run, "doc_id long, score double")
    predicted = (F.col("score") >= threshold).cast("int").alias("predicted")
    return scored.select("doc_id", _held_out(F.col("doc_id")).alias("held_out"), "score", predicted)
