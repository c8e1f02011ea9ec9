"""Toxicity of texts, scored after disguised words are restored.

A disguised word went through a noisy channel that writes look-alike signs for letters,
puts signs between them, or repeats them.  Viterbi finds the likeliest original under
a character model counted over all texts; the words of the text and of what was
restored, and how they begin, are then weighed by a linear classifier.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sharelens.llm.common import released, small_batches, stored, whole_row

TRAIN_ROWS = 20_000
MAX_FEATURES = 1_024
MIN_DOCUMENTS = 5
MIN_LIFT = 4.0
PREFIXES = (3, 4, 5, 6)
MEMO_ENTRIES = 300_000
BATCH_BYTES = 4 << 20

# Signs that stand for letters, and signs put between letters.
LOOKS_LIKE = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "ß": "b",
}
SEPARATORS = " .-_*~'/\\,:"
SIGN_COST, KEPT_SIGN_COST, GAP_COST, REPEAT_COST = 0.5, 2.0, 0.3, 0.5
EDGES = ".,;:?\"'()[]{}<>«»„“”’‘…"

SPACE, OTHER_LETTER, OTHER, CLASSES = 0, 27, 28, 29
_SPACED = re.compile(r"(?<!\S)\S(?:\s++\S){2,}(?!\S)")
_LETTERS = re.compile(r"[^\W\d_]+")
_DISGUISED = re.compile(rf"[{re.escape(''.join(LOOKS_LIKE) + SEPARATORS)}]|(.)\1", re.DOTALL)


def char_classes(text: str) -> np.ndarray:
    """a-z, other letters, white space and everything else as small numbers."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _CLASS_OF[np.minimum(points, 255)]


def _class_table() -> np.ndarray:
    table = np.full(256, OTHER, np.int64)
    for i in range(256):
        c = chr(i)
        if "a" <= c <= "z":
            table[i] = i - 96
        elif c.isspace():
            table[i] = SPACE
        elif i == 255 or c.isalpha():
            table[i] = OTHER_LETTER
    return table


_CLASS_OF = _class_table()


def trigram_counts(texts: DataFrame) -> DataFrame:
    """``trigram, n`` over the whole of all texts (``_text``), lower-cased."""

    def run(batches):
        total = np.zeros(CLASSES**3, np.int64)
        for batch in released(batches):
            for text in batch.column("_text"):
                c = char_classes(f" {text.as_py().lower()} ")
                if len(c) > 2:
                    total += np.bincount((c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:], minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["trigram", "n"])

    counts = texts.select("_text").mapInArrow(run, "trigram long, n long")
    return counts.groupBy("trigram").agg(F.sum("n").alias("n"))


def char_model(counts: DataFrame) -> np.ndarray:
    """-log P(c | a, b) as a cube, from at most ``CLASSES ** 3`` counts."""
    cube = np.zeros(CLASSES**3)
    for trigram, n in counts.collect():
        cube[trigram] = n
    cube = cube.reshape(CLASSES, CLASSES, CLASSES)
    pairs, single = cube.sum(axis=0), cube.sum(axis=(0, 1))
    third = cube / np.maximum(cube.sum(axis=2, keepdims=True), 1)
    second = pairs / np.maximum(pairs.sum(axis=1, keepdims=True), 1)
    first = single / max(single.sum(), 1)
    return -np.log(0.7 * third + 0.2 * second + 0.09 * first + 0.01 / CLASSES)


def restore(span: str, model: list) -> str:
    """The likeliest original of a lower-case span; linear in its length."""
    states = {(SPACE, SPACE): (0.0, None)}
    last = ""
    for c in span:
        code = ord(c)
        kind = int(_CLASS_OF[min(code, 255)])
        if c in LOOKS_LIKE:
            options = [(c, kind, KEPT_SIGN_COST)] + [(x, ord(x) - 96, SIGN_COST) for x in LOOKS_LIKE[c]]
        elif c in SEPARATORS or kind == SPACE:
            options = [(c, kind, 0.0), ("", None, GAP_COST)]
        else:
            options = [(c, kind, 0.0)]
        if c == last and c not in SEPARATORS:
            options.append(("", None, REPEAT_COST))
        last = c
        reached = {}
        for (a, b), (cost, back) in states.items():
            row = model[a][b]
            for out, cls, extra in options:
                if cls is None:
                    key, total, way = (a, b), cost + extra, back
                else:
                    key, total, way = (b, cls), cost + extra + row[cls], (back, out)
                if key not in reached or total < reached[key][0]:
                    reached[key] = (total, way)
        states = reached
    _, way = min(states.values(), key=lambda s: s[0])
    out = []
    while way:
        way, c = way
        out.append(c)
    return "".join(reversed(out))


def needs_restoring(token: str) -> bool:
    """Has the token a look-alike, a sign that parts letters, or anything twice running?

    The channel leaves all other tokens as they are.
    """
    return bool(_DISGUISED.search(token))


def features(words) -> set[str]:
    """The words, and their beginnings, which words of one stem have in common."""
    return set(words) | {w[:n] + "*" for w in words for n in PREFIXES if len(w) > n}


class FeatureFinder:
    """Features of texts as written and as restored, with a bounded memory of tokens."""

    def __init__(self, model: np.ndarray, only=None):
        self.model = model.tolist()
        self.only = only
        self.memo: dict[str, tuple[str, ...]] = {}
        self.known: set[str] = set()

    def forget(self) -> None:
        self.memo.clear()
        self.known.clear()

    def chosen(self, words) -> set[str]:
        return features(words) if self.only is None else features(words) & self.only

    def token_features(self, token: str) -> tuple[str, ...]:
        core = token.strip(EDGES)
        words = {core} if core.isalpha() else set(_LETTERS.findall(token))
        if needs_restoring(core):
            words.update(_LETTERS.findall(restore(core, self.model)))
        return tuple(self.chosen(words))

    def __call__(self, text: str) -> set[str]:
        """All features of the text, or those of ``only``."""
        if len(self.known) > MEMO_ENTRIES:
            self.forget()
        text = text.lower()
        tokens = set(text.split())
        for token in tokens - self.known:
            own = self.token_features(token)
            if own:
                self.memo[token] = own
        self.known |= tokens
        found = {f for token in tokens & self.memo.keys() for f in self.memo[token]}
        for span in _SPACED.finditer(text):
            spaced = " ".join(span[0].split())  # any white space parts letters alike
            found |= self.chosen(_LETTERS.findall(restore(spaced, self.model)))
        return found


def training_rows(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """``_text, toxic`` of about ``rows`` labelled documents that are not held out.

    All of them if there are fewer; else those with the smallest hashes, a bounded
    sample.  Its labels are few, so they are sent to the documents.
    """
    known = labels.where(~F.col("held_out") & F.col("toxic").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = min(1.0, rows / max(1, known.count()))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    return docs.join(F.broadcast(known.where(place < share)), "doc_id").select("_text", "toxic")


def feature_weights(rows: DataFrame, model: np.ndarray, most: int) -> tuple[dict[str, float], float]:
    """Weights of the features that tell toxic texts, and the bias.

    Features are counted by document in Spark; the ``most`` with the strongest
    association are fitted together, with a penalty that drops those with nothing to add.
    """

    def count(batches):
        find, counts = FeatureFinder(model), {}
        for batch in batches:
            for text, toxic in zip(batch.column("_text").to_pylist(), batch.column("toxic").to_pylist()):
                for feature in find(text):
                    pair = counts.setdefault(feature, [0, 0])
                    pair[1 if toxic else 0] += 1
        items = list(counts.items())
        for at in range(0, len(items), 50_000):
            some = items[at : at + 50_000]
            columns = [[f for f, _ in some], [n[0] for _, n in some], [n[1] for _, n in some]]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["feature", "clean", "toxic"])

    sizes = {r[0]: r[1] for r in rows.groupBy("toxic").count().collect()}
    n_toxic = sum(n for t, n in sizes.items() if t)
    n_clean = sum(sizes.values()) - n_toxic
    if not n_toxic or not n_clean:
        return {}, 30.0 if n_toxic else -30.0
    found = rows.mapInArrow(count, "feature string, clean long, toxic long").groupBy("feature")
    found = found.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    p, q = F.col("toxic") / n_toxic, F.col("clean") / n_clean
    found = found.where((F.col("toxic") >= MIN_DOCUMENTS) & (p >= q * MIN_LIFT))
    chi = (p - q) * (p - q) / (p / n_toxic + q / n_clean)
    chosen = [r.feature for r in found.orderBy(chi.desc(), "feature").limit(most).collect()]
    index = {f: i for i, f in enumerate(chosen)}

    def encode(batches):
        find = FeatureFinder(model, frozenset(index))
        for batch in batches:
            hits = [sorted(index[f] for f in find(t)) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(hits, pa.list_(pa.int32())), batch.column("toxic").cast(pa.int32())],
                names=["hits", "toxic"],
            )

    # A bounded sample with a bounded number of features: the fit is a small problem.
    sample = rows.mapInArrow(encode, "hits array<int>, toxic int").toArrow()
    hits = sample.column("hits").combine_chunks()
    hits = hits.chunk(0) if isinstance(hits, pa.ChunkedArray) else hits
    lengths = np.diff(hits.offsets.to_numpy())
    weights, bias = fit(hits.flatten().to_numpy(), lengths, sample.column("toxic").to_numpy(), len(chosen))
    return {f: float(weights[i]) for f, i in index.items() if weights[i]}, float(bias)


def fit(columns, lengths, labels, n_features, penalty: float = 3e-5, rounds: int = 500):
    """Logistic regression with an absolute penalty, by accelerated proximal steps."""
    n = len(lengths)
    # The bias is one more column, without penalty.
    columns = np.concatenate([columns, np.full(n, n_features)]).astype(np.int64)
    rows = np.concatenate([np.repeat(np.arange(n), lengths), np.arange(n)])
    y = (np.asarray(labels) > 0).astype(float)
    shrink = np.r_[np.full(n_features, penalty), 0.0]

    def along(w):
        return np.bincount(rows, w[columns], minlength=n)

    def across(r):
        return np.bincount(columns, r[rows], minlength=n_features + 1) / n

    v = np.ones(n_features + 1)
    for _ in range(30):
        v = across(along(v))
        size = np.linalg.norm(v)
        v /= size
    step = 1 / (0.25 * 1.05 * size)
    w = z = np.zeros(n_features + 1)
    t = 1.0
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-np.clip(along(z), -30, 30))) - y
        moved = z - step * across(error)
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * shrink, 0)
        new_t = (1 + math.sqrt(1 + 4 * t * t)) / 2
        z = new + (t - 1) / new_t * (new - w)
        w, t = new, new_t
    return w[:-1], w[-1]


def _held_out(column):
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % 5 == 0


def scorer(texts: DataFrame, labels: DataFrame, train_rows: int, max_features: int):
    """A function from a column of texts, none NULL, to their scores.

    ``texts`` (``doc_id, _text``) are what the character model and the training see.  Only
    the text goes to Python, once; the row it belongs to stays where it is.
    """
    small_batches(texts.sparkSession, BATCH_BYTES)
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    model = char_model(trigram_counts(texts))
    sample = stored(training_rows(texts, marks.withColumn("held_out", _held_out(F.col("doc_id"))), train_rows), "training")
    weights, bias = feature_weights(sample, model, max_features)

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        find = FeatureFinder(model, frozenset(weights))
        for batch in released(batches, find.forget):
            # One text after the other: a list of all would double the batch.
            margins = np.fromiter((bias + sum(weights[w] for w in find(t.as_py())) for t in batch), np.float64, len(batch))
            yield pa.array(1 / (1 + np.exp(-np.clip(margins, -30, 30))))

    return F.arrow_udf(score, "double")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("_text"))


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    train_rows: int = TRAIN_ROWS,
    max_features: int = MAX_FEATURES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every row of ``docs`` with the chance that it is toxic.

    Returns ``doc_id, held_out, score, predicted``.  Labels come from ``labels``
    (``doc_id, toxic``), at most about ``train_rows`` of them and never of held-out
    documents, those whose id's crc32, as text, divides by 5.  The character model
    counts every text.  A score sees nothing but the text.

    NULL text counts as empty; an empty text gets the score of a text without known
    features.  A NULL id counts as held out.  Labels that are NULL are not used; of several
    for one id the largest counts.  Without labels of both kinds the score is the same
    for all: near 0, or near 1 if all are toxic.  Repeated rows are rows like others;
    other columns are not read; an empty table gives no rows.
    """
    texts = _texts(docs, id_col, text_col)
    score = scorer(texts, labels, train_rows, max_features)
    scored = texts.select("doc_id", score("_text").alias("score"))
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", _held_out(F.col("doc_id")).alias("held_out"), "score", predicted)


def drop_toxic(
    docs: DataFrame,
    labels: DataFrame,
    train_rows: int = TRAIN_ROWS,
    max_features: int = MAX_FEATURES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``toxicity_scores`` does not predict toxic.

    NULL text counts as empty; repeated rows share their fate.
    """
    score = scorer(_texts(docs, id_col, text_col), labels, train_rows, max_features)
    rows = docs.select(whole_row(docs).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    return rows.where(score("_text") < 0.5).select("doc.*")
