import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from sharelens.llm import pieces
from sharelens.llm.common import released
from sharelens.llm.packing import best_fit_plan, pack, token_pieces
from sharelens.llm.token_counts import read_cache, token_counts
from sharelens.llm.toxicity import FeatureFinder

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PARTS = [
    "the", "Straße", " ", "  ", "\n", "\r\n", "\t", " ", " ", "　", "\x1c", "\x85", "\x0b", "​",
    "'s", "'ll", "don't", "12", "3.5", "<|endoftext|>", "<|startoftext|>", "ΣΟΣ", "İ", "é",
    "́", "\U0001f642", "中文", "...", "-", "_", "a" * 70, "\x00", "�", " ", " ",
]


def odd_texts(n, seed):
    dice = random.Random(seed)
    texts = ["".join(dice.choices(PARTS + [" "] * 12, k=dice.randint(0, 25))) for _ in range(n)]
    return texts + ["", " ", "\n", " a", "a ", "word " * 3000, "x" * 20_000]


@pytest.fixture(scope="module")
def real_texts(documents):
    return [r.text for r in documents.limit(150).collect()]


def test_counts_equal_the_library(real_texts):
    plain = Tokenizer.from_file(WORDS)
    texts = odd_texts(4000, 1) + real_texts
    found = pieces.counter(WORDS)(texts)
    assert found == [len(plain.encode(t, add_special_tokens=False).ids) for t in texts]


def test_ids_equal_the_library(real_texts):
    plain = Tokenizer.from_file(BYTES)
    texts = odd_texts(4000, 2) + real_texts + ["x" * 1990, " " * 190, " " * 5000, "ab" * 30_000]
    for ranks in (RANKS, None):
        found = [np.frombuffer(b, "<u4").tolist() for b in pieces.id_encoder(BYTES, ranks)(texts)]
        assert found == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_the_chunk_cache_stays_small(monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_ENTRIES", 5)
    cache = pieces.ChunkCache(lambda chunks: map(len, chunks))
    for start in range(0, 60, 10):
        chunks = [["x" * 60, *(str(i) for i in range(start, start + 10))]]
        look = cache.fill(chunks)
        assert [look[c] for c in chunks[0]] == [len(c) for c in chunks[0]]
        assert len(cache.values) <= 15


ROWS = [(1, "one two"), (2, None), (3, ""), (4, "one two"), (4, "one two"), (None, "three"), (5, "a b c " * 2000)]


def test_token_counts_and_cache(spark, texts_of, tmp_path):
    plain = Tokenizer.from_file(WORDS)
    cache = f"file://{tmp_path}/cache"
    for source in (ROWS, ROWS + [(9, "four words are new")], ROWS):
        rows = token_counts(texts_of(source), WORDS, cache).collect()
        want = [
            (i, len((t or "").encode()), n := len(plain.encode(t or "", add_special_tokens=False).ids), n > 2048)
            for i, t in source
        ]
        assert sorted(map(str, (tuple(r) for r in rows))) == sorted(map(str, want))
    stored = read_cache(spark, cache).collect()
    assert len(stored) == len({r.text_digest for r in stored}) == 5
    assert token_counts(texts_of([]), WORDS, cache).collect() == []


def check_packing(rows, source, size):
    plain = Tokenizer.from_file(BYTES)
    whole = sorted(zlib.crc32(np.array(plain.encode(t or "", add_special_tokens=False).ids + [0], "<u4").tobytes())
                   for _, t in source)
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for spots in places.values():
        spots.sort()
        ends = [0, *np.cumsum([n for _, n in spots]).tolist()]
        assert [o for o, _ in spots] == ends[:-1] and ends[-1] <= size
    singles = [r.ids_crc32 for r in rows if r.piece == 0 and r.start == 0]
    assert len(singles) == len(source)
    return whole, singles, len(places)


def test_packing_of_odd_rows(texts_of):
    rows = pack(texts_of(ROWS), BYTES, RANKS).collect()
    check_packing(rows, ROWS, 2048)
    plain = Tokenizer.from_file(BYTES)
    ids = np.array(plain.encode(ROWS[-1][1], add_special_tokens=False).ids + [0], "<u4")
    long = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in rows if r.doc_id == 5)
    first = (len(ids) - 1) % 2048 + 1
    cuts = [0, *range(first, len(ids) + 1, 2048)]
    assert long == [
        (k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))
    ]
    assert pack(texts_of([]), BYTES).collect() == []


def test_packing_of_documents(documents):
    source = [(r.doc_id, r.text) for r in documents.collect()]
    rows = pack(documents, BYTES).collect()
    whole, singles, n = check_packing(rows, source, 2048)
    short = [r for r in rows if r.piece == 0]
    cut = {r.doc_id for r in rows if r.piece}
    assert sorted(r.ids_crc32 for r in short if r.doc_id not in cut) == sorted(
        c for c in whole if c in set(singles))
    assert n <= -(-sum(r.length for r in rows) // 2048) * 1.02 + 1


def test_plan_is_best_fit():
    dice = random.Random(3)
    for _ in range(30):
        histogram = {dice.randint(1, 50): dice.randint(1, 40) for _ in range(dice.randint(1, 20))}
        plan = best_fit_plan(histogram, 50)
        fill, placed = defaultdict(int), defaultdict(int)
        spots = []
        for length, first, n, per, sequence, base in plan:
            assert placed[length] == first
            placed[length] += n
            for k in range(n):
                spots.append((sequence + k // per, base + k % per * length, length))
        assert placed == histogram
        for sequence, offset, length in sorted(spots):
            assert fill[sequence] == offset
            fill[sequence] += length
        bins = []  # document by document
        for length in sorted(histogram, reverse=True):
            for _ in range(histogram[length]):
                open_bins = [b for b in bins if b >= length]
                space = min(open_bins) if open_bins else 50
                if open_bins:
                    bins.remove(space)
                bins.append(space - length)
        assert max(fill.values()) <= 50 and len(fill) == len(bins)


def test_packing_tokenises_one_text_at_a_time(monkeypatch):
    asked, runs = [], []

    def encoder(*paths):
        return lambda texts: asked.append(len(texts)) or [b"\1\0\0\0" for _ in texts]

    class Table:
        def mapInArrow(self, run, schema):
            runs.append(run)

    monkeypatch.setattr(pieces, "id_encoder", encoder)
    token_pieces(Table(), BYTES, RANKS, 4, 0)
    texts = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3], "_text": ["a", "", "b"]})
    (found,) = runs[0](iter([texts]))
    assert asked == [1, 1, 1] and found.column("length").to_pylist() == [2, 2, 2]


def test_a_task_leaves_nothing_in_its_worker():
    finder = FeatureFinder(np.zeros((29, 29, 29)))
    for batch in released([["some words"], ["more words"]], finder.forget):
        finder(batch[0])
    assert not finder.known and not finder.memo
