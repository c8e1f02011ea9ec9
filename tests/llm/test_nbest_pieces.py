import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from sharelens.llm.nbest_pieces import (
    LITERAL, SCORE_UNIT, SPACE, PieceLattice, flat, joins, load_model, n_best_pieces, piece_counts, piece_scores, split_units
)
from sharelens.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["the cat", "a", " ", "  x", "x  y ", "naïve", "\U0001f642a", "▁b", "a▁ b", "\n\t", "of the", "中文 x", "aaaa bb"]


@pytest.fixture(scope="module")
def scores(documents):
    return piece_scores(piece_counts(documents, PATH), PATH)


@pytest.fixture(scope="module")
def pieces(scores):
    return PieceLattice(PATH, 5, scores)


def everything(pieces, marked):
    """All segmentations of a whole marked text, over spaces too."""
    done = {0: [(0, ())]}
    for end in range(1, len(marked) + 1):
        done[end] = []
        for start in range(end):
            part = marked[start:end]
            if part in pieces.pieces:
                own = [(pieces.pieces[part][0],)], pieces.pieces[part][1]
            elif len(part) == 1:
                raw = (SPACE if part == LITERAL else part).encode()
                own = [tuple(pieces.id_of_byte[b] for b in raw)], pieces.byte_score * len(raw)
            else:
                continue
            done[end] += [(s + own[1], ids + own[0][0]) for s, ids in done[start]]
    return sorted(done[len(marked)], key=lambda x: -x[0])


def test_against_all_segmentations(pieces):
    dice = random.Random(1)
    texts = TEXTS + ["".join(dice.choices("theanr  ▁é", k=dice.randint(1, 9))) for _ in range(60)]
    for text in texts:
        marked = SPACE + text.replace(SPACE, LITERAL).replace(" ", SPACE)
        want = everything(pieces, marked)
        found = pieces.encode(text)
        assert [s for s, _ in found] == [s for s, _ in want[:5]]
        ways = {ids: s for s, ids in want}
        own = [tuple(np.frombuffer(raw, "<u4").tolist()) for _, raw in found]
        assert len(set(own)) == len(own)
        assert [ways[ids] for ids in own] == [s for s, _ in found]
        assert all(pieces.decode(ids) == " " + text for ids in own)


def test_units_make_up_the_text():
    for text in TEXTS:
        units = split_units(text)
        assert "".join(units) == SPACE + text.replace(SPACE, LITERAL).replace(" ", SPACE)
        assert all(SPACE not in u.lstrip(SPACE) for u in units)


def test_rows(texts_of):
    rows = [(1, "the cat"), (1, "the cat"), (None, None), (2, ""), (3, "x" * 3000), (4, "word " * 20_000)]
    got = n_best_pieces(texts_of(rows), PATH, 3).collect()
    assert len(got) == len(rows) and all(r.round_trip for r in got)
    by = {r.doc_id: r for r in got}
    assert (by[2].n_pieces, by[2].score, by[2].scores) == (0, 0.0, [0.0])
    assert by[None].ids_crc32 == zlib.crc32(b"")
    assert all(r.scores == sorted(r.scores, reverse=True) and r.scores[0] == r.score for r in got)
    assert n_best_pieces(texts_of([]), PATH).collect() == []


def test_scores_are_shares_of_the_librarys_pieces(texts_of, documents, scores):
    model = load_model(PATH)
    texts = [r.text for r in documents.select("text").collect() if r.text]
    seen = np.bincount(np.array(flat(map(tuple, model.encode(texts)))), minlength=model.get_piece_size())
    share = (seen + 0.5) / (seen + 0.5).sum()
    assert np.abs(scores - SCORE_UNIT * np.log(share)).max() <= 0.5 + 1e-6
    assert piece_counts(texts_of([(1, None), (2, "")]), PATH).collect() == []


def test_query(spark, pieces, documents):
    got = {r.doc_id: r for r in QUERIES["op7_sentencepiece_nbest"](spark, "/root/testdata/sf0.001").collect()}
    assert all(r.round_trip for r in got.values()) and len(got) == documents.count()
    for row in documents.limit(20).collect():
        found = pieces.encode(row.text)
        assert got[row.doc_id].scores == [s / SCORE_UNIT for s, _ in found][:4]
        own = np.array(pieces.model.encode(row.text), "<u4").tobytes()
        assert got[row.doc_id].like_library == (found[0][1] == own)


def test_units_at_once_equal_one_by_one(pieces, documents):
    dice = random.Random(2)
    texts = TEXTS + [r.text for r in documents.limit(40).collect() if r.text]
    texts += ["".join(dice.choices("theanr  é\n.,中\U0001f642\x01", k=dice.randint(1, 40))) for _ in range(200)]
    units = sorted({u for t in texts for u in split_units(t) if joins(u)})
    assert pieces.entries(units) == [pieces.entry(u) for u in units]


def test_a_unit_is_segmented_once(scores, monkeypatch):
    asked = []
    lattice = PieceLattice(PATH, 3, scores)
    own = lattice.entries
    monkeypatch.setattr(lattice, "entries", lambda units: asked.extend(units) or own(units))
    for _ in range(3):
        lattice.encode("the cat and the dog and the cat")
    assert sorted(asked) == [SPACE + w for w in ("and", "cat", "dog", "the")]


def test_units_in_a_row_are_encoded_like_their_text(scores, documents):
    lattice = PieceLattice(PATH, 3, scores)
    for text in [t for t in TEXTS if SPACE not in t] + [r.text for r in documents.limit(40).collect() if r.text]:
        units = split_units(text)
        found, _, like = lattice.encoded(units, lattice.look_up(set(units)))
        assert like == (found[0][1] == np.array(lattice.model.encode(text), "<u4").tobytes())


def test_a_part_is_segmented_once(scores, monkeypatch):
    asked = []
    lattice = PieceLattice(PATH, 3, scores)
    own = lattice.entries
    monkeypatch.setattr(lattice, "entries", lambda units: asked.extend(units) or own(units))
    for text in ('the cat, the "cat".', "the\ncat the, cat"):
        lattice.encode(text)
    assert sorted(asked) == sorted([SPACE + "the", SPACE + "cat", "cat", ",", "\n", SPACE + '"', '".'])


def test_units_are_put_together_from_their_parts(scores, documents):
    dice = random.Random(3)
    lattice = PieceLattice(PATH, 3, scores)
    texts = TEXTS + [r.text for r in documents.limit(30).collect() if r.text]
    texts += ["".join(dice.choices("theanr  é\n.,)\"'0中▁\U0001f642\x01", k=dice.randint(1, 70))) for _ in range(300)]
    units = sorted({u for t in texts for u in split_units(t)})
    table = lattice.look_up(units)
    for unit in units:
        score, raw, loss, good, like = lattice.entry(unit)
        row = np.array([table.row[unit]])
        assert (table.score[row], table.loss[row], table.good[row], table.like[row]) == (score, loss, good, like)
        assert table.ids_of(row)[0].tobytes() == raw


def test_counts_of_odd_texts_are_the_librarys(texts_of):
    dice = random.Random(4)
    texts = TEXTS + ["".join(dice.choices("theanr   é\n.,)\"'0中▁\U0001f642", k=dice.randint(1, 70))) for _ in range(300)]
    want = np.bincount(np.array(flat(map(tuple, load_model(PATH).encode(texts)))))
    got = {r.piece: r.n for r in piece_counts(texts_of(list(enumerate(texts))), PATH).collect()}
    assert got == {i: n for i, n in enumerate(want.tolist()) if n}
