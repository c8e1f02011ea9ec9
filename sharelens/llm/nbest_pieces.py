"""N-best segmentations into SentencePiece pieces, and the way back to text.

A piece's score is its log-probability among the pieces that the library's own encoding
of the table holds.  A forward Viterbi pass over the lattice of pieces gives the best
score of every prefix.  A backward A* search takes those as its heuristic, which is
exact, so complete segmentations come out best first.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import accumulate, chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sharelens.llm import pieces
from sharelens.llm.common import released, small_batches

N_BEST = 4
CACHE_ENTRIES = 400_000
CACHED_CHARS = 48
UNITS_AT_ONCE = 4_000
BATCH_BYTES = 4 << 20
SPACE = "▁"
LITERAL = "\ud800"  # stands for a literal U+2581; no valid text holds it
UNKNOWN_PENALTY = 10_000_000
SCORE_UNIT = 1_000_000  # scores are whole millionths, so sums and ties are exact
_loaded: dict = {}
RESULT_SCHEMA = """n_pieces long, score double, ids_crc32 long, scores array<double>,
    all_crc32 array<long>, round_trip boolean, like_library boolean"""


def load_model(path: str):
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path)


class PieceLattice:
    """The pieces of a model file with scores by id, and a bounded cache of segmented units.

    Scores are whole numbers and add up.  A character without a piece is written as byte
    pieces, at ``UNKNOWN_PENALTY`` below the lowest score each.
    """

    def __init__(self, path: str, n_best: int, scores):
        self.model = model = unit_encoder(path).model
        size = model.get_piece_size()
        self.n_best = n_best
        self.text_of = [model.id_to_piece(i) for i in range(size)]
        self.byte_of = {i: int(self.text_of[i][3:5], 16) for i in range(size) if model.is_byte(i)}
        self.id_of_byte = {b: i for i, b in self.byte_of.items()}
        plain = [
            i for i in range(size)
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        ]
        self.pieces = {self.text_of[i]: (i, int(scores[i])) for i in plain}
        if any(SPACE in p.lstrip(SPACE) for p in self.pieces):
            raise ValueError("a piece reaches over a space: units can't be parted")
        self.byte_score = min(s for _, s in self.pieces.values()) - UNKNOWN_PENALTY
        # Beginnings of pieces that are no pieces themselves: the search goes on past them.
        self.known = {p[:i]: None for p in self.pieces for i in range(1, len(p))} | self.pieces
        self.forget()
        self.lay_out(path, scores)

    def forget(self) -> None:
        """Drop what has been segmented."""
        self.parts, self.units = Segmented(), Segmented()
        self.choices: dict[str, tuple[list, float]] = {}

    def lay_out(self, path: str, scores) -> None:
        """The same pieces as arrays: a trie whose steps are sorted, and each piece's bytes."""
        self.scores = np.array(scores, np.int64)
        self.bytes_of = piece_bytes(self.model)
        self.library = unit_encoder(path)
        nodes = {"": 0} | {p: i + 1 for i, p in enumerate(self.known)}
        steps = sorted((nodes[p[:-1]] << 21 | ord(p[-1]), i, self.known[p]) for p, i in nodes.items() if p)
        self.steps = np.array([s for s, _, _ in steps], np.int64)
        self.step_node = np.array([i for _, i, _ in steps], np.int64)
        self.step_piece = np.array([-1 if found is None else found[0] for _, _, found in steps], np.int64)

    def all_edges(self, points: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``start, length, piece`` of all pieces in joined units, in any order; -1 for byte pieces.

        ``points``: code points; ``left``: how many characters of its unit each has from itself on.
        """
        place, node, out = np.arange(len(points)), np.zeros(len(points), np.int64), []
        single, length = np.zeros(len(points), bool), 0
        while len(place):
            step = node << 21 | points[place + length]
            at = np.searchsorted(self.steps, step)
            at[at == len(self.steps)] = 0
            hit = self.steps[at] == step
            place, at, length = place[hit], at[hit], length + 1
            piece = self.step_piece[at]
            full = piece >= 0
            out.append((place[full], np.full(int(full.sum()), length), piece[full]))
            if length == 1:
                single[place[full]] = True
            more = left[place] > length
            place, node = place[more], self.step_node[at[more]]
        bare = np.flatnonzero(~single)
        out.append((bare, np.ones(len(bare), np.int64), np.full(len(bare), -1)))
        return tuple(map(np.concatenate, zip(*out)))

    def entries(self, units: list[str]) -> list[tuple]:
        """``entry`` of many units that ``joins`` holds for: the same steps for all of them at once."""
        text = "".join(units)
        points = code_points(text)
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        unit_of = np.repeat(np.arange(len(units)), sizes)
        first = np.cumsum(sizes) - sizes
        local = np.arange(len(points)) - first[unit_of]
        start, length, piece = self.all_edges(points, sizes[unit_of] - local)
        # By their places in their units; a narrow kind of number sorts fast.
        step = local[start].astype(np.uint16)
        order = np.argsort(step, kind="stable")
        start, length, piece, step = start[order], length[order], piece[order], step[order]
        unit = unit_of[start]
        bare = piece < 0
        # A character without a piece takes as many byte pieces as it has bytes.
        n_bytes = utf8_sizes(points)
        wide = n_bytes[start]
        score = np.where(bare, self.byte_score * wide, self.scores[piece])
        # A unit has a place more than characters: its end.
        a = start + unit
        b = a + length
        cuts = [0, *(np.flatnonzero(np.diff(step)) + 1).tolist(), len(step)]
        groups = [slice(x, y) for x, y in zip(cuts, cuts[1:])]
        least = np.iinfo(np.int64).min // 4
        best, last = np.full(len(points) + len(units), least), np.zeros(len(points) + len(units), np.int64)
        best[first + np.arange(len(units))] = 0
        for some in groups:
            total, to = best[a[some]] + score[some], b[some]
            better = np.flatnonzero(total > best[to])
            best[to[better]], last[to[better]] = total[better], better + some.start
        ends = first + sizes + np.arange(len(units))
        after = np.full(len(best), least)
        after[ends] = 0
        for some in reversed(groups):
            np.maximum.at(after, a[some], score[some] + after[b[some]])
        on_way, place, begins = np.zeros(len(start), bool), ends, ends - sizes
        while len(place):
            edge = last[place]
            on_way[edge] = True
            more = a[edge] > begins
            place, begins = a[edge][more], begins[more]
        second = np.full(len(units), least)
        off = ~on_way
        np.maximum.at(second, unit[off], (best[a] + score + after[b])[off])
        # The ids of the ways, in the order of the text.
        way = np.flatnonzero(on_way)
        way = way[np.argsort(start[way])]
        n = np.where(bare[way], wide[way], 1)
        ids = np.repeat(piece[way], n)
        at = np.cumsum(n) - n
        for i in np.flatnonzero(bare[way]).tolist():
            raw = text[start[way[i]]].encode("utf-8", "surrogatepass")
            ids[at[i] : at[i] + len(raw)] = [self.id_of_byte[x] for x in raw]
        n_ids = np.bincount(unit[way], n, len(units)).astype(np.int64)
        n_bytes[points == ord(SPACE)] = 1
        sizes = np.add.reduceat(n_bytes, first)
        good = self.decodes(ids, n_ids, units, sizes)
        own, n_own = self.library.encode(units, sizes)
        like = n_ids == n_own
        same = ids[np.repeat(like, n_ids)] == own[np.repeat(like, n_own)]
        like[np.repeat(np.arange(len(units))[like], n_ids[like])[~same]] = False
        tops = best[ends]
        losses = [float("inf") if s == least else t - s for t, s in zip(tops.tolist(), second.tolist())]
        raw, stops = ids.astype("<u4").tobytes(), (4 * np.cumsum(n_ids)).tolist()
        parts = [raw[a:b] for a, b in zip([0, *stops], stops)]
        return list(zip(tops.tolist(), parts, losses, good, like.tolist()))

    def decodes(self, ids: np.ndarray, n_ids: np.ndarray, units: list[str], sizes: np.ndarray) -> list[bool]:
        """Whether each unit's ids decode to the unit: all bytes are the same, and each unit's number (``sizes``)."""
        stops = np.r_[0, np.cumsum(self.library.size_of[ids])]
        ends = np.cumsum(n_ids)
        texts = map(self.bytes_of.__getitem__, ids.tolist())
        want = "".join(units).replace(SPACE, " ").encode("utf-8", "surrogatepass")
        if (stops[ends] - stops[ends - n_ids] == sizes).all() and b"".join(texts) == want:
            return [True] * len(units)
        return [self.decode(ids[e - n : e].tolist()) == u.replace(SPACE, " ") for u, e, n in zip(units, ends, n_ids)]

    def look_up(self, units: Iterable[str]) -> Segmented:
        """A table that holds the ``entry`` of every one of ``units``; long ones are not kept.

        A unit is put together from its parts (``UnitEncoder.cut``); a part is segmented once.
        """
        if len(self.units.row) > CACHE_ENTRIES:
            self.units = Segmented()
        if len(self.parts.row) > CACHE_ENTRIES:
            self.parts = Segmented()
        missing = [u for u in units if u not in self.units.row]
        short = [u for u in missing if len(u) <= CACHED_CHARS and joins(u)]
        if short:
            parts, number, firsts = self.library.cut(short)
            new = [p for p in parts if p not in self.parts.row]
            found = [self.entries(new[at : at + UNITS_AT_ONCE]) for at in range(0, len(new), UNITS_AT_ONCE)]
            self.parts.add(new, *columns(list(chain.from_iterable(found))))
            self.units.add(short, *self.parts.joined(looked_up(self.parts.row, parts, len(parts))[number], firsts))
        others = list(set(missing).difference(short)) if len(short) < len(missing) else []
        return self.units.with_more(others, *columns(list(map(self.entry, others)))) if others else self.units

    def edges(self, unit: str) -> list[tuple]:
        """``(start, end, id or ids, score)`` of all pieces in a unit, by start."""
        known, size, out = self.known, len(unit), []
        for start in range(size):
            single = False
            for end in range(start + 1, size + 1):
                found = known.get(unit[start:end], 0)
                if found == 0:
                    break
                if found is not None:
                    out.append((start, end, *found))
                    single = single or end == start + 1
            if not single:
                c = unit[start]
                raw = (SPACE if c == LITERAL else c).encode("utf-8", "surrogatepass")
                out.append((start, start + 1, tuple(self.id_of_byte[b] for b in raw), self.byte_score * len(raw)))
        return out

    @staticmethod
    def forward(edges: list[tuple], size: int) -> tuple[list, list]:
        """The best score of every prefix, and the last edge of it."""
        best, last = [0] + [None] * size, [None] * (size + 1)
        for edge in edges:
            start, end, _, score = edge
            total = best[start] + score
            if best[end] is None or total > best[end]:
                best[end], last[end] = total, edge
        return best, last

    def best_way(self, last: list, size: int) -> list[tuple]:
        way, place = [], size
        while place:
            way.append(last[place])
            place = last[place][0]
        return way[::-1]

    def entry(self, unit: str) -> tuple:
        """``(score, ids as bytes, loss of the second best, does it decode to the unit, is it the library's)``."""
        size, edges = len(unit), self.edges(unit)
        best, last = self.forward(edges, size)
        way = self.best_way(last, size)
        # The second best leaves the best way by some edge; the best way through an
        # edge is the best prefix before it and the best suffix after it.
        on_way = set(way)
        after: list = [None] * size + [0]
        second = None
        for edge in reversed(edges):
            start, end, _, score = edge
            rest = score + after[end]
            if after[start] is None or rest > after[start]:
                after[start] = rest
            if (second is None or best[start] + rest > second) and edge not in on_way:
                second = best[start] + rest
        ids = flat(e[2] for e in way)
        loss = float("inf") if second is None else best[size] - second
        good = self.decode(ids) == unit.replace(SPACE, " ").replace(LITERAL, SPACE)
        raw = np.array(ids, "<u4").tobytes()
        return best[size], raw, loss, good, raw == self.library.alone(unit)

    def segment(self, unit: str, limit: float = math.inf) -> list[tuple[int, bytes]]:
        """The ``n_best`` best segmentations of a unit, best first: backward A*.

        Those that score more than ``limit`` below the best may be left out.
        """
        known, reached = self.choices.get(unit, (None, -1))
        if reached >= limit:
            return known
        n, size, edges = self.n_best, len(unit), self.edges(unit)
        best, last = self.forward(edges, size)
        into: list[list] = [[] for _ in range(size + 1)]
        for edge in edges:
            into[edge[1]].append(edge)
        found, ticket, least = [], 0, best[size] - limit
        queue = [(-best[size], 0, size, 0, None)]
        kept: list[list[int]] = [[] for _ in range(size + 1)]
        while queue and len(found) < n:
            _, _, place, suffix, way = heapq.heappop(queue)
            if place == 0:
                parts = []
                while way:
                    part, way = way
                    parts.append(part)
                found.append((suffix, np.array(flat(parts), "<u4").tobytes()))
                continue
            for start, _, ids, score in into[place]:
                total = suffix + score
                if total + best[start] < least:
                    continue
                # Of the ways from a place only the n best can be among the n best of all.
                near = kept[start]
                if len(near) < n:
                    heapq.heappush(near, total)
                elif total > near[0]:
                    heapq.heapreplace(near, total)
                else:
                    continue
                ticket += 1
                heapq.heappush(queue, (-(total + best[start]), ticket, start, total, (ids, way)))
        first = (best[size], np.array(flat(e[2] for e in self.best_way(last, size)), "<u4").tobytes())
        found = ([first] + [f for f in found if f != first])[:n]
        if size <= CACHED_CHARS:
            if len(self.choices) >= CACHE_ENTRIES // 10:
                self.choices.clear()
            self.choices[unit] = found, limit
        return found

    def encode(self, text: str) -> list[tuple[int, bytes]]:
        """The ``n_best`` best segmentations of a text: scores, and ids as bytes."""
        units = split_units(text)
        return self.encoded(units, self.look_up(set(units)))[0]

    def encoded(self, units: list[str], table: Segmented) -> tuple[list[tuple[int, bytes]], bool, bool]:
        """``encode`` of a text's units, whether the best decodes to the text, and whether it is the library's."""
        found, good, like = next(self.in_a_row(units, np.arange(len(units)), [len(units)], table))
        return [(score, b"".join(runs)) for score, runs in found], good, like

    def encoded_all(self, texts: list[str]) -> Iterator[tuple[list[tuple[int, list]], bool, bool]]:
        """``encoded`` of many texts, in their order; the ids of a segmentation come as runs of bytes."""
        place: dict[str, int] = numbers()
        number, sizes = unit_numbers(texts, place)
        return self.in_a_row(list(place), number, sizes, self.look_up(place))

    def in_a_row(self, units: list[str], number: np.ndarray, sizes: list[int], table: Segmented) -> Iterator:
        """``encoded_all`` of texts with ``sizes`` units each; ``number`` tells which of ``units``, text by text.

        No piece reaches over a space, so the units between spaces are independent:
        the best texts take the best unit everywhere but at a few places.
        """
        stops = [0, *accumulate(sizes)]
        row = looked_up(table.row, units, len(units))[number]
        ids, id_stops = table.ids_of(row)
        raw = memoryview(ids.tobytes())
        bests, losses = table.score[row], table.loss[row]
        sums, bad, unlike = (np.r_[0, np.cumsum(x)][stops] for x in (bests, ~table.good[row], ~table.like[row]))
        n = self.n_best
        for a, b, score, good, like in zip(
            stops, stops[1:], np.diff(sums).tolist(), (np.diff(bad) == 0).tolist(), (np.diff(unlike) == 0).tolist()
        ):
            # Places that can change: the n - 1 cheapest, first ones first.
            places = first_smallest(losses[a:b], n - 1)
            # With their second bests there are n ways; what costs more than the dearest is not among the n best.
            limit = float(losses[a + places[-1]]) if places and len(places) == n - 1 else math.inf
            options = {place: self.segment(units[number[a + place]], limit) for place in places}
            choices = [(0, ())]
            for place in places:
                best = int(bests[a + place])
                merged = [
                    (c + best - s, way + ((place, k),) if k else way)
                    for c, way in choices for k, (s, _) in enumerate(options[place])
                ]
                choices = heapq.nsmallest(n, merged)
            span = {place: (4 * int(id_stops[a + place]), 4 * int(id_stops[a + place + 1])) for place in places}
            begin, end = 4 * int(id_stops[a]), 4 * int(id_stops[b])
            out = []
            for loss, way in choices:
                runs, at = [], begin
                for place, k in sorted(way):
                    runs += [raw[at : span[place][0]], options[place][k][1]]
                    at = span[place][1]
                out.append((score - loss, [*runs, raw[at:end]]))
            yield out, good, like

    def decode(self, ids) -> str:
        """The text of a list of ids, with the space put in front when encoding."""
        out = bytearray()
        for i in ids:
            if i in self.byte_of:
                out.append(self.byte_of[i])
            else:
                out += self.text_of[i].replace(SPACE, " ").encode()
        return out.decode("utf-8", "surrogatepass")


def flat(parts) -> list[int]:
    """Ids in one list; the bytes of a character come as a tuple."""
    ids: list[int] = []
    for part in parts:
        if isinstance(part, tuple):
            ids += part
        else:
            ids.append(part)
    return ids


def first_smallest(values: np.ndarray, n: int) -> list[int]:
    """The places of the ``n`` smallest values, smallest first, of equal ones the first."""
    if n <= 0:
        return []
    if n < len(values):
        near = np.flatnonzero(values <= np.partition(values, n - 1)[n - 1])
    else:
        near = np.arange(len(values))
    return near[np.argsort(values[near], kind="stable")][:n].tolist()


def split_units(text: str) -> list[str]:
    """The marked text, cut before each space that follows something else; none of an empty text."""
    if not text:
        return []
    if text[0] != " " and text[-1] != " " and "  " not in text:
        return [SPACE + word for word in text.replace(SPACE, LITERAL).split(" ")]
    marked = SPACE + text.replace(SPACE, LITERAL).replace(" ", SPACE)
    first, *rest = marked.split(SPACE)[1:]
    units, spaces = [], SPACE + first
    for word in rest:
        if spaces[-1] == SPACE:
            spaces += SPACE + word
        else:
            units.append(spaces)
            spaces = SPACE + word
    units.append(spaces)
    return units


def library_ids(model, texts: list[str]) -> list[list[int]]:
    """The library's own encodings; it takes no lone surrogates, so those become U+FFFD."""
    return model.encode([t.encode("utf-8", "replace").decode() for t in texts], num_threads=1)


def utf8_sizes(points: np.ndarray) -> np.ndarray:
    return 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)


def piece_bytes(model) -> list[bytes]:
    """What each piece decodes to."""
    texts = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    return [
        bytes([int(t[3:5], 16)]) if model.is_byte(i) else t.replace(SPACE, " ").encode() for i, t in enumerate(texts)
    ]


class UnitEncoder:
    """The library's encoding of units and their parts, many in one call.

    Merges never reach over a space, so the encodings of a text's units in a row are the
    text's.  That does not hold for a literal U+2581, which the library takes for a space.
    Nor do they reach over two characters that stand side by side in no piece.
    """

    def __init__(self, model):
        self.model = model
        self.size_of = np.array(list(map(len, piece_bytes(model))), np.int64)
        texts = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i))]
        pairs = {pair for t in texts for pair in zip(t, t[1:])}
        self.pairs = np.array(sorted(ord(a) << 21 | ord(b) for a, b in pairs), np.int64)
        # What stands between parts joins none of them.
        joining = set(chain.from_iterable(pairs))
        self.mark = next(c for c in "\n" + "".join(map(chr, range(1, 32))) if c not in joining)

    def cut(self, units: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The distinct parts of units, the numbers of all their parts in a row, and where each unit's begin.

        No piece reaches over two parts: the segmentations of a unit are those of its parts in a row.
        """
        place: dict[str, int] = numbers()
        number, begin, n = [], [], 0
        for at in range(0, len(units), UNITS_AT_ONCE):
            some = units[at : at + UNITS_AT_ONCE]
            text = "".join(some)
            points = code_points(text)
            pair = points[:-1] << 21 | points[1:]
            near = np.searchsorted(self.pairs, pair)
            near[near == len(self.pairs)] = 0
            cuts = np.r_[True, self.pairs[near] != pair]
            firsts = [0, *accumulate(map(len, some[:-1]))]
            cuts[firsts] = True
            starts = np.flatnonzero(cuts)
            ends = [*starts.tolist(), len(text)]
            number.append(looked_up(place, [text[a:b] for a, b in zip(ends, ends[1:])], len(starts)))
            begin.append(n + np.searchsorted(starts, firsts))
            n += len(starts)
        return list(place), np.concatenate(number), np.concatenate(begin)

    def alone(self, unit: str) -> bytes:
        if unit == SPACE:  # the library puts a space in front of what is not empty alone
            return np.array([self.model.piece_to_id(SPACE)], "<u4").tobytes()
        text = unit[1:].replace(SPACE, " ").replace(LITERAL, SPACE)
        return np.array(library_ids(self.model, [text])[0], "<u4").tobytes()

    def encode(self, parts: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of parts, or of units that ``joins`` holds for, and how many each has.

        ``sizes``: the bytes of each as it decodes.
        """
        text = self.mark + self.mark.join(parts).replace(SPACE, " ")
        ids = np.array(library_ids(self.model, [text])[0], np.int64)
        # The library puts a space in front; then each part has a mark before it.
        ends, want = np.cumsum(self.size_of[ids]), np.cumsum(sizes + 1) + 1
        stops = np.searchsorted(ends, want)
        marks = np.r_[0, stops[:-1]] + 1
        if not ((ends[stops] == want).all() and (self.size_of[ids[marks]] == 1).all()):
            raise ValueError("the library's pieces reach over a space")
        own = np.ones(len(ids), bool)
        own[0] = own[marks] = False
        return ids[own], stops - marks


class Segmented:
    """Strings with what ``PieceLattice.entry`` says of them, in columns; the ids of all in one array."""

    def __init__(self):
        self.row: dict[str, int] = {}
        self.score, self.loss = np.empty(0, np.int64), np.empty(0)
        self.good, self.like = np.empty(0, bool), np.empty(0, bool)
        self.ids, self.stops = np.empty(0, "<u4"), np.zeros(1, np.int64)

    def add(self, texts: list[str], score, loss, good, like, ids, n) -> None:
        """New strings with their columns; ``n``: how many of ``ids`` each has."""
        self.row.update(zip(texts, range(len(self.score), len(self.score) + len(texts))))
        self.score, self.loss = np.r_[self.score, score], np.r_[self.loss, loss]
        self.good, self.like = np.r_[self.good, good], np.r_[self.like, like]
        self.stops = np.r_[self.stops, len(self.ids) + np.cumsum(n)]
        self.ids = np.concatenate([self.ids, ids])

    def with_more(self, texts: list[str], *found) -> Segmented:
        """A table with more strings; this one stays as it is."""
        both, n = Segmented(), len(self.row)
        vars(both).update(vars(self))
        both.row = {}
        both.add(texts, *found)
        both.row = pieces.Both(self.row, dict(zip(texts, range(n, n + len(texts)))))
        return both

    def ids_of(self, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of rows one after the other, and where each row's end, with a 0 in front."""
        n = self.stops[row + 1] - self.stops[row]
        stops = np.r_[0, np.cumsum(n)]
        return self.ids[np.repeat(self.stops[row] - stops[:-1], n) + np.arange(stops[-1])], stops

    def joined(self, row: np.ndarray, firsts: np.ndarray) -> tuple:
        """The columns of strings made up of rows in a row; ``firsts``: where each string's begin."""
        ids, stops = self.ids_of(row)
        return (
            np.add.reduceat(self.score[row], firsts),
            np.minimum.reduceat(self.loss[row], firsts),
            np.logical_and.reduceat(self.good[row], firsts),
            np.logical_and.reduceat(self.like[row], firsts),
            ids,
            np.diff(np.r_[stops[firsts], stops[-1]]),
        )


def columns(entries: list[tuple]) -> tuple:
    """What ``Segmented`` holds of ``PieceLattice.entry`` of some strings."""
    scores, raws, losses, goods, likes = zip(*entries) if entries else [()] * 5
    return (
        np.array(scores, np.int64), np.array(losses, np.float64), np.array(goods, bool), np.array(likes, bool),
        np.frombuffer(b"".join(raws), "<u4"), np.array(list(map(len, raws)), np.int64) // 4,
    )


def numbers() -> dict:
    """A dictionary that numbers what is looked up in it, from 0."""
    return defaultdict(count().__next__)


def unit_numbers(texts: list[str], place: dict[str, int]) -> tuple[np.ndarray, list[int]]:
    """The numbers that ``place`` has for the units of texts, and how many each text has.

    Only one text's units are there at a time.
    """
    sizes: list[int] = []

    def split(text: str) -> list[str]:
        units = split_units(text)
        sizes.append(len(units))
        return units

    return looked_up(place, chain.from_iterable(map(split, texts)), -1), sizes


def looked_up(table: dict, keys: Iterable, n: int) -> np.ndarray:
    """The numbers that a dictionary has for ``n`` keys; -1: for all."""
    return np.fromiter(map(table.__getitem__, keys), np.int64, n)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)


def unit_encoder(path: str) -> UnitEncoder:
    """The encoder of a model file, once a worker process."""
    if path not in _loaded:
        _loaded[path] = UnitEncoder(load_model(path))
    return _loaded[path]


def piece_lattice(path: str, n_best: int, scores: np.ndarray) -> PieceLattice:
    """The lattice of a model file; a worker process keeps the last one of a file between tasks."""
    key = ("lattice", path)
    known = _loaded.get(key)
    if known is None or known.n_best != n_best or not np.array_equal(known.scores, scores):
        known = _loaded[key] = PieceLattice(path, n_best, scores)
    return known


def joins(unit: str) -> bool:
    """May the library encode the unit in a row with others?  One that ends in a space is encoded alone."""
    return unit[-1] != SPACE and LITERAL not in unit


def piece_counts(docs: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """``piece, n``: how often the library's encoding of all texts holds each piece.

    NULL and empty texts hold none.  At most a row for each piece of the model.
    """
    small_batches(docs.sparkSession, BATCH_BYTES)

    def run(batches):
        library = unit_encoder(model_path)
        model = library.model
        found = np.zeros(model.get_piece_size(), np.int64)
        units: Counter[str] = Counter()

        def add_up() -> None:
            for unit in [u for u in units if u[-1] == SPACE]:
                np.add.at(found, np.frombuffer(library.alone(unit), "<u4"), units.pop(unit))
            distinct, times = list(units), list(units.values())
            for at in range(0, len(distinct), UNITS_AT_ONCE):
                some = distinct[at : at + UNITS_AT_ONCE]
                points = code_points("".join(some))
                sizes = np.where(points == ord(SPACE), 1, utf8_sizes(points))
                firsts = [0, *accumulate(map(len, some[:-1]))]
                ids, n = library.encode(some, np.add.reduceat(sizes, firsts))
                np.add.at(found, ids, np.repeat(times[at : at + UNITS_AT_ONCE], n))
            units.clear()

        # Each unit of a task is encoded once; texts with a literal U+2581 as wholes.
        for batch in released(batches):
            for text in batch.column(0):
                text = text.as_py()
                if SPACE in text:
                    np.add.at(found, np.array(library_ids(model, [text])[0], np.int64), 1)
                else:
                    units.update(split_units(text))
            if len(units) > CACHE_ENTRIES:
                add_up()
        add_up()
        seen = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(found[seen])], names=["piece", "n"])

    texts = docs.select(F.col(text_col).alias("_text")).dropna()
    return texts.mapInArrow(run, "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n"))


def piece_scores(counts: DataFrame, model_path: str) -> np.ndarray:
    """Log-probability by piece id in whole millionths, half a count added to each piece."""
    seen = counts.toArrow()  # bounded by the pieces of the model
    n = np.full(load_model(model_path).get_piece_size(), 0.5)
    n[seen.column("piece").to_numpy()] += seen.column("n").to_numpy()
    return np.array([round(SCORE_UNIT * math.log(x)) for x in n / n.sum()], np.int64)


def n_best_pieces(
    docs: DataFrame,
    model_path: str,
    n_best: int = N_BEST,
    id_col: str = "doc_id",
    text_col: str = "text",
    scores: np.ndarray | None = None,
) -> DataFrame:
    """Every row of ``docs`` with its ``n_best`` best segmentations.

    Returns ``doc_id, n_pieces, score, ids_crc32`` of the best, ``scores, all_crc32`` of
    all, best first, ``round_trip``: whether the best decodes to the text, and
    ``like_library``: whether it is the library's own encoding.  A crc32 is over the ids
    as little-endian unsigned 32 bits.  A space is put in front of a text that is not
    empty; white space is kept, and a literal U+2581 becomes bytes.  Pieces score by
    ``scores``, if None by their counts in the library's encoding of all of ``docs``.

    NULL text counts as empty: no pieces, score 0.  Segmentations with equal scores come
    in the order of the search, which depends on text and scores alone.  A text of any
    length is segmented whole.  Repeated rows and NULL ids are rows like others; other
    columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark, BATCH_BYTES)
    if scores is None:
        scores = piece_scores(piece_counts(docs, model_path, text_col), model_path)
    shared = spark.sparkContext.broadcast(scores)

    def run(batches):
        lattice = piece_lattice(model_path, n_best, shared.value)
        for batch in released(batches, lattice.forget):
            rows = []
            texts = batch.column("_text").to_pylist()
            for text, (found, good, like) in zip(texts, lattice.encoded_all(texts)):
                crcs = [reduce(lambda crc, run: zlib.crc32(run, crc), runs, 0) for _, runs in found]
                all_scores = [s / SCORE_UNIT for s, _ in found]
                best = b"".join(found[0][1])
                if SPACE in text:
                    like = best == np.array(library_ids(lattice.model, [text])[0], "<u4").tobytes()
                rows.append((len(best) // 4, all_scores[0], crcs[0], all_scores, crcs, good, like))
            kinds = (
                pa.int64(), pa.float64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.bool_(), pa.bool_()
            )
            found_columns = [pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 7, kinds)]
            names = ["n_pieces", "score", "ids_crc32", "scores", "all_crc32", "round_trip", "like_library"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *found_columns], names=["doc_id", *names])

    slim = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(run, f"doc_id {kind}, {RESULT_SCHEMA}")
