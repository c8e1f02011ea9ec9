"""Word shingles as sorted arrays of 64-bit hashes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

PIECE_BYTES = 1 << 20
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_MURMUR, _SEED = np.uint64(0xC6A4A7935BD1E995), np.uint64(0x9747B28C)
_SHIFTS = (np.uint64(30), np.uint64(27), np.uint64(31))


class Shingles(NamedTuple):
    """The shingles of several texts side by side, with repeats.

    ``words`` are the hashes of all words.  Text ``i`` has the tokens from ``starts[i]``
    to ``ends[i]``; each has the words from its place on, ``sizes[i]`` of them.
    """

    words: np.ndarray
    tokens: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    sizes: np.ndarray


@lru_cache
def _factors(k: int) -> np.ndarray:
    """An odd number for each place in a shingle, and one for its length."""
    odd = [xxhash.xxh64_intdigest(f"place {i}") | 1 for i in range(k + 1)]
    return np.array(odd, np.uint64)


def _mixed(columns: list[np.ndarray], k: int) -> np.ndarray:
    factors = _factors(k)
    mixed = np.full(len(columns[0]), factors[k], np.uint64)
    mixed *= np.uint64(len(columns))
    for column, factor in zip(columns, factors):
        mixed += column * factor
    for shift, factor in zip(_SHIFTS, _MIX):
        mixed ^= mixed >> shift
        mixed *= factor
    mixed ^= mixed >> _SHIFTS[2]
    return mixed


def word_hashes(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """MurmurHash64A of each of the words that stand side by side in ``data``, eight bytes a step."""
    padded = np.zeros(len(data) // 8 * 8 + 16, np.uint8)
    padded[: len(data)] = data
    eights = padded.view(np.uint64)
    starts, left = ends[:-1].astype(np.int64), np.diff(ends).astype(np.int64)
    hashes = left.astype(np.uint64) * _MURMUR ^ _SEED
    open_, at, value = slice(None), starts, hashes.copy()
    while len(at):
        shift = (at & 7).astype(np.uint64) << np.uint64(3)
        eight = eights[at >> 3] >> shift
        eight |= eights[(at >> 3) + 1] << np.uint64(1) << (np.uint64(63) - shift)
        whole = left >= 8
        tail = np.where(whole, 0, left).astype(np.uint64) << np.uint64(3)
        mixed = eight * _MURMUR
        mixed ^= mixed >> np.uint64(47)
        mixed *= _MURMUR
        eight &= (np.uint64(1) << tail) - np.uint64(1)
        value ^= np.where(whole, mixed, eight)
        np.multiply(value, _MURMUR, out=value, where=whole | (tail > 0))
        hashes[open_] = value
        more = np.flatnonzero(left > 8)
        open_ = more if isinstance(open_, slice) else open_[more]
        at, left, value = at[more] + 8, left[more] - 8, value[more]
    hashes ^= hashes >> np.uint64(47)
    hashes *= _MURMUR
    hashes ^= hashes >> np.uint64(47)
    return hashes


def pieces(texts: pa.Array) -> Iterator[pa.Array]:
    """``texts`` in slices of about ``PIECE_BYTES``, each of one text at least."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + PIECE_BYTES, "right")))
        yield texts.slice(start, end - start)
        start = end


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where the first of ``texts`` starts and each ends in their bytes, and the bytes."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(1, kind), np.empty(0, np.uint8)
    offsets = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1]
    return offsets, np.frombuffer(data or b"", np.uint8)


def shingles(texts: pa.Array, k: int) -> Shingles:
    """The ``k``-word shingles of ``texts`` (no NULL), which are split and hashed together.

    A-Z are lower-cased; words stand between the characters 0x20 and 0x09-0x0D.  With
    fewer than ``k`` words the whole sequence is one shingle; without words there is none.
    """
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    bounds, found = split.offsets.to_numpy().astype(np.int64), split.flatten()
    bounds -= bounds[0]
    ends, data = _buffers(found)
    real = ends[1:] != ends[:-1]  # nothing is before or after white space at the ends of a text
    if not real.all():
        ends = ends[np.concatenate([[True], real])]
        bounds = np.concatenate([[0], np.cumsum(real)])[bounds]
    starts, counts = bounds[:-1], np.diff(bounds)
    words = word_hashes(data, ends)
    tokens = np.empty(len(words), np.uint64)
    whole = len(words) - k + 1
    if whole > 0:
        tokens[:whole] = _mixed([words[i : whole + i] for i in range(k)], k)
    for size in np.unique(counts[(counts > 0) & (counts < k)]).tolist():
        at = starts[counts == size]
        tokens[at] = _mixed([words[at + i] for i in range(size)], k)
    sizes = np.minimum(counts, k)
    ends = starts + np.where(sizes > 0, counts - sizes + 1, 0)
    return Shingles(words, tokens, starts, ends, sizes)


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct ``values``, sorted."""
    values = np.sort(values)
    keep = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=keep[1:])
    return values if keep.all() else values[keep]


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The distinct shingles of each of ``texts``, hashed and sorted."""
    for piece in pieces(texts):
        found = shingles(piece, k)
        for start, end in zip(found.starts.tolist(), found.ends.tolist()):
            yield distinct(found.tokens[start:end])


def shingle_set(text: str, k: int) -> np.ndarray:
    """The distinct shingles of ``text``, hashed and sorted."""
    whole = pa.array([text.encode("utf-8", "surrogatepass")], pa.binary())
    return next(shingle_sets(whole.cast(pa.string(), safe=False), k))


def set_id(tokens: np.ndarray) -> int:
    """A signed 64-bit name of a set."""
    digest = hashlib.blake2b(tokens.tobytes(), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)
