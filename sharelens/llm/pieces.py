"""Tokenizers inside tasks.

A tokenizer that drops white space never lets a word reach over a space, so a text
has as many tokens as its chunks between spaces, and a chunk seen before needs no
second encoding.  Byte-level ids come from ``tokenizers``, or faster and equal from
``tiktoken`` over the same vocabulary.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable

import numpy as np

CACHE_ENTRIES = 400_000
CACHED_CHARS = 48
# Runs that backtracking or merging would take long over.
_LONG_RUN = re.compile(r"\S{2000}|\s{200}")

_loaded: dict = {}


def load(path: str):
    """The tokenizer of a .json file, once a worker process."""
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _loaded[path] = tokenizer
    return _loaded[path]


def file_digest(path: str) -> str:
    """What tells one version of a tokenizer from another."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


class ChunkCache:
    """Chunk -> value, filled through one batch call for all chunks not yet known."""

    def __init__(self, encode_all):
        self.encode_all = encode_all
        self.values: dict = {}

    def fill(self, split: list[list[str]]) -> dict:
        """A lookup that holds every chunk of ``split``."""
        if len(self.values) > CACHE_ENTRIES:
            self.values.clear()
        known = self.values
        missing = set().union(*split).difference(known)
        if missing:
            missing = list(missing)
            found = dict(zip(missing, self.encode_all(missing)))
            known.update((k, v) for k, v in found.items() if len(k) <= CACHED_CHARS)
            if any(len(k) > CACHED_CHARS for k in found):
                return Both(known, found)
        return known


class Both(dict):
    """Lookups in the first mapping, then in the second."""

    def __init__(self, first, second):
        super().__init__(second)
        self.first = first

    def __missing__(self, key):
        return self.first[key]


def space_chunks(text: str) -> list[str]:
    """For a tokenizer that drops white space: what stands between spaces."""
    return text.replace("\n", " ").split(" ")


def counter(path: str):
    """texts -> token counts, for the tokenizer that drops white space."""
    key = ("count", path)
    if key not in _loaded:
        tokenizer = load(path)

        def encode_all(chunks: list[str]) -> Iterable[int]:
            return map(len, tokenizer.encode_batch_fast(chunks, add_special_tokens=False))

        _loaded[key] = ChunkCache(encode_all)
    cache = _loaded[key]

    def count(texts: list[str]) -> list[int]:
        split = [space_chunks(t) for t in texts]
        look = cache.fill(split).__getitem__
        return [sum(map(look, chunks)) for chunks in split]

    return count


def id_encoder(path: str, ranks_path: str | None = None):
    """texts -> their ids as little-endian unsigned 32-bit bytes, as the .json file gives them.

    With ``ranks_path``, the same vocabulary as ranks, ``tiktoken`` encodes all texts but
    those with a special string or a very long run, which the library itself encodes.
    """
    key = ("ids", path, ranks_path)
    if key not in _loaded:
        tokenizer = load(path)
        special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        plain = ranks_encoder(ranks_path) if ranks_path else None

        def encode_one(text: str) -> bytes:
            if plain and not _LONG_RUN.search(text) and not any(s in text for s in special):
                return np.array(plain.encode_ordinary(text), dtype="<u4").tobytes()
            return np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

        _loaded[key] = encode_one
    encode_one = _loaded[key]
    return lambda texts: [encode_one(t) for t in texts]


def ranks_encoder(path: str):
    """The encoder of a file of base64 tokens and their ranks."""
    import base64

    import public_tokenizers
    from tiktoken import Encoding

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def text_groups(texts: list[str], limit: int = 4_000_000):
    """Consecutive texts of about ``limit`` characters together; a longer one alone."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)
