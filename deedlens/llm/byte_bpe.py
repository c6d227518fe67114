"""Byte-level BPE encoding and decoding with an Aho-Corasick automaton.

A rank file gives the byte strings of a vocabulary by merge rank. Bytes map to
the 256 Latin-1 characters, so that an automaton over strings finds every
vocabulary entry in a piece of text in one pass.

A row of tokens is what the merges make of its text exactly if each token is
what the merges make of its own bytes and each two neighbours are what they
make of the two together. The encoder therefore takes the longest entry at each
position and steps back to shorter ones while it does not fit its left
neighbour; whether two entries fit is memoised. Each (position, entry) is
tried once, so the work is linear in the text.
"""

from __future__ import annotations

import base64
import functools
import re
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import Column
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from deedlens.llm.arrow import lists, raw

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Entries that a cache of a worker holds before a new text; above that it starts again.
CACHED = 400_000
#: Longer pieces and chunks are not cached.
CACHED_LENGTH = 64

# A space between two other characters always begins a match of the pattern.
_INNER_SPACE = re.compile(r"(?<=\S) (?=\S)")
_SPACES = re.compile(r"\s\s")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge(piece: bytes, ranks: dict[bytes, int], least: int = 1) -> list[bytes]:
    """Plain byte-pair merging, lowest rank first, until ``least`` parts are left. Quadratic; for entries only."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > least:
        found = [(ranks.get(a + b), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
        best = min(((r, i) for r, i in found if r is not None), default=None)
        if best is None:
            break
        i = best[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.tokens = dict(zip(ranks.values(), ranks, strict=True))
        # For each entry that merging can make: the two it is merged from (a single byte: itself twice).
        self.size = [0] * (max(ranks.values()) + 1)
        self.shorter: list[int | None] = [None] * len(self.size)
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.pairs: dict[tuple[int, int], int] = {}
        automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.size[rank] = len(token)
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            halves = [token] if len(token) == 1 else merge(token, ranks, 2)
            if len(token) == 1:
                self.left[rank] = self.right[rank] = rank
            elif len(halves) == 2 and all(ranks[h] < rank for h in halves):
                self.left[rank], self.right[rank] = (ranks[h] for h in halves)
                self.pairs[self.left[rank], self.right[rank]] = rank
            else:
                continue  # merging never makes it
            automaton.add_word(token.decode("latin-1"), rank)
        for rank in self.left:
            token = self.tokens[rank]
            prefixes = (ranks.get(token[:k]) for k in range(len(token) - 1, 0, -1))
            self.shorter[rank] = next((p for p in prefixes if p in self.left), None)
        automaton.make_automaton()
        self.automaton = automaton
        self._fit: dict[int, bool] = {}
        self._pieces: dict[str, list[int]] = {}
        self._inner: dict[str, bytes] = {}

    def _bound_caches(self) -> None:
        for cache in (self._fit, self._pieces, self._inner):
            if len(cache) > CACHED:
                cache.clear()

    def fits(self, a: int, b: int) -> bool:
        """Whether merging keeps two neighbouring entries apart; it undoes the later merge step by step."""
        key = a << 32 | b
        known = self._fit.get(key)
        if known is None:
            known = self._fit[key] = self._fits(a, b)
        return known

    def _fits(self, a: int, b: int) -> bool:
        # Merges across the border count only if they would have come before ``bound``.
        bound = 1 << 62
        while True:
            across = self.pairs.get((a, b))
            if across is not None and across < bound:
                return False
            if a > b:
                bound, whole = a, a
                a = self.right[a]
                if a == whole:
                    bound, whole = b + 1, b
                    b = self.left[b]
                    if b == whole:
                        return True
            else:
                bound, whole = b + 1, b
                b = self.left[b]
                if b == whole:
                    bound, whole = a, a
                    a = self.right[a]
                    if a == whole:
                        return True

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        text = piece.decode("latin-1")
        # Longest entries one after the other; often they fit at once.
        found = [match[1] for match in self.automaton.iter_long(text)]
        known = self._fit.get
        last = found[0]
        for token in found[1:]:
            if known(last << 32 | token) is not True and not self.fits(last, token):
                return self._step_back(text)
            last = token
        return found

    def _step_back(self, text: str) -> list[int]:
        size, shorter, fits, known = self.size, self.shorter, self.fits, self._fit.get
        longest: list = [None] * len(text)
        for end, token in self.automaton.iter(text):
            longest[end - size[token] + 1] = token  # a later match from the same start is longer
        open_at = bytearray(b"\x01") * (len(text) + 1)
        found: list[int] = []
        at, token = 0, longest[0]
        while True:
            end = at + size[token]
            if open_at[end]:
                fit = not found or known(found[-1] << 32 | token)
                if fit is None:
                    fit = fits(found[-1], token)
                if fit:
                    found.append(token)
                    at = end
                    if at == len(text):
                        return found
                    token = longest[at]
                    continue
            token = shorter[token]
            if token is None:
                open_at[at] = 0
                token = found.pop()
                at -= size[token]

    def _chunk(self, chunk: str) -> bytes:
        ids: list[int] = []
        pieces = self._pieces
        for piece in self.pattern.findall(chunk):
            known = pieces.get(piece)
            if known is None:
                known = self.encode_piece(piece.encode())
                if len(piece) <= CACHED_LENGTH:
                    pieces[piece] = known
            ids += known
        return array("i", ids).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a text as native 32-bit integers.

        The text is cut at single spaces between other characters, where the
        pattern always begins a match, and what such a chunk becomes is cached.
        """
        self._bound_caches()
        if _SPACES.search(text) or text.startswith(" ") or text.endswith(" "):
            chunks = _INNER_SPACE.split(text)
        else:
            chunks = text.split(" ")
        parts, inner = [], self._inner
        for chunk in chunks[1:]:
            known = inner.get(chunk)
            if known is None:
                known = self._chunk(" " + chunk)
                if len(chunk) <= CACHED_LENGTH:
                    inner[chunk] = known
            parts.append(known)
        return self._chunk(chunks[0]) + b"".join(parts)

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@functools.cache
def entries(path: str) -> dict[int, bytes]:
    """The bytes of each id; all that decoding needs."""
    return {rank: token for token, rank in read_ranks(path).items()}


@functools.cache
def codec(path: str) -> Codec:
    """The codec of a rank file, built once in each worker."""
    return Codec(read_ranks(path))


def _ids(column: pa.Array, path: str) -> pa.ListArray:
    encoder = codec(path)
    found = [encoder.encode(value.decode()) for value in raw(column)]
    lengths = [len(f) // 4 for f in found]
    return lists(np.frombuffer(b"".join(found), np.int32), lengths, pa.int32())


def _bytes(column: pa.ListArray, path: str) -> pa.Array:
    token = entries(path).__getitem__
    flat, ends = column.values.to_numpy(), column.offsets.to_pylist()
    spans = zip(ends, ends[1:], strict=False)
    return pa.array([b"".join(map(token, flat[s:e].tolist())) for s, e in spans], pa.binary())


def encode(text: Column, path: str | None = None) -> Column:
    """Array of the ids of a text; NULL and empty texts give an empty array.

    ``path`` is a rank file that every machine has; the default belongs to the
    installed tokenizer package. The whole text is encoded, each match of the
    pattern separately, without special tokens.
    """
    path = path or public_tokenizers.path(RANKS)

    @arrow_udf(ArrayType(IntegerType()))
    def ids(column: pa.Array) -> pa.Array:
        return _ids(column, path)

    return ids(text)


def decode(ids: Column, path: str | None = None) -> Column:
    """The bytes that an array of ids stands for; NULL gives no bytes. An id outside the vocabulary is an error."""
    path = path or public_tokenizers.path(RANKS)

    @arrow_udf(BinaryType())
    def text(column: pa.Array) -> pa.Array:
        return _bytes(column, path)

    return text(ids)


def round_trip(text: Column, path: str | None = None) -> Column:
    """Both in one pass: a struct of ``ids``, as from ``encode``, and ``decoded``, the bytes that ``decode`` makes of them."""
    path = path or public_tokenizers.path(RANKS)
    kind = StructType([StructField("ids", ArrayType(IntegerType())), StructField("decoded", BinaryType())])

    @arrow_udf(kind)
    def both(column: pa.Array) -> pa.Array:
        ids = _ids(column, path)
        return pa.StructArray.from_arrays([ids, _bytes(ids, path)], ["ids", "decoded"])

    return both(text)
