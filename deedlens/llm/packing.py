"""Packing by power-of-two decomposition.

A document of L tokens is cut into pieces whose lengths are powers of two: as
many of the longest length as fit, then the binary digits of the rest. A piece
is a sequence of its own, so no sequence crosses documents and none is padded,
and sequences of equal length form a bucket from which batches are taken.
"""

from __future__ import annotations

import functools
import itertools
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import BinaryType
from pyspark.sql.window import Window
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

from deedlens.llm.arrow import small_batches, texts
from deedlens.llm.ranking import rank_in_group
from deedlens.sources.scratch import stored

TOKENIZER = "word_bpe_49k.json"
LONGEST = 4096
#: Id that ends every document.
END = 2
#: Words, and twice as many chunks, that a task keeps before new texts; above that it starts again.
CACHED = 300_000
CACHED_LENGTH = 64
#: Texts that are split at once.
TOGETHER = 64

# A word of Latin-1 letters and a tail of ASCII signs but the apostrophe: two matches of the
# tokenizer's own pattern at most, which its normaliser changes in case only.
_PLAIN = re.compile(r"^(([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*))$", re.MULTILINE)


class WordEncoder:
    """A tokenizer that never merges across white space, with what chunks become kept in a cache.

    Chunks between blanks are encoded on their own. Of a plain chunk, the word
    and the signs behind it are; new words go through the tokenizer together,
    and the end-of-word mark tells where each ends.
    """

    def __init__(self, path: str, cached: int = CACHED):
        self.cached = cached
        self.tokenizer, self.merges, self.ends = _tokenizers(path)
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {"": b""}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _learn_words(self, words: list[str]) -> None:
        # The fast form keeps no offsets, which nobody reads here.
        (found,) = self.merges.encode_batch_fast([" ".join(words)], add_special_tokens=False)
        ids = np.array(found.ids, "<u4")
        borders = np.flatnonzero(self.ends[ids]) + 1
        if len(borders) != len(words):
            raise ValueError("the tokenizer does not mark the ends of words")
        start, flat = 0, ids.tobytes()
        for word, end in zip(words, (borders * 4).tolist(), strict=True):
            self.words[word] = flat[start:end]
            start = end

    def _learn(self, new: list[str]) -> dict[str, bytes]:
        """Ids of chunks that are not in the cache."""
        known = self.words
        # No chunk holds a line end: one search finds all plain ones.
        parts = [(c, w.lower(), t) for c, w, t in _PLAIN.findall("\n".join(new))]
        if words := list({w for _, w, _ in parts if w not in known}):
            self._learn_words(words)
        for tail in {t for _, _, t in parts if t not in known}:
            known[tail] = self._ids(tail).tobytes()
        ids = {c: known[w] + known[t] if t else known[w] for c, w, t in parts}
        for chunk in set(new).difference(ids):
            ids[chunk] = self._ids(chunk).tobytes()
        return ids

    def encode_all(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Ids of whole texts, as unsigned little-endian 32-bit integers; new words of some texts are learnt together."""
        texts = iter(texts)
        while splits := [t.replace("\n", " ").split(" ") for t in itertools.islice(texts, TOGETHER)]:
            if len(self.chunks) > 2 * self.cached:
                self.chunks = {}
            if len(self.words) > self.cached:
                self.words = {"": b""}
            known = self.chunks
            learnt = self._learn(list(set().union(*splits).difference(known)))
            known.update(learnt)
            for split in splits:
                yield b"".join(map(known.__getitem__, split))
            for chunk in [c for c in learnt if len(c) > CACHED_LENGTH]:
                del known[chunk]


@functools.cache
def _tokenizers(path: str) -> tuple[Tokenizer, Tokenizer, np.ndarray]:
    """The tokenizer of a file, its merges alone, and which ids end a word; read once in each worker."""
    tokenizer = Tokenizer.from_file(path)
    # The same merges without the steps that leave plain words as they are.
    merges = Tokenizer(tokenizer.model)
    merges.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
    size = tokenizer.get_vocab_size()
    return tokenizer, merges, np.array([(tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)])


def token_bytes(text: Column, path: str | None = None, end: int = END, cached: int = CACHED) -> Column:
    """Ids of a text and the end id behind them, as unsigned little-endian 32-bit integers in one binary value."""
    path = path or public_tokenizers.path(TOKENIZER)

    @arrow_udf(BinaryType())
    def ids(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own, last = WordEncoder(path, cached), struct.pack("<I", end)
        for column in columns:
            yield pa.array([found + last for found in own.encode_all(texts(column))], pa.binary())

    return ids(text)


def pieces(
    df: DataFrame,
    longest: int = LONGEST,
    path: str | None = None,
    end: int = END,
    doc_id: str = "doc_id",
    text: str = "text",
    cached: int = CACHED,
) -> DataFrame:
    """``doc_id, doc_tokens, start, length, ids``: the pieces of every document, long ones first.

    ``longest`` is a power of two. ``ids`` holds a piece's token ids as unsigned
    little-endian 32-bit integers; every id of a document lies in one piece. A
    NULL or empty text has the end id alone. ``cached`` is how many words a task
    keeps; it changes memory and speed, not the ids. Repeated rows are cut each by
    itself; other columns are not looked at.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest length must be a power of two")
    tokens = df.select(
        F.col(f"`{doc_id}`").alias("doc_id"), token_bytes(F.col(f"`{text}`"), path, end, cached).alias("tokens")
    ).withColumn("doc_tokens", (F.octet_length("tokens") / 4).cast("long"))
    whole = f"transform(sequence(1, doc_tokens div {longest}), k -> (k - 1) * {longest})"
    bits = [1 << k for k in reversed(range(longest.bit_length() - 1))]
    # A digit of the rest begins where the digits above it end.
    digits = ", ".join(
        f"if(doc_tokens & {b} != 0, struct(doc_tokens - doc_tokens % {2 * b} as start, {b}L as length), null)" for b in bits
    )
    cuts = (
        f"concat(if(doc_tokens >= {longest}, transform({whole}, s -> struct(s as start, {longest}L as length)), "
        f"cast(array() as array<struct<start:bigint,length:bigint>>)), "
        + (f"filter(array({digits}), c -> c is not null))" if bits else "array())")
    )
    cut = "struct(c.start, c.length, substring(tokens, int(4 * c.start + 1), int(4 * c.length)) as ids)"
    return tokens.select(
        "doc_id", "doc_tokens", F.expr(f"inline(transform({cuts}, c -> {cut}))")
    )


def number_sequences(pieces: DataFrame, seed: int = 42, buckets: int = 1024) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to the pieces, whatever other columns they carry.

    Sequences are numbered from 0 without gaps, bucket after bucket of equal
    length and in a seeded random order within one, so that a batch is a
    stretch of numbers. ``offset`` is 0: a sequence is one piece. The pieces are
    stored once, and no bucket is sorted in one task. Needs ``doc_id, start,
    length, doc_tokens`` and the digest of the ids, ``ids_crc32``, to tell
    pieces apart; equal pieces are interchangeable.
    """
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "start", "length", "ids_crc32"), 1)
    rows = stored(pieces.withColumn("draw", draw), "pieces")
    ranked = rank_in_group(rows, "length", "draw", ["doc_id", "start", "ids_crc32", "doc_tokens"], buckets)
    # One row per power of two: 13 for the longest length of 4096.
    before = F.broadcast(
        rows.groupBy("length")
        .agg(F.count("*").alias("n"))
        .select(
            F.col("length").alias("of_length"),
            F.coalesce(
                F.sum("n").over(Window.orderBy("length").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ).alias("before"),
        )
    )
    return (
        ranked.join(before, F.col("length") == F.col("of_length"))
        .withColumn("sequence_id", F.col("before") + F.col("rank"))
        .withColumn("offset", F.lit(0).cast("long"))
        .drop("draw", "rank", "in_group", "before", "of_length")
    )


def packed(df: DataFrame, keep_ids: bool = False, **options) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and, if asked for, ``ids``.

    One row per piece; an empty table gives an empty frame. See ``pieces`` and
    ``number_sequences``.
    """
    small_batches(df.sparkSession)
    cut = pieces(df, **options).withColumn("ids_crc32", F.crc32("ids"))
    numbered = number_sequences(cut if keep_ids else cut.drop("ids"))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return numbered.select(*columns, *(["ids"] if keep_ids else []))
